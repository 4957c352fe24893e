"""Stage tables (A6-A11): read/write raw, processed and report tables, skip a
stage whose output exists unless forced, and materialise an intermediate
result to cut lineage.

Paths live under the shared folder named by ``spark.checkpoint.dir`` (or a
caller-given root), never on a machine-local temporary folder, so a lost
executor costs a recomputed task, not a lost stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from citytherm.session import ensure_checkpoint_dir, shared_dir
from citytherm.sources.manifest import Manifest

# Timestamps in CSV/JSON stage files keep microseconds (Spark's default text
# format stops at milliseconds, which would silently truncate them).
TEXT_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return a fresh scan.

    Used where one intermediate feeds several aggregates (fences, group
    medians, the main path): the upstream runs once, later stages read
    columnar files with real statistics (AQE sizes its joins from them), and
    lineage is cut.  Rows are never sampled or capped.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a committed table (a ``_SUCCESS`` marker)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")))


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", force: bool = False,
                partition_by: list[str] | None = None, header: bool = True) -> str:
    """Write a stage table; an existing committed table is kept unless ``force``
    (A10: ``mode("ignore")`` vs ``mode("overwrite")``)."""
    w = df.write.mode("overwrite" if force else "ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt in ("csv", "json"):  # text formats: keep microseconds (default is millis)
        w = w.options(**TEXT_TIME_OPTIONS)
    if fmt == "csv":
        w.option("header", header).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)
    return path


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", header: bool = True) -> DataFrame:
    """Read a stage table with an explicit schema (no inference on CSV/JSON)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt in ("csv", "json"):
        r = r.options(**TEXT_TIME_OPTIONS)
    if fmt == "csv":
        return r.option("header", header).csv(path)
    if fmt == "json":
        return r.json(path)
    return r.format(fmt).load(path)


PART_BYTES = 32 << 20  # of the inputs' files, for one file of a derived stage


def _state(spark: SparkSession, paths: Sequence[str]) -> list:
    """(path, [(file, length, latest change)]) of every input folder or file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        status = list(fs.listStatus(p)) if fs.exists(p) else []
        found.append((path, sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in status)))
    return found


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Length and latest change of every input folder or file, as text."""
    return repr(_state(spark, paths))


def manifest(spark: SparkSession) -> Manifest:
    """The records in the shared folder that ``spark.checkpoint.dir`` names, the same for all applications."""
    ensure_checkpoint_dir(spark)
    return Manifest(spark, f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/citytherm-stages")


def once(spark: SparkSession, build: Callable[[str], None], *parts: str, inputs: Sequence[str] = (), force: bool = False) -> str:
    """The folder that ``build(folder)`` wrote for these parts, the present state of
    the inputs and this code, in this or an earlier application (see ``manifest``)."""
    return manifest(spark).once("-".join(parts), fingerprint(spark, inputs), build, force)


def cached_stage(spark: SparkSession, build: Callable[[], DataFrame], *parts: str, inputs: Sequence[str] = (),
                 force: bool = False) -> DataFrame:
    """A10 for derived tables: the stage table of these parts and inputs, built once."""
    def write(path: str) -> None:
        size = sum(length for _, files in _state(spark, inputs) for _, length, _ in files)
        # many files: later passes run on all cores, and no task's share grows with the inputs
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
        build().repartition(n).write.parquet(path)
    return spark.read.parquet(once(spark, write, *parts, inputs=inputs, force=force))

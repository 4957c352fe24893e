"""Stage tables: skip-if-exists (A10), publish-once, CSV/JSON/Parquet round trips."""
import uuid

from pyspark.sql import functions as F

from citytherm.session import shared_dir
from citytherm.sources import stages


def test_cached_stage_builds_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5).withColumn("x", F.col("id") * 2)
    name = uuid.uuid4().hex  # the folder may outlive this application
    a = stages.cached_stage(spark, build, "unit-test-stage", name)
    b = stages.cached_stage(spark, build, "unit-test-stage", name)
    assert a.count() == b.count() == 5 and len(calls) == 1


def test_write_stage_ignore_and_force(spark):
    path = shared_dir(spark, "unit-write")
    stages.write_stage(spark.range(3), path, force=True)
    stages.write_stage(spark.range(7), path, force=False)   # kept: exists
    assert spark.read.parquet(path).count() == 3
    stages.write_stage(spark.range(7), path, force=True)
    assert spark.read.parquet(path).count() == 7


def test_csv_json_round_trip(spark, smoke_dir):
    e = spark.read.parquet(f"{smoke_dir}/events.parquet")
    for fmt in ("csv", "json"):
        path = shared_dir(spark, f"unit-{fmt}")
        stages.write_stage(e, path, fmt=fmt, force=True)
        back = stages.read_stage(spark, path, schema=e.schema, fmt=fmt)
        assert back.exceptAll(e).count() == 0 and e.exceptAll(back).count() == 0


def test_cached_stage_follows_inputs_and_force(spark):
    source = shared_dir(spark, "unit-input")
    spark.range(3).write.parquet(source)
    build = lambda: spark.read.parquet(source)
    first = stages.cached_stage(spark, build, "follow", inputs=[source])
    spark.range(4).write.mode("append").parquet(source)
    assert first.count() == 3
    assert stages.cached_stage(spark, build, "follow", inputs=[source]).count() == 7
    spark.range(1)
    forced = stages.cached_stage(spark, lambda: spark.range(9), "follow", inputs=[source], force=True)
    assert forced.count() == stages.cached_stage(spark, build, "follow", inputs=[source]).count() == 9


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    import pytest

    from citytherm import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def _manifest(spark, code="c1"):
    from citytherm.sources.manifest import Manifest
    return Manifest(spark, _manifest.root, code)


def test_manifest_across_applications(spark):
    """Nothing is kept in the process: a fresh manifest of the same folder skips, rebuilds and sweeps."""
    import pytest
    _manifest.root, calls = shared_dir(spark, "unit-manifest"), []

    def build(n):
        def run(folder):
            calls.append(folder)
            spark.range(n).write.parquet(f"{folder}/data")
        return run
    a = _manifest(spark).once("s", "in-1", build(3))
    assert _manifest(spark).once("s", "in-1", build(9)) == a and len(calls) == 1  # a second application skips
    b = _manifest(spark).once("s", "in-2", build(4))  # a changed input rebuilds
    c = _manifest(spark, "c2").once("s", "in-2", build(5))  # so does changed code
    assert len({a, b, c}) == 3 and spark.read.parquet(f"{c}/data").count() == 5
    forced = _manifest(spark).once("s", "in-1", build(6), force=True)
    assert _manifest(spark).once("s", "in-1", build(9)) == forced
    with pytest.raises(ZeroDivisionError):
        _manifest(spark).once("lost", "x", lambda folder: (spark.range(2).write.parquet(f"{folder}/data"), 1 / 0))
    assert _manifest(spark).sweep(grace=3600) == []
    gone = _manifest(spark).sweep(grace=0)
    assert len(gone) == 2 and any("lost" in g for g in gone)  # the lost run and the output that was replaced
    assert spark.read.parquet(f"{forced}/data").count() == 6 and _manifest(spark).find("s", "in-2") is not None
    # an output that lost a file is not used
    m = _manifest(spark)
    m._fs.delete(m._list(f"{forced}/data")[-1].getPath(), False)
    assert _manifest(spark).once("s", "in-1", build(7)) != forced


def test_writers_that_meet_never_mix(spark):
    from concurrent.futures import ThreadPoolExecutor
    _manifest.root = shared_dir(spark, "unit-meet")

    def write(n):
        return _manifest(spark).once("s", "in", lambda folder: spark.range(n).write.parquet(f"{folder}/data"), force=True)
    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(write, range(1, 9)))
    assert len(set(paths)) == 8 and [spark.read.parquet(f"{p}/data").count() for p in paths] == list(range(1, 9))
    records = _manifest(spark).records("s")
    assert len({r.folder for r in records}) == 8 and all(_manifest(spark).complete(r) for r in records)
    assert _manifest(spark).once("s", "in", None).endswith(records[-1].folder)


def test_files_of_a_stage_follow_the_inputs(spark, monkeypatch):
    source = shared_dir(spark, "unit-parts")
    spark.range(1000).repartition(1).write.parquet(source)
    monkeypatch.setattr(stages, "PART_BYTES", 200)
    size = sum(n for _, files in stages._state(spark, [source]) for _, n, _ in files)
    stage = stages.cached_stage(spark, lambda: spark.read.parquet(source), "parts", uuid.uuid4().hex, inputs=[source])
    assert len(stage.inputFiles()) >= size // 200 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert stage.count() == 1000

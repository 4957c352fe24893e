import pytest

from citytherm.llm.components import components


def test_a_long_path_settles(spark):
    edges = spark.createDataFrame([(i * 7919 % 5000, (i + 1) * 7919 % 5000) for i in range(4999)], "u long, v long")
    got = components(edges)
    assert got.select("component").distinct().count() == 1 and got.select("node").distinct().count() == 5000


def test_rounds_that_run_out_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    with pytest.raises(RuntimeError):
        components(edges, rounds=2)

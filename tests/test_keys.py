"""Key-set expansion and cluster sizing."""

import pytest

from stockgap.operators.keys import attach_all
from stockgap.session import cluster_conf, dense_partitions


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_attach_all_is_every_combination_once(spark, broadcast):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        large = spark.createDataFrame([(i,) for i in range(40)], "d int")
        small = spark.createDataFrame([(f"s{j}", j) for j in range(7)], "sku string, n int")
        got = attach_all(large, small, ["sku", "n"])
        assert got.columns == ["d", "sku", "n"]
        assert sorted(tuple(r) for r in got.collect()) == sorted((i, f"s{j}", j) for i in range(40) for j in range(7))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan and "Cross" not in plan                      # an equi-join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(100 * (1 << 40), 8000)                          # 100 TB, 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(1 << 30, 64)["spark.sql.shuffle.partitions"]) == 128


def test_dense_tasks_follow_the_dense_rows():
    assert dense_partitions(10, 100) == 1
    assert dense_partitions(10**9 * 150, 2500) == 75_000_000

"""Physical plans of the scaled paths."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from sluice.operators.merge import merge_rows
from sluice.plans.jobs_core import master_lookup_df
from sluice.session import read_table, scratch_path
from tests.conftest import SF_SMALL


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def whole_data_single_partition(plan: str) -> bool:
    """A single-partition exchange not fed by a partial aggregate (which only
    moves one row per task, as in a global max) carries whole data."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            nxt = lines[i + 1] if i + 1 < len(lines) else ""
            if not ("HashAggregate" in nxt and "partial_" in nxt):
                return True
    return False


def test_no_single_partition_exchange_in_any_job_plan(spark):
    cheap = ["master_lookup", "row_number_global", "row_number_scaled", "variant_paths",
             "date_text", "text_functions", "entity_from_file", "tz_convert"]
    qs = entry_module.queries()
    for name in cheap:
        plan = executed(qs[name](spark, SF_SMALL))
        assert not whole_data_single_partition(plan), name


def test_master_lookup_without_hot_keys_is_four_left_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(master_lookup_df(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("LeftOuter") == 4 and "Inner" not in plan


def test_merge_does_not_shuffle_target_for_small_source(spark):
    orders = read_table(spark, SF_SMALL, "orders")
    target = orders.where(F.col("o_orderstatus") == "F")
    source = orders.where(F.col("o_orderpriority") == "1-URGENT")
    plan = executed(merge_rows(target, source, ["o_orderkey"]))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_scans_prune_columns_and_push_filters(spark):
    df = entry_module.queries()["variant_paths"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,props:string>" in plan
    orders = read_table(spark, SF_SMALL, "orders").where(F.col("o_orderstatus") == "F") \
        .select("o_orderkey")
    p2 = executed(orders)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p2


def test_hot_key_is_split_in_fan_out_join(spark):
    """One customer holds a third of all orders: its rows are dealt into salts,
    where a plain LEFT JOIN keeps them in one task."""
    from sluice.operators.joins import left_join
    orders = read_table(spark, "/root/testdata/sf0.01", "orders")
    hot = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7))
                            .otherwise(F.col("o_custkey")))
    base = read_table(spark, "/root/testdata/sf0.01", "customer").select(
        F.col("c_custkey").alias("k"), "c_name")
    # several map tasks, as any large input has: AQE splits by map ranges
    side = hot.repartition(8).select(F.col("o_custkey").alias("k"), "o_orderkey", "o_totalprice")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = left_join(base, side, "k", hot_rows=1000)
        spread = {"hot": df, "plain": base.join(side, "k", "left")}
        tasks = {}
        for name, d in spread.items():
            rows = d.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
            tasks[name] = len(rows)
        assert tasks["plain"] == 1 < 4 <= tasks["hot"]
        assert df.count() == orders.count() + base.join(side, "k", "left_anti").count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_four_fan_out_sides_read_the_base_twice_at_most(spark):
    from sluice.operators.joins import left_join_all
    base = spark.createDataFrame([(i % 7, i) for i in range(40)], "k int, b int")
    path = f"{scratch_path(spark, 'base')}/base-table"
    base.write.parquet(path)
    base = spark.read.parquet(path)
    sides = [spark.createDataFrame([(k, 10 * k + j) for k in range(0, 9, s + 1) for j in range(k)],
                                   f"k int, s{s} int") for s in range(4)]
    want = base
    for side in sides:
        want = want.join(side, "k", "left")
    for hot_rows, reads in ((3, 2), (10**6, 1)):
        got = left_join_all(base, sides, "k", hot_rows=hot_rows)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("[k#") >= 1 and plan.count("b#") and \
            sum(line.lstrip(" :+-").startswith("Relation") and " b#" not in line and ",b#" in line
                for line in plan.splitlines()) == reads, plan
        assert sorted(map(str, got.select(want.columns).collect())) == \
            sorted(map(str, want.collect()))

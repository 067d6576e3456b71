"""Operators on literal data: row numbers, joins, merge, flatten."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.operators.flatten import Field, flatten, flatten_documents
from sluice.operators.joins import left_join, left_join_all
from sluice.operators.merge import merge_insert_only
from sluice.operators.rownum import global_row_number


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_row_number_equals_plain_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 30), rnd.choice(["a", "b", "10", "3"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, s string, id int")
    got = global_row_number(df, ["k", "s"], buckets=7)
    want = df.withColumn("row_number", F.row_number().over(Window.orderBy("k", "s", "id")))
    a = sorted((r["id"], r["row_number"]) for r in got.collect())
    b = sorted((r["id"], r["row_number"]) for r in want.collect())
    assert a == b
    assert "SinglePartition" not in plan_text(got)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=200),
       st.integers(1, 9))
def test_global_row_number_property(spark, rows, buckets):
    rows = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k int, v int, id int")
    got = global_row_number(df, ["k", "v"], buckets=buckets)
    want = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    pos = {r[2]: i + 1 for i, r in enumerate(want)}
    assert all(pos[r["id"]] == r["row_number"] for r in got.collect())


def test_text_ids_sort_lexicographically(spark):
    df = spark.createDataFrame([("3",), ("10",), ("2",)], "id string")
    got = {r["id"]: r["row_number"] for r in global_row_number(df, ["id"]).collect()}
    assert got == {"10": 1, "2": 2, "3": 3}


def test_left_join_fan_out_and_skew_safe_equivalence(spark):
    base = spark.createDataFrame([(1, "p1"), (2, "p2"), (None, "pn")], "k int, p string")
    e = spark.createDataFrame([(1, 10), (1, 11), (3, 30)], "k int, e int")
    s = spark.createDataFrame([(1, 100), (1, 101)], "k int, s int")
    plain = base.join(e, "k", "left").join(s, "k", "left")
    safe = left_join_all(base, [e, s], "k", hot_rows=1)
    cols = ["k", "p", "e", "s"]

    def rows(df, c):
        return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(c).collect())
    a, b = rows(plain, cols), rows(safe, cols)
    assert a == b
    assert len([r for r in a if r[0] == 1]) == 4  # 1 key x 2 x 2
    assert rows(left_join(base, e, "k", hot_rows=1), ["k", "p", "e"]) == \
        rows(base.join(e, "k", "left"), ["k", "p", "e"])


def test_merge_insert_only_semantics(spark, tmp):
    target = spark.createDataFrame([(1, "t1"), (2, "t2")], "k bigint, v string")
    path = f"{tmp}/target"
    target.write.parquet(path)
    source = spark.createDataFrame([(2, "s2"), (3, "s3"), (3, "s3b"), (None, "sn")],
                                   "k bigint, v string")
    r1 = merge_insert_only(spark, path, source, ["k"])
    assert r1.rows_inserted == 3                     # duplicate key 3 twice, NULL key once
    r2 = merge_insert_only(spark, path, source, ["k"])
    assert r2.rows_inserted == 1                     # only the NULL key again
    rows = sorted((r["k"] if r["k"] is not None else -1, r["v"])
                  for r in spark.read.parquet(path).collect())
    assert rows == [(-1, "sn"), (-1, "sn"), (1, "t1"), (2, "t2"), (3, "s3"), (3, "s3b")]


def test_merge_mends_a_broken_off_append(spark, tmp):
    import os
    import shutil
    path = f"{tmp}/target"
    spark.createDataFrame([(1, "t1")], "k bigint, v string").write.parquet(path)
    source = spark.createDataFrame([(3, f"s{i}") for i in range(10)], "k bigint, v string")
    half = source.repartition(5)
    half.write.parquet(f"{path}/_append_a")           # broken off while moving: marked ready,
    open(f"{path}/_append_a/_ready", "w").close()     # two files already in the table
    moved = sorted(f for f in os.listdir(f"{path}/_append_a") if f.startswith("part-"))[:2]
    for f in moved:
        shutil.move(f"{path}/_append_a/{f}", f"{path}/{f}")
    half.write.parquet(f"{path}/_append_b")           # broken off while writing
    assert merge_insert_only(spark, path, source, ["k"]).rows_inserted == 0
    rows = sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect())
    assert rows == [(1, "t1")] + [(3, f"s{i}") for i in range(10)]
    assert not [f for f in os.listdir(path) if f.startswith("_append_")]


def test_global_row_number_puts_nulls_last(spark):
    rows = [(None, 1), (5, 2), (None, 0), (3, None), (3, 1)] * 1 + [(i, i) for i in range(9, 40)]
    df = spark.createDataFrame(rows, "k int, v int")
    got = {(r["k"], r["v"]): r["row_number"]
           for r in global_row_number(df, ["k", "v"], buckets=5).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0))
    assert got == {r: i + 1 for i, r in enumerate(want)}


def test_merge_skip_null_and_dedupe_options(spark, tmp):
    path = f"{tmp}/target"
    spark.createDataFrame([(1, "a")], "k bigint, v string").write.parquet(path)
    source = spark.createDataFrame([(3, "x"), (3, "y"), (None, "n")], "k bigint, v string")
    r = merge_insert_only(spark, path, source, ["k"], dedupe=True, skip_null_keys=True)
    assert r.rows_inserted == 1


def test_flatten_edges(spark):
    docs = [
        (1, '{"o": {"d1": [{"id": "3"}, {"id": "10"}], "d2": []}}'),
        (2, '{"o": {}}'),
        (3, '{"o": null}'),
        (4, '{"x": 1}'),
        (5, '{"o": [{"id": "7"}]}'),
    ]
    df = spark.createDataFrame(docs, "doc int, s string").select("doc", F.parse_json("s").alias("v"))
    lvl1 = flatten(df, "v", "o", "d")
    keys = sorted((r["doc"], r["d"]["key"], r["d"]["index"]) for r in lvl1.collect())
    # object entries (key, no index); array elements (index, no key); empty/null/missing dropped
    assert keys == [(1, "d1", None), (1, "d2", None), (5, None, 0)]
    outer = flatten(df, "v", "o", "d", outer=True)
    assert outer.where(F.col("doc") == 2).count() == 1


def test_flatten_documents_typed_and_numbered(spark):
    docs = [('f1', '{"near_earth_objects": {"2024-01-01": [{"id": "10", "name": "a", '
             '"absolute_magnitude_h": "1.5", "close_approach_data": [{"miss_distance": '
             '{"kilometers": 7}}]}, {"id": "3", "is_potentially_hazardous_asteroid": true}]}}')]
    landing = spark.createDataFrame(docs, "source_file_name string, s string").select(
        F.lit(None).cast("timestamp_ntz").alias("source_file_loaded_at_utc"),
        F.lit(None).cast("date").alias("source_file_date_utc"), "source_file_name",
        F.md5("s").alias("source_file_object_unique_key"),
        F.parse_json("s").alias("source_file_object"))
    out = {r["id"]: r for r in flatten_documents(landing).collect()}
    assert out["10"]["source_file_row_number"] == 1 and out["3"]["source_file_row_number"] == 2
    assert out["10"]["absolute_magnitude_h"] == 1.5 and out["10"]["miss_distance_km"] == 7.0
    assert out["3"]["is_hazardous"] is True and out["3"]["velocity_kps"] is None
    fields = (Field("id", "id"), Field("n", "name"))
    small = flatten_documents(landing, fields=fields, keep_object=True)
    assert "source_file_object" in small.columns and small.count() == 2


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=30), st.lists(st.integers(0, 20), max_size=30))
def test_merge_twice_equals_merge_once(spark, target_keys, source_keys):
    """merge(merge(t, s), s) == merge(t, s) for non-NULL keys."""
    import tempfile
    path = tempfile.mkdtemp(prefix="sluice-prop-") + "/t"
    spark.createDataFrame([(k, "t") for k in target_keys] or [(0, "x")][:0],
                          "k bigint, v string").write.parquet(path)
    src = spark.createDataFrame([(k, "s") for k in source_keys], "k bigint, v string")
    merge_insert_only(spark, path, src, ["k"])
    once = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    merge_insert_only(spark, path, src, ["k"])
    twice = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert once == twice
    new = {k for k in source_keys if k not in set(target_keys)}
    assert len(once) == len(target_keys) + sum(1 for k in source_keys if k in new)


def test_master_lookup_order_splits_a_hot_id(spark):
    from sluice.plans.master import Side, build_master_lookup
    base = spark.createDataFrame([(i, f"f{i}") for i in range(3)], "id bigint, src string")
    enc = spark.range(0, 6000).select(F.when(F.col("id") < 5000, F.lit(1)).otherwise(F.col("id") % 3)
                                      .cast("bigint").alias("pid"), F.col("id").alias("eid"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        out = build_master_lookup(base, "id", "patient_id", [Side(enc, "pid", "eid", "enc_id")],
                                  lookup_key="lookup_key", carry=["src"])
        parts = (out.select(F.spark_partition_id().alias("p"), "patient_id")
                 .where(F.col("patient_id") == 1).select("p").distinct().count())
        assert parts > 1                    # the frequent id spans several range partitions
        rows = out.collect()
    finally:
        spark.conf.set(key, "true")
    assert len(rows) == 6000
    assert [r["patient_id"] for r in rows] == sorted(r["patient_id"] for r in rows)


def test_global_row_number_spreads_a_hot_key(spark):
    """90% of rows share one key value: the bounds (key + tie-breaker) still
    split it, so no range (sorting task) holds the hot value alone."""
    import sluice.operators.rownum as R
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(5)).alias("k"), "id")
    ranges = R._ranges(df, ["k", "id"], 8)
    counts = [r[1] for r in ranges.groupBy("__range").count().collect()]
    assert sum(counts) == 20000 and max(counts) < 0.3 * 20000  # hot value spread over ranges
    rows = global_row_number(df, ["k"], buckets=8).collect()
    want = {r[1]: i + 1 for i, r in enumerate(sorted((r["k"], r["id"]) for r in rows))}
    assert all(r["row_number"] == want[r["id"]] for r in rows)


def test_global_row_number_edges(spark):
    """No rows, rows equal in every column, an input whose row order differs
    from run to run, names with blanks, a number column in the input's place."""
    empty = spark.createDataFrame([], "k int, `a b` string")
    assert global_row_number(empty, ["k"]).collect() == []
    same = spark.range(5000).select(F.lit(1).alias("k"), F.lit("x").alias("a b"))
    got = global_row_number(same, ["k", "a b"], "n", buckets=6)
    assert got.columns == ["k", "a b", "n"]
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 5001))
    got = global_row_number(same, ["k"], "n", buckets=6, stage=True)
    assert got.columns == ["k", "a b", "n"]
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 5001))
    mixed = spark.range(3000).repartition(7).select(
        (F.col("id") % 40).cast("double").alias("k"),
        F.when(F.col("id") % 3 != 0, F.timestamp_micros(F.col("id") % 11)).alias("t"),
        F.col("id").cast("string").cast("binary").alias("b"), "id")
    for buckets in (1, 5, 64):
        got = global_row_number(mixed, ["t", "k"], buckets=buckets, stage=buckets == 5)
        rows = [(r["t"] is None, r["t"], r["k"], bytes(r["b"]), r["row_number"])
                for r in got.collect()]
        rows = [(x[0], x[1].timestamp() if x[1] else 0, *x[2:]) for x in rows]
        assert [r[-1] for r in sorted(rows)] == list(range(1, 3001))


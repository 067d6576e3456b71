"""Registered jobs: joins, keys, merge, scalar functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import ntz_literal
from sluice.functions.keys import TIMESTAMP_KEY_FORMAT
from sluice.operators.merge import merge_insert_only
from sluice.operators.snapshot import stage
from sluice.plans.master import Side, build_master_lookup
from sluice.plans.registry import register
from sluice.session import read_table, scratch_path

# Fixed run time of every job, so keys that hash the load time repeat.
RUN_AT = _dt.datetime(2025, 1, 2, 3, 4, 5)
RUN_AT_KEY_TEXT = "2025-01-02 03:04:05.000 +0000"  # RUN_AT in TIMESTAMP_KEY_FORMAT
assert TIMESTAMP_KEY_FORMAT == "yyyy-MM-dd HH:mm:ss.SSS Z"


def as_loaded(df: DataFrame, entity: str, key: str) -> DataFrame:
    """The table as the load step would have produced it from one file.

    Adds the six lineage columns for a file ``<entity>_<run stamp>_UTC.csv.gz``
    written in key order, so the row number is the key's position.
    """
    name = f"{entity}_{RUN_AT:%Y%m%d%H%M%S}_UTC.csv.gz"
    file_key = F.md5(F.lit(RUN_AT_KEY_TEXT + name))
    row_no = (F.col(key) + 1).cast("bigint")
    return df.select(
        ntz_literal(RUN_AT).alias("source_file_loaded_at_utc"),
        F.lit(RUN_AT.date()).alias("source_file_date_utc"),
        F.lit(name).alias("source_file_name"),
        file_key.alias("source_file_unique_key"),
        row_no.alias("source_file_row_number"),
        F.md5(F.concat(file_key, row_no.cast("string"))).alias("source_file_record_unique_key"),
        "*",
    )


def master_lookup_df(spark: SparkSession, sf_dir: str, order: bool = True) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    orders = read_table(spark, sf_dir, "orders")
    supplier = read_table(spark, sf_dir, "supplier")
    part = read_table(spark, sf_dir, "part")
    patients = as_loaded(customer, "customer", "c_custkey")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    sides = [
        Side(orders, "o_custkey", "o_orderkey", "encounters_patient_encounter_id"),
        Side(supplier.withColumn("v", F.col("s_nationkey").cast("bigint")), "s_suppkey", "v",
             "surgical_encounters_surgery_id", unique=True),
        Side(part.withColumn("v", F.col("p_size").cast("bigint")), "p_partkey", "v",
             "v_patients_primary_care_pcp_id", unique=True),
        Side(urgent, "o_custkey", "o_orderkey", "v_patients_primary_care_maleham_pcp_id"),
    ]
    return build_master_lookup(patients, "c_custkey", "patients_master_patient_id", sides,
                               lookup_key="master_patient_lookup_table_unique_key", order=order)


_LINEAGE_SQL = f"""
    SELECT TIMESTAMP '2025-01-02 03:04:05' AS source_file_loaded_at_utc,
           DATE '2025-01-02' AS source_file_date_utc,
           'customer_20250102030405_UTC.csv.gz' AS source_file_name,
           md5('{RUN_AT_KEY_TEXT}customer_20250102030405_UTC.csv.gz') AS source_file_unique_key,
           c_custkey + 1 AS source_file_row_number,
           md5(md5('{RUN_AT_KEY_TEXT}customer_20250102030405_UTC.csv.gz')
               || CAST(c_custkey + 1 AS VARCHAR)) AS source_file_record_unique_key,
           c_custkey AS id
    FROM customer"""

MASTER_LOOKUP_SQL = f"""
WITH p AS ({_LINEAGE_SQL}),
e AS (SELECT o_custkey AS id, o_orderkey AS v FROM orders),
se AS (SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS v FROM supplier),
pc AS (SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS v FROM part),
pm AS (SELECT o_custkey AS id, o_orderkey AS v FROM orders
       WHERE o_orderpriority = '1-URGENT')
SELECT p.source_file_loaded_at_utc, p.source_file_date_utc, p.source_file_name,
       p.source_file_unique_key, p.source_file_row_number, p.source_file_record_unique_key,
       md5(CAST(coalesce(p.id, 0) AS VARCHAR) || CAST(coalesce(e.v, 0) AS VARCHAR)
           || CAST(coalesce(se.v, 0) AS VARCHAR) || CAST(coalesce(pc.v, 0) AS VARCHAR)
           || CAST(coalesce(pm.v, 0) AS VARCHAR)) AS master_patient_lookup_table_unique_key,
       p.id AS patients_master_patient_id,
       e.v AS encounters_patient_encounter_id,
       se.v AS surgical_encounters_surgery_id,
       pc.v AS v_patients_primary_care_pcp_id,
       pm.v AS v_patients_primary_care_maleham_pcp_id
FROM p
LEFT JOIN e ON p.id = e.id
LEFT JOIN se ON p.id = se.id
LEFT JOIN pc ON p.id = pc.id
LEFT JOIN pm ON p.id = pm.id
"""


@register("master_lookup", MASTER_LOOKUP_SQL)
def master_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master_lookup_df(spark, sf_dir)


# ---------------------------------------------------------------------------
# merge_insert_only: all orders, split by key into a target and a source that
# overlap; the source repeats keys and has NULL keys; the merge runs twice.

def _merge_inputs(spark: SparkSession, sf_dir: str):
    orders = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    target = orders.where(key % 3 != 0)
    source = (
        orders.where(key % 3 != 1)
        .unionByName(orders.where(key % 6 == 0))
        .unionByName(orders.where(key % 9 == 1).withColumn("o_orderkey", F.lit(None)
                                                           .cast("bigint")))
    )
    return target, source


MERGE_SQL = """
WITH t AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0),
s AS (
    SELECT * FROM orders WHERE o_orderkey % 3 <> 1
    UNION ALL
    SELECT * FROM orders WHERE o_orderkey % 6 = 0
    UNION ALL
    SELECT CAST(NULL AS BIGINT) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 9 = 1)
SELECT * FROM t
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
UNION ALL
SELECT * FROM s WHERE o_orderkey IS NULL
"""


@register("merge_insert_only", MERGE_SQL)
def merge_insert_only_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _merge_inputs(spark, sf_dir)
    path = scratch_path(spark, "merge-target")
    target.write.parquet(path)
    staged = stage(spark, source, "merge-source")
    merge_insert_only(spark, path, staged, ["o_orderkey"])
    merge_insert_only(spark, path, staged, ["o_orderkey"])  # re-run: only NULL keys again
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# date_text / tz_convert / text_functions: scalar functions over whole tables

from sluice.functions.dates import date_text, parse_date, to_utc, utc_stamp  # noqa: E402
from sluice.functions.text import (regexp_count, regexp_full_match, rtrim_chars,  # noqa: E402
                                   regexp_group)
from sluice.operators.infer import normalise_type  # noqa: E402

DATE_TEXT_SQL = """
SELECT o_orderkey,
       strftime(o_orderdate, '%Y%m%d') AS date_text,
       CAST(o_orderdate AS DATE) AS parsed_date,
       strftime(o_orderdate, '%Y%m%d') || '_UTC' AS stamp_date,
       strftime(o_orderdate, '%Y%m%d%H%M%S') || '_UTC' AS stamp_time
FROM orders"""


@register("date_text", DATE_TEXT_SQL)
def date_text_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    txt = date_text("o_orderdate", "YYYYMMDD")
    return orders.select("o_orderkey", txt.alias("date_text"),
                         parse_date(txt, "YYYYMMDD").alias("parsed_date"),
                         utc_stamp("o_orderdate", "date").alias("stamp_date"),
                         utc_stamp("o_orderdate", "time").alias("stamp_time"))


TZ_SQL = """
SELECT event_id, ts,
       (ts AT TIME ZONE 'America/Denver') AT TIME ZONE 'UTC' AS ts_utc,
       strftime((ts AT TIME ZONE 'America/Denver') AT TIME ZONE 'UTC', '%Y%m%d') AS utc_day
FROM events"""


@register("tz_convert", TZ_SQL)
def tz_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    utc = to_utc("ts", "America/Denver")
    return events.select("event_id", "ts", utc.alias("ts_utc"),
                         date_text(utc, "YYYYMMDD").alias("utc_day"))


TEXT_SQL = r"""
WITH t AS (
    SELECT *, CASE p_type WHEN 'ECONOMY' THEN 'TEXT' WHEN 'SMALL' THEN 'DATE'
                          ELSE 'NUMBER(' || CAST(p_size AS VARCHAR) || ',2)' END AS type_text
    FROM part)
SELECT p_partkey,
       regexp_full_match(p_brand, 'Brand#\d+') AS brand_full,
       regexp_full_match(p_name, 'red') AS name_is_red,
       regexp_matches(p_name, 'red') AS name_has_red,
       len(regexp_extract_all(p_name, '[aeiou]')) AS vowels,
       CASE WHEN regexp_full_match(type_text, '(TEXT|DATE)') THEN 'VARCHAR'
            WHEN regexp_full_match(type_text, 'NUMBER\(.*') THEN regexp_replace(type_text, 'NUMBER\(\d+,', 'NUMBER(38,')
            ELSE type_text END AS normalised_type,
       rtrim(p_brand || ',' || chr(10) || ',', ',' || chr(10)) AS trimmed,
       repeat('-', p_size // 10) AS bar,
       p_size + 1 AS next_position,
       upper(nullif(regexp_extract(p_brand, '#(\d+)$', 1), '')) AS brand_no,
       (SELECT max(p_retailprice) FROM part) AS max_price,
       [p_brand, p_type][1] AS first_of_pair,
       len([p_brand, p_type, p_name]) AS triple_size,
       true AS flag
FROM t"""


@register("text_functions", TEXT_SQL)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    type_text = (F.when(F.col("p_type") == "ECONOMY", F.lit("TEXT"))
                 .when(F.col("p_type") == "SMALL", F.lit("DATE"))
                 .otherwise(F.concat(F.lit("NUMBER("), F.col("p_size").cast("string"), F.lit(",2)"))))
    max_price = part.select(F.max("p_retailprice")).scalar()  # scalar subquery (B10)
    return part.select(
        "p_partkey",
        regexp_full_match("p_brand", r"Brand#\d+").alias("brand_full"),
        regexp_full_match("p_name", "red").alias("name_is_red"),
        F.col("p_name").rlike("red").alias("name_has_red"),
        regexp_count("p_name", "[aeiou]").cast("bigint").alias("vowels"),
        normalise_type(type_text).alias("normalised_type"),
        rtrim_chars(F.concat("p_brand", F.lit(",\n,")), ",\n").alias("trimmed"),
        F.repeat(F.lit("-"), F.floor(F.col("p_size") / 10).cast("int")).alias("bar"),
        (F.col("p_size") + 1).alias("next_position"),
        F.upper(regexp_group("p_brand", r"#(\d+)$")).alias("brand_no"),
        max_price.alias("max_price"),
        F.array("p_brand", "p_type")[0].alias("first_of_pair"),  # 0-based index (H24)
        F.array_size(F.array("p_brand", "p_type", "p_name")).cast("bigint").alias("triple_size"),
        F.lit(True).alias("flag"),
    )


# ---------------------------------------------------------------------------
# failover_snapshot: the merge into an incompatible target fails, the staged
# load table is copied to <load>_<yyyymmdd>

from sluice.operators.merge import merge_with_failover  # noqa: E402


@register("failover_snapshot", MASTER_LOOKUP_SQL)
def failover_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = scratch_path(spark, "master-lookup-load")
    master_lookup_df(spark, sf_dir).write.parquet(load)  # temp snapshot (A23)
    target = scratch_path(spark, "master-lookup")
    # a target with a column the load does not have: the merge cannot align
    # the inserted rows to it and fails (with any ANSI setting)
    spark.range(1).select(F.col("id").cast("string").alias("master_patient_lookup_table_unique_key"),
                          F.lit("x").alias("column_missing_from_load")).write.parquet(target)
    result = merge_with_failover(spark, target, load, ["master_patient_lookup_table_unique_key"],
                                 run_date=RUN_AT.date())
    marker = "kept at: "
    if marker not in result.message:
        raise RuntimeError(f"expected a failover, got: {result.message}")
    return spark.read.parquet(result.message.split(marker)[1])

"""Registered jobs: variant documents, flatten, row numbers, unload, landing."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.dates import ntz_literal
from sluice.functions.json import get_path
from sluice.operators.flatten import flatten_documents
from sluice.operators.merge import merge_insert_only
from sluice.operators.rownum import global_row_number
from sluice.operators.snapshot import stage
from sluice.plans.jobs_core import RUN_AT, RUN_AT_KEY_TEXT
from sluice.plans.registry import register
from sluice.session import read_table, scratch_path
from sluice.sources.api import land_responses
from sluice.sources.unload import read_unloaded, unload_json

CUSTOMERS_PER_DOC = 500
RUN_DATE = RUN_AT.date()

# ---------------------------------------------------------------------------
# flatten_object_array: one JSON document per (region, customer key range),
# shaped like the reference's feed: {near_earth_objects: {<nation>: [elements]}}


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows with a variant document; each document holds at most
    ``CUSTOMERS_PER_DOC`` customers (one range of the unique key)."""
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    rows = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey))
    bucket = F.floor(F.col("c_custkey") / CUSTOMERS_PER_DOC).cast("bigint")
    name = F.concat(F.lit("region_"), F.col("r_regionkey").cast("string"), F.lit("_"),
                    F.lpad(bucket.cast("string"), 6, "0"), F.lit(".json"))
    element = F.struct(
        F.struct(F.concat(F.lit("customer/"), F.col("c_custkey").cast("string")).alias("self"))
        .alias("links"),
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("neo_reference_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("absolute_magnitude_h"),
        (F.col("c_acctbal") < 0).alias("is_potentially_hazardous_asteroid"),
        F.array(F.struct(
            F.col("n_name").alias("close_approach_date"),
            F.struct(F.col("c_acctbal").cast("string").alias("kilometers_per_second"))
            .alias("relative_velocity"),
            F.struct(F.col("c_nationkey").alias("kilometers")).alias("miss_distance"),
            F.col("c_mktsegment").alias("orbiting_body"),
        )).alias("close_approach_data"),
    )
    per_nation = (rows.withColumn("__file", name)
                  .groupBy("__file", "n_name").agg(F.collect_list(element).alias("arr")))
    docs = per_nation.groupBy("__file").agg(
        F.map_from_entries(F.collect_list(F.struct("n_name", "arr"))).alias("neo"))
    return docs.select(
        ntz_literal(RUN_AT).alias("source_file_loaded_at_utc"),
        F.lit(RUN_DATE).alias("source_file_date_utc"),
        F.col("__file").alias("source_file_name"),
        F.md5(F.concat(F.lit(RUN_AT_KEY_TEXT), F.col("__file"))).alias("source_file_object_unique_key"),
        F.parse_json(F.to_json(F.struct(F.col("neo").alias("near_earth_objects"))))
        .alias("source_file_object"),
    )


FLATTEN_SQL = f"""
WITH f AS (
    SELECT c.*, n.n_name,
           'region_' || CAST(n.n_regionkey AS VARCHAR) || '_'
               || lpad(CAST(c.c_custkey // {CUSTOMERS_PER_DOC} AS VARCHAR), 6, '0') || '.json' AS fname
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT TIMESTAMP '2025-01-02 03:04:05' AS source_file_loaded_at_utc,
       DATE '2025-01-02' AS source_file_date_utc,
       fname AS source_file_name,
       md5('{RUN_AT_KEY_TEXT}' || fname) AS source_file_object_unique_key,
       row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS source_file_row_number,
       'customer/' || CAST(c_custkey AS VARCHAR) AS link_self,
       CAST(c_custkey AS VARCHAR) AS id,
       c_name AS neo_reference_id,
       c_name AS name,
       c_acctbal AS absolute_magnitude_h,
       c_acctbal < 0 AS is_hazardous,
       n_name AS close_approach_date,
       c_acctbal AS velocity_kps,
       CAST(c_nationkey AS DOUBLE) AS miss_distance_km,
       c_mktsegment AS orbiting_body
FROM f"""


@register("flatten_object_array", FLATTEN_SQL)
def flatten_object_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flatten into a temp table, insert-only merge into the raw table on the
    document key (twice: the second run inserts nothing), read it ordered."""
    docs = customer_documents(spark, sf_dir)
    path = scratch_path(spark, "landing-json")
    docs.write.parquet(path)  # the landing table (variant survives parquet)
    temp = stage(spark, flatten_documents(spark.read.parquet(path)), "temp-load-neo")
    raw = scratch_path(spark, "raw-neo")
    for _ in range(2):
        merge_insert_only(spark, raw, temp, ["source_file_object_unique_key"])
    return spark.read.parquet(raw).orderBy(
        F.col("source_file_date_utc").asc_nulls_last(),
        F.col("source_file_row_number").asc_nulls_last())


# ---------------------------------------------------------------------------
# variant paths and casts over events.props

VARIANT_PATHS_SQL = """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events"""


@register("variant_paths", VARIANT_PATHS_SQL)
def variant_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", get_path(F.parse_json("props"), "k", "int").alias("k"))


def _mixed_doc():
    return F.when(F.col("event_type") == "error",
                  F.concat(F.lit('{"v": "n/a-'), F.col("event_id").cast("string"), F.lit('"}'))) \
        .otherwise(F.concat(F.lit('{"v": '), F.col("value").cast("string"), F.lit("}")))


STRICT_LENIENT_SQL = """
WITH d AS (
    SELECT *, CASE WHEN event_type = 'error'
                   THEN '{"v": "n/a-' || CAST(event_id AS VARCHAR) || '"}'
                   ELSE '{"v": ' || CAST(value AS VARCHAR) || '}' END AS doc
    FROM events)
SELECT event_id,
       TRY_CAST(json_extract_string(doc, '$.v') AS DOUBLE) AS v_lenient,
       CASE WHEN event_type <> 'error'
            THEN CAST(json_extract_string(doc, '$.v') AS DOUBLE) END AS v_strict,
       json_extract_string(doc, '$.v') AS v_text
FROM d"""


@register("variant_strict_vs_lenient", STRICT_LENIENT_SQL)
def variant_strict_vs_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    v = F.parse_json(_mixed_doc())
    return events.select(
        "event_id",
        get_path(v, "v", "float", strict=False).alias("v_lenient"),
        # strict cast only where the value is a number: a bad cast would raise
        F.when(F.col("event_type") != "error", get_path(v, "v", "float")).alias("v_strict"),
        F.when(F.col("event_type") == "error", get_path(v, "v", "string"))
        .otherwise(F.col("value").cast("string")).alias("v_text"),
    )


# ---------------------------------------------------------------------------
# global row numbers without a single-partition sort

ROW_NUMBER_GLOBAL_SQL = """
WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts FROM events)
SELECT event_id, ts, row_number() OVER (ORDER BY ts NULLS LAST, event_id) AS row_number FROM e"""


@register("row_number_global", ROW_NUMBER_GLOBAL_SQL)
def row_number_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers over a key that is NULL for some events: those come last."""
    events = read_table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    return global_row_number(events, ["ts", "event_id"]).select("event_id", "ts", "row_number")


ROW_NUMBER_SCALED_SQL = """
SELECT l_orderkey, l_linenumber, l_shipdate,
       row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS row_number
FROM lineitem"""


@register("row_number_scaled", ROW_NUMBER_SCALED_SQL)
def row_number_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return global_row_number(items, ["l_shipdate", "l_orderkey", "l_linenumber"]) \
        .select("l_orderkey", "l_linenumber", "l_shipdate", "row_number")


# ---------------------------------------------------------------------------
# unload_json: events as feed responses -> gzip JSON files -> read back

UNLOAD_CAP = 16_384  # bytes: several files per feed from sf0.01 on

UNLOAD_SQL = f"""
WITH back AS (
    SELECT event_type AS api_name, DATE '2025-01-02' AS file_date, event_id, user_id, value,
           CAST(props->>'$.k' AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS note
    FROM events
    UNION ALL
    SELECT 'constant', DATE '2025-01-02', NULL, NULL, NULL, NULL, 'ü✓ same' FROM events)
SELECT *, true AS under_cap FROM back"""


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                    F.lit(',"user_id":'), F.col("user_id").cast("string"),
                    F.lit(',"value":'), F.col("value").cast("string"),
                    F.lit(',"props":'), F.col("props"), F.lit("}"))
    return events.select(F.col("event_type").alias("api_name"),
                         F.to_date("ts").alias("json_response_date"),
                         F.parse_json(text).alias("json_response"))


@register("unload_json", UNLOAD_SQL)
def unload_json_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unload some events, then (the same day) all of them and a feed of equal
    rows: the second run replaces the first, and every file is under the cap."""
    out = scratch_path(spark, "unload")
    rows = event_responses(spark, sf_dir)
    same = rows.select(F.lit("constant").alias("api_name"), "json_response_date",
                       F.parse_json(F.lit('{"note":"ü✓ same"}')).alias("json_response"))
    unload_json(spark, rows.where(F.col("api_name") != "error"), out, RUN_DATE)
    unload_json(spark, rows.unionByName(same), out, RUN_DATE, max_file_size=UNLOAD_CAP)
    back = read_unloaded(spark, out)
    v = F.col("value")
    size = F.sum(F.octet_length(F.to_json("value")) + 1).over(Window.partitionBy("file_name"))
    return back.select(F.col("feed").alias("api_name"), "file_date",
                       get_path(v, "event_id", "bigint").alias("event_id"),
                       get_path(v, "user_id", "bigint").alias("user_id"),
                       get_path(v, "value", "double").alias("value"),
                       get_path(v, "props.k", "int").alias("k"),
                       get_path(v, "note", "string").alias("note"),
                       (size <= UNLOAD_CAP).alias("under_cap"))


# ---------------------------------------------------------------------------
# land_responses: one request per order date and feed, fake fetcher


class EchoFeed:
    """Stand-in for an HTTP client: answers with the request it got; Sundays fail."""

    def __call__(self, start_date: str, end_date: str) -> dict:
        day = _dt.date.fromisoformat(start_date)
        if day.isoweekday() == 7:
            raise RuntimeError(f"no answer for {day}")
        return {"end_date": end_date, "feed": "neo_data", "start_date": start_date}


class TleFeed:
    """The feed that is called without any argument."""

    def __call__(self) -> str:
        return '{"feed":"tle_data","member":[]}'


LAND_SQL = """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT 'neo_data' AS api_name, DATE '2025-01-02' AS json_response_date,
       CASE WHEN isodow(d) <> 7
            THEN '{"end_date":"' || CAST(d AS VARCHAR) || '","feed":"neo_data","start_date":"'
                 || CAST(d AS VARCHAR) || '"}' END AS response_text,
       CASE WHEN isodow(d) = 7
            THEN 'RuntimeError: no answer for ' || CAST(d AS VARCHAR) END AS error
FROM d
UNION ALL
SELECT 'tle_data', DATE '2025-01-02', '{"feed":"tle_data","member":[]}', NULL FROM d"""


@register("land_responses", LAND_SQL)
def land_responses_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order date and feed; failed ones land in the error table."""
    orders = read_table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").cast("string").alias("day")).distinct()
    path, errors = scratch_path(spark, "responses"), scratch_path(spark, "response-errors")
    neo = days.select(F.lit("neo_data").alias("api_name"), F.col("day").alias("start_date"),
                      F.col("day").alias("end_date"))
    land_responses(neo, EchoFeed, ["start_date", "end_date"], RUN_DATE, strict=False,
                   errors_path=errors).write.mode("append").parquet(path)
    land_responses(days.select(F.lit("tle_data").alias("api_name")), TleFeed, [], RUN_DATE) \
        .write.mode("append").parquet(path)
    landed = spark.read.parquet(path).select(
        "api_name", "json_response_date", F.to_json("json_response").alias("response_text"),
        F.lit(None).cast("string").alias("error"))
    return landed.unionByName(spark.read.parquet(errors).select(
        "api_name", "json_response_date", F.lit(None).cast("string").alias("response_text"),
        "error"))

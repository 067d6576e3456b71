"""Registered jobs on what is published: exports read back whole, sources
removed after cleaning, responses landed and unloaded in one procedure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.json import get_path
from sluice.plans.fixtures import file_name_sql, land_table, new_landing
from sluice.plans.jobs_core import RUN_AT
from sluice.plans.registry import register
from sluice.session import read_table, scratch_path
from sluice.sources.files import list_files

CUSTOMERS_PER_FILE = 1000

# ---------------------------------------------------------------------------
# export_values: tables having the key column, exported in its order; a second
# export into the folder is refused; all columns are read back

EXPORT_VALUES_SQL = """
SELECT 'accounts' AS table_name, c_custkey AS custkey, CAST(NULL AS BIGINT) AS orderkey,
       c_name || '|' || c_mktsegment AS texts, c_acctbal AS amount, CAST(NULL AS DATE) AS day,
       true AS rows_in_order, true AS files_in_order, true AS second_refused
FROM customer
UNION ALL
SELECT 'purchases', CASE WHEN o_orderkey % 10 > 0 THEN o_custkey END, o_orderkey,
       o_orderstatus || '|' || o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE),
       true, true, true
FROM orders"""


@register("export_values", EXPORT_VALUES_SQL)
def export_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of two exported tables (one with NULL keys: last), whether the
    rows of a file and the files of a table follow the key, and that a folder
    that exists is left alone."""
    from sluice.sources.export import export_ordered_csv
    out = scratch_path(spark, "export-values")
    customer, orders = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders")
    accounts = customer.select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment",
                               "c_acctbal")
    purchases = orders.select(
        F.when(F.col("o_orderkey") % 10 > 0, F.col("o_custkey")).alias("custkey"), "o_orderkey",
        "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"))
    tables = {"accounts": accounts, "purchases": purchases,
              "regions": read_table(spark, sf_dir, "region")}
    export_ordered_csv(spark, tables, "custkey", out, RUN_AT)
    listed = sorted(tuple(r) for r in list_files(spark, out).collect())  # names only
    try:
        export_ordered_csv(spark, {"accounts": accounts.limit(1)}, "custkey", out, RUN_AT)
        refused = False
    except FileExistsError:
        refused = listed == sorted(tuple(r) for r in list_files(spark, out).collect())

    def back(name: str) -> DataFrame:
        text = ", ".join(f"`{c}` string" for c in tables[name].columns)
        rows = spark.read.schema(text).options(header="true").csv(f"{out}/{name}_*.csv.gz") \
            .select("*", F.col("_metadata.file_name").alias("file"),
                    F.monotonically_increasing_id().alias("place"))  # a gzip file is one split
        rows = rows.withColumn("k", F.coalesce(F.col("custkey").cast("bigint"),
                                               F.lit((1 << 63) - 1)))  # NULLs last
        within = Window.partitionBy("file").orderBy("place")
        rows = rows.withColumn("rows_in_order", F.coalesce(
            F.col("k") >= F.lag("k").over(within), F.lit(True)))
        ends = rows.groupBy("file").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        ends = ends.withColumn("files_in_order", F.coalesce(  # a row per file
            F.col("lo") >= F.lag("hi").over(Window.orderBy("file")), F.lit(True)))
        return rows.join(ends.select("file", "files_in_order"), "file") \
            .withColumn("table_name", F.lit(name))

    def rows(name: str, orderkey: str, texts: list[str], amount: str, day: str) -> DataFrame:
        return back(name).select(
            "table_name", F.col("custkey").cast("bigint").alias("custkey"),
            F.expr(orderkey).cast("bigint").alias("orderkey"),
            F.concat_ws("|", *texts).alias("texts"), F.col(amount).cast("double").alias("amount"),
            F.expr(day).cast("date").alias("day"), "rows_in_order", "files_in_order",
            F.lit(refused).alias("second_refused"))

    return rows("accounts", "NULL", ["c_name", "c_mktsegment"], "c_acctbal", "NULL").unionByName(
        rows("purchases", "o_orderkey", ["o_orderstatus", "o_orderpriority"], "o_totalprice",
             "o_orderdate"))


# ---------------------------------------------------------------------------
# source_removal: what cleaning leaves in the source, target and archive

_CUSTOMER_FILE = file_name_sql("customer", "c_custkey", CUSTOMERS_PER_FILE)
SOURCE_REMOVAL_SQL = f"""
WITH f AS (SELECT DISTINCT {_CUSTOMER_FILE} AS file_name FROM customer)
SELECT step, folder, file_name, folder <> 'source' AS cleaned
FROM f, (VALUES ('1 kept', 'source'), ('1 kept', 'target'),
                ('2 target exists', 'source'), ('2 target exists', 'target'),
                ('3 archived', 'archive'), ('3 archived', 'target'),
                ('4 deleted', 'target')) AS s(step, folder)"""


@register("source_removal", SOURCE_REMOVAL_SQL)
def source_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files left after cleaning with every source action.  A source whose
    target exists is not cleaned and so stays, whatever the action."""
    from sluice.operators.clean import clean_csv_files
    customer = read_table(spark, sf_dir, "customer")

    def landed() -> str:
        landing = new_landing(spark, "raw-files")
        land_table(spark, customer, landing, "customer", "c_custkey", CUSTOMERS_PER_FILE)
        return landing

    source, again = landed(), landed()
    target, other, third, archive = (scratch_path(spark, f"removal-{x}")
                                     for x in ("target", "other", "third", "archive"))
    found: list[DataFrame] = []

    def note(step: str, **folders: str) -> None:
        for folder, path in folders.items():
            names = [r["relative_path"] for r in list_files(spark, path).collect()]
            found.append(spark.createDataFrame(
                [(step, folder, n, folder != "source") for n in names],
                "step string, folder string, file_name string, cleaned boolean"))

    clean_csv_files(spark, source, target)
    note("1 kept", source=source, target=target)
    clean_csv_files(spark, source, target, source_action="delete")
    note("2 target exists", source=source, target=target)
    clean_csv_files(spark, source, other, source_action="archive", archive_dir=archive)
    note("3 archived", source=source, target=other, archive=archive)
    clean_csv_files(spark, again, third, source_action="delete")
    note("4 deleted", source=again, target=third)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


# ---------------------------------------------------------------------------
# land_and_unload: one request per order date -> responses table -> files

LAND_AND_UNLOAD_SQL = """
SELECT 'day_data' AS feed, DATE '2025-01-02' AS file_date,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS copies, true AS reported
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)
GROUP BY ALL
UNION ALL
SELECT 'empty_feed', DATE '2025-01-02', CAST(NULL AS VARCHAR), count(DISTINCT
       CAST(o_orderdate AS DATE)), true FROM orders"""


class DayFeed:
    """Stand-in for an HTTP client: answers with the day, or with no day."""

    def __call__(self, day: str | None) -> dict:
        return {"day": day} if day else {}


@register("land_and_unload", LAND_AND_UNLOAD_SQL)
def land_and_unload_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of two feeds are answered, landed in the responses table and
    unloaded to files of the run's date; the message names every file."""
    import json

    from sluice.plans.procedures import land_and_unload
    from sluice.sources.unload import read_unloaded
    days = read_table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").cast("string").alias("day")).distinct()
    requests = days.select(F.lit("day_data").alias("api_name"), "day").unionByName(
        days.select(F.lit("empty_feed").alias("api_name"), F.lit(None).cast("string").alias("day")))
    out = scratch_path(spark, "day-files")
    message = land_and_unload(spark, requests, DayFeed, ["day"], scratch_path(spark, "day-rows"),
                              out, RUN_AT.date())
    told = json.loads(message.split(": ", 1)[1])
    names = [n.rsplit("/", 1)[-1] for feed in told.values() for n in feed["files"]]
    back = read_unloaded(spark, out)
    return back.select("feed", "file_date", get_path(F.col("value"), "day", "string").alias("day"),
                       F.col("file_name").isin(names).alias("reported")) \
        .groupBy("feed", "file_date", "day", "reported").agg(F.count(F.lit(1)).alias("copies"))

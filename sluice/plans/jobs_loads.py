"""Registered jobs on what loads must survive: faulty headers, replaced files.

As in ``jobs_files.py`` the files hold one key range each of a driver table
and are landed by Spark first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.load import load_files, read_table_rows
from sluice.operators.load import create_entity_tables
from sluice.operators.snapshot import stage
from sluice.plans.fixtures import (file_name_col, file_name_sql, land_lines, land_table,
                                   new_landing)
from sluice.plans.jobs_core import RUN_AT, RUN_AT_KEY_TEXT
from sluice.plans.registry import register
from sluice.session import read_table, scratch_path
from sluice.streaming.ingest import run_available

CUSTOMERS_PER_FILE = 1000
ORDERS_PER_FILE = 5000

# ---------------------------------------------------------------------------
# header_isolation: customer, one entity per market segment; files with faulty
# headers sort first, so each would decide its entity's schema.  They arrive
# on a stream in one batch with the good files.

FAULTY_DATE = "20250101"
#: segment -> header line of its faulty files (those of nations below 5), and
#: the reason in the report.  A header may span lines (MACHINERY: a good one).
_FAULTY = {
    "AUTOMOBILE": ("id,name,Name", "header: column name 'Name' occurs more than once in the header"),
    "BUILDING": ("id,,balance", "header: column 2 of the header has no name"),
    "FURNITURE": ('"id,name,balance', "header: the header record does not end: a quote is left open"),
    "HOUSEHOLD": ("id,load_id,balance", "header: column name 'load_id' is taken by the table"),
}
_TWO_LINES = '"id\nno",name,"balance ""now"""'


def _segment_name(date: str) -> str:
    f = file_name_sql("@", "c_custkey", CUSTOMERS_PER_FILE, date)
    return f.replace("'@", "lower(c_mktsegment) || '", 1)


def _header_sql() -> str:
    why = " ".join(f"WHEN '{seg}' THEN '{text.replace(chr(39), chr(39) * 2)}'"
                   for seg, (_, text) in _FAULTY.items())
    faulty = f"c_nationkey < 5 AND c_mktsegment IN ({', '.join(map(repr, _FAULTY))})"
    return f"""
WITH c AS (
  SELECT *, {faulty} AS faulty,
         CASE WHEN {faulty} THEN {_segment_name(FAULTY_DATE)}
              ELSE {_segment_name('20250102')} END AS file_name
  FROM customer)
SELECT file_name, c_mktsegment AS entity,
       CASE WHEN faulty THEN 'FAILED' ELSE 'LOADED' END AS status,
       CASE WHEN faulty THEN CAST(0 AS BIGINT) ELSE count(*) END AS rows_loaded,
       CASE WHEN faulty THEN CASE c_mktsegment {why} END ELSE 'loaded' END AS message,
       CASE WHEN NOT faulty THEN CAST(sum(c_custkey) AS BIGINT) END AS sum_id,
       CASE WHEN NOT faulty THEN min(c_name) END AS min_name,
       CASE WHEN NOT faulty THEN CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) END AS sum_balance
FROM c GROUP BY file_name, c_mktsegment, faulty"""


@register("header_isolation", _header_sql())
def header_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    landing, warehouse = new_landing(spark), scratch_path(spark, "warehouse")
    seg = F.col("c_mktsegment")
    faulty = (F.col("c_nationkey") < 5) & seg.isin(*_FAULTY)
    header = F.lit("id,name,balance")
    for name, (line, _) in _FAULTY.items():
        header = F.when(faulty & (seg == name), line).otherwise(header)
    header = F.when(seg == "MACHINERY", _TWO_LINES).otherwise(header)
    base = file_name_col("@", "c_custkey", CUSTOMERS_PER_FILE, "#")
    named = customer.select(
        "c_custkey", header.alias("header"),
        F.replace(F.replace(base, F.lit("@"), F.lower(seg)), F.lit("#"),
                  F.when(faulty, FAULTY_DATE).otherwise("20250102")).alias("name"),
        F.concat_ws(",", "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)"))
        .alias("line"))
    lines = named.select("name", F.lit(-1).cast("bigint").alias("at"),
                         F.col("header").alias("line")).distinct().unionByName(
        named.select("name", F.col("c_custkey").alias("at"), "line"))
    land_lines(spark, lines, landing)
    reports: list[DataFrame] = []
    run_available(spark, landing, warehouse, scratch_path(spark, "ingest"), loaded_at=RUN_AT,
                  after_load=lambda s, w, run: reports.append(stage(s, run.report, "report")))
    values = None
    for entity in [*_FAULTY, "MACHINERY"]:
        rows = read_table_rows(spark, warehouse, entity)
        cols = rows.columns[6:9]
        rows = rows.groupBy(F.col("source_file_name").alias("file_name")).agg(
            F.sum(F.col(f"`{cols[0]}`")).cast("bigint").alias("sum_id"),
            F.min(F.col(f"`{cols[1]}`")).alias("min_name"),
            F.sum(F.col(f"`{cols[2]}`")).cast("double").alias("sum_balance"))
        values = rows if values is None else values.unionByName(rows)
    report = reports[0]
    for r in reports[1:]:
        report = report.unionByName(r)
    return report.join(values, "file_name", "left").select(
        "file_name", "entity", "status", "rows_loaded", "message", "sum_id", "min_name",
        "sum_balance")


# ---------------------------------------------------------------------------
# replaced_files: orders loaded; the files of every third key range come again
# under their names, corrected, with fewer rows; others stay as they are

_RANGE = f"(o_orderkey // {ORDERS_PER_FILE})"


def _replaced_sql() -> str:
    f = file_name_sql("orders", "o_orderkey", ORDERS_PER_FILE)
    return f"""
WITH v AS (
  SELECT *, {f} AS fname, {_RANGE} % 3 = 0 AS again FROM orders),
k AS (SELECT * FROM v WHERE NOT again OR o_orderkey % 7 <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY fname ORDER BY o_orderkey) AS rn FROM k)
SELECT fname AS source_file_name, rn AS source_file_row_number,
       md5(md5('{RUN_AT_KEY_TEXT}' || fname) || CAST(rn AS VARCHAR)) AS source_file_record_unique_key,
       o_orderkey, o_custkey,
       CASE WHEN again THEN 'fixed ' || o_orderstatus ELSE o_orderstatus END AS o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CASE WHEN again THEN 'LOADED,SKIPPED' ELSE 'SKIPPED,SKIPPED' END AS later_runs
FROM n"""


@register("replaced_files", _replaced_sql())
def replaced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    landing, warehouse = new_landing(spark), scratch_path(spark, "warehouse")

    def land(rows: DataFrame, overwrite: bool = False) -> None:
        land_table(spark, rows, landing, "orders", "o_orderkey", ORDERS_PER_FILE,
                   overwrite=overwrite)

    land(orders)
    create_entity_tables(spark, landing, warehouse)
    load_files(spark, landing, warehouse, RUN_AT)
    again = F.expr("o_orderkey div 5000 % 3 = 0")
    land(orders.where(again & (F.col("o_orderkey") % 7 != 0)).withColumn(
        "o_orderstatus", F.concat(F.lit("fixed "), "o_orderstatus")), overwrite=True)
    runs = [stage(spark, load_files(spark, landing, warehouse, RUN_AT).report, "report")
            for _ in range(2)]
    status = runs[0].select("file_name", F.col("status").alias("one")).join(
        runs[1].select("file_name", F.col("status").alias("two")), "file_name").select(
        F.col("file_name").alias("source_file_name"), F.concat_ws(",", "one", "two").alias("later_runs"))
    rows = read_table_rows(spark, warehouse, "ORDERS")
    return rows.join(status, "source_file_name").select(
        "source_file_name", "source_file_row_number", "source_file_record_unique_key",
        F.col("O_ORDERKEY").cast("bigint").alias("o_orderkey"),
        F.col("O_CUSTKEY").cast("bigint").alias("o_custkey"),
        F.col("O_ORDERSTATUS").alias("o_orderstatus"),
        F.col("O_TOTALPRICE").cast("double").alias("o_totalprice"),
        F.col("O_ORDERDATE").alias("o_orderdate"), "later_runs")

"""Registered jobs over landed files: lineage, inference, create/load, isolation.

Each job first lands driver tables as gzip CSV files (Spark writes them,
one key range per file) in a fresh folder under the shared checkpoint
root, then runs the operator on those files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import parse_date
from sluice.operators.infer import infer_schema
from sluice.operators.load import create_entity_tables, load_files, read_table_rows
from sluice.operators.snapshot import publish_named, stage
from sluice.plans.fixtures import file_name_col, file_name_sql, land_table, new_landing
from sluice.plans.jobs_core import RUN_AT, RUN_AT_KEY_TEXT
from sluice.plans.registry import register
from sluice.session import read_table, scratch_path
from sluice.sources.files import filter_names, list_files, ordered, profile
from sluice.sources.landing import (FILE_DATE_PATTERN, entity_from_file, read_landed_csv,
                                    with_lineage)

ORDERS_PER_FILE = 5000
CUSTOMERS_PER_FILE = 1000
PARTS_PER_FILE = 1000

# ---------------------------------------------------------------------------
# lineage_columns: orders -> landed files -> positional read + lineage


def _lineage_sql() -> str:
    f = file_name_sql("orders", "o_orderkey", ORDERS_PER_FILE)
    return f"""
WITH n AS (
    SELECT *, {f} AS fname,
           row_number() OVER (PARTITION BY {f} ORDER BY o_orderkey) AS rn
    FROM orders)
SELECT TIMESTAMP '2025-01-02 03:04:05' AS source_file_loaded_at_utc,
       DATE '2025-01-02' AS source_file_date_utc,
       fname AS source_file_name,
       md5('{RUN_AT_KEY_TEXT}' || fname) AS source_file_unique_key,
       rn AS source_file_row_number,
       md5(md5('{RUN_AT_KEY_TEXT}' || fname) || CAST(rn AS VARCHAR)) AS source_file_record_unique_key,
       o_orderkey, o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
       o_orderdate, o_orderpriority
FROM n"""


@register("lineage_columns", _lineage_sql())
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    landing = new_landing(spark)
    names = land_table(spark, orders, landing, "orders", "o_orderkey", ORDERS_PER_FILE)
    raw = read_landed_csv(spark, [f"{landing}/{n}" for n in names], orders.columns)
    typed = [F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
             F.col("o_custkey").cast("bigint").alias("o_custkey"),
             F.col("o_orderstatus"),
             F.col("o_totalprice").cast("double").alias("o_totalprice"),
             F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
             F.col("o_orderpriority")]
    return with_lineage(raw, RUN_AT, typed)


# ---------------------------------------------------------------------------
# infer_schema: part and supplier -> landed files -> per-file inferred types

_PART_COLS = [("p_partkey", "int"), ("p_name", "text"), ("p_brand", "text"),
              ("p_type", "text"), ("p_size", "int"), ("p_retailprice", "dec2")]
_SUPP_COLS = [("s_suppkey", "int"), ("s_name", "text"), ("s_nationkey", "int"),
              ("s_acctbal", "dec2")]


def _infer_sql_for(table: str, key: str, cols) -> list[str]:
    fname = file_name_sql(table, key, PARTS_PER_FILE)
    parts = []
    for i, (c, kind) in enumerate(cols):
        if kind == "int":
            t, n = f"'NUMBER(' || max(length(CAST({c} AS VARCHAR))) || ',0)'", "'NUMBER(38,0)'"
        elif kind == "dec2":
            digits = f"length(CAST(CAST(floor(abs(CAST({c} AS DECIMAL(18,2)))) AS BIGINT) AS VARCHAR))"
            t, n = f"'NUMBER(' || (max({digits}) + 2) || ',2)'", "'NUMBER(38,2)'"
        else:
            t, n = "'TEXT'", "'VARCHAR'"
        parts.append(f"SELECT {fname} AS file_name, '{c}' AS column_name, {i} AS order_id, "
                     f"{t} AS type, {n} AS normalised_type FROM {table} GROUP BY 1")
    return parts


INFER_SQL = "\nUNION ALL\n".join(_infer_sql_for("part", "p_partkey", _PART_COLS)
                                 + _infer_sql_for("supplier", "s_suppkey", _SUPP_COLS))


@register("infer_schema", INFER_SQL)
def infer_schema_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = new_landing(spark)
    names = land_table(spark, read_table(spark, sf_dir, "part"), landing, "part", "p_partkey",
                       PARTS_PER_FILE)
    names += land_table(spark, read_table(spark, sf_dir, "supplier"), landing, "supplier",
                        "s_suppkey", PARTS_PER_FILE)
    return infer_schema(spark, [f"{landing}/{n}" for n in names])


# ---------------------------------------------------------------------------
# create_and_load / reload_is_noop


def _counts_sql(table: str, entity: str, key: str, per_file: int, status: str,
                count_alias: str = "rows_loaded", where: str = "") -> str:
    f = file_name_sql(table, key, per_file)
    return (f"SELECT {f} AS file_name, '{entity}' AS entity, '{status}' AS status, "
            f"count(*) AS {count_alias} FROM {table} {where} GROUP BY 1")


CREATE_AND_LOAD_SQL = (_counts_sql("orders", "ORDERS", "o_orderkey", ORDERS_PER_FILE, "LOADED")
                       + "\nUNION ALL\n"
                       + _counts_sql("customer", "CUSTOMER", "c_custkey", CUSTOMERS_PER_FILE,
                                     "LOADED"))


def _land_and_load(spark: SparkSession, sf_dir: str, tables):
    landing = new_landing(spark)
    warehouse = scratch_path(spark, "warehouse")
    for name, key, per_file in tables:
        land_table(spark, read_table(spark, sf_dir, name), landing, name, key, per_file)
    create_entity_tables(spark, landing, warehouse)
    return landing, warehouse, load_files(spark, landing, warehouse, RUN_AT)


@register("create_and_load", CREATE_AND_LOAD_SQL)
def create_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, run = _land_and_load(spark, sf_dir, [("orders", "o_orderkey", ORDERS_PER_FILE),
                                               ("customer", "c_custkey", CUSTOMERS_PER_FILE)])
    return run.report.select("file_name", "entity", "status", "rows_loaded")


RELOAD_SQL = _counts_sql("customer", "CUSTOMER", "c_custkey", CUSTOMERS_PER_FILE, "SKIPPED",
                         count_alias="rows_in_table")


@register("reload_is_noop", RELOAD_SQL)
def reload_is_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, warehouse, _ = _land_and_load(spark, sf_dir,
                                           [("customer", "c_custkey", CUSTOMERS_PER_FILE)])
    second = load_files(spark, landing, warehouse, RUN_AT)
    table = read_table_rows(spark, warehouse, "CUSTOMER")
    counts = table.groupBy(F.col("source_file_name").alias("file_name")) \
        .agg(F.count(F.lit(1)).alias("rows_in_table"))
    return second.report.select("file_name", "entity", "status").join(counts, "file_name", "left")


# ---------------------------------------------------------------------------
# per_file_isolation: good customer files, files that are not gzip streams
# (BUILDING customers) and files with an extra field (MACHINERY customers),
# every file one key range, so no file grows with the table

NOT_GZIP_DATE = "20250101"  # sorts first: the file that would decide the schema
EXTRA_FIELD_DATE = "20250104"


def _isolation_sql() -> str:
    good = _counts_sql("customer", "CUSTOMER", "c_custkey", CUSTOMERS_PER_FILE, "LOADED",
                       where="WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
    bad = []
    for segment, date in (("BUILDING", NOT_GZIP_DATE), ("MACHINERY", EXTRA_FIELD_DATE)):
        f = file_name_sql("customer", "c_custkey", CUSTOMERS_PER_FILE, date)
        bad.append(f"SELECT DISTINCT {f} AS file_name, 'CUSTOMER' AS entity, 'FAILED' AS status, "
                   f"CAST(0 AS BIGINT) AS rows_loaded FROM customer "
                   f"WHERE c_mktsegment = '{segment}'")
    return good + "\nUNION ALL\n" + "\nUNION ALL\n".join(bad)


ISOLATION_SQL = _isolation_sql()


@register("per_file_isolation", ISOLATION_SQL)
def per_file_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    landing = new_landing(spark)
    warehouse = scratch_path(spark, "warehouse")
    segment = F.col("c_mktsegment")
    land_table(spark, customer.where(~segment.isin("BUILDING", "MACHINERY")), landing,
               "customer", "c_custkey", CUSTOMERS_PER_FILE)
    # named .csv.gz but written uncompressed: not a gzip stream
    land_table(spark, customer.where(segment == "BUILDING"), landing, "customer", "c_custkey",
               CUSTOMERS_PER_FILE, date=NOT_GZIP_DATE,
               options=profile("export_csv", compression="none"))
    # one more field than the table has
    land_table(spark, customer.where(segment == "MACHINERY").withColumn("extra_field", F.lit("x")),
               landing, "customer", "c_custkey", CUSTOMERS_PER_FILE, date=EXTRA_FIELD_DATE)
    create_entity_tables(spark, landing, warehouse)
    run = load_files(spark, landing, warehouse, RUN_AT)
    return run.report.select("file_name", "entity", "status", "rows_loaded")


# ---------------------------------------------------------------------------
# run_reports: the report tables of two create and load runs over the same files

def _reports_sql() -> str:
    good = file_name_sql("customer", "c_custkey", CUSTOMERS_PER_FILE)
    bad = file_name_sql("customer", "c_custkey", CUSTOMERS_PER_FILE, EXTRA_FIELD_DATE)

    def rows(name: str, where: str, status: str, n: str, first: str) -> str:
        return f"""
SELECT file_name, 'CUSTOMER' AS entity, '{status}' AS status, n AS rows_loaded,
       {'true' if status == 'LOADED' else 'false'} AS all_loaded,
       '{{"file":"' || file_name || '","rows_loaded":' || n || ',"status":"{status}"}}'
         AS result_text, '{first}' AS run
FROM (SELECT {name} AS file_name, CAST({n} AS BIGINT) AS n FROM customer WHERE {where}
      GROUP BY 1)"""

    is_bad = "c_mktsegment = 'MACHINERY'"
    return "\nUNION ALL\n".join([
        rows(good, f"NOT {is_bad}", "LOADED", "count(*)", "first"),
        rows(bad, is_bad, "FAILED", "0", "first"),
        rows(good, f"NOT {is_bad}", "SKIPPED", "0", "second"),
        rows(bad, is_bad, "FAILED", "0", "second")])


@register("run_reports", _reports_sql())
def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.procedures import (LOAD_REPORT, create_schema_and_tables,
                                         load_data_from_files)
    customer = read_table(spark, sf_dir, "customer")
    landing, warehouse = new_landing(spark), scratch_path(spark, "warehouse")
    bad = F.col("c_mktsegment") == "MACHINERY"
    land_table(spark, customer.where(~bad), landing, "customer", "c_custkey", CUSTOMERS_PER_FILE)
    land_table(spark, customer.where(bad).withColumn("extra_field", F.lit("x")), landing,
               "customer", "c_custkey", CUSTOMERS_PER_FILE, date=EXTRA_FIELD_DATE)
    create_schema_and_tables(spark, landing, warehouse)
    out = None
    for run in ("first", "second"):
        load_data_from_files(spark, landing, warehouse, RUN_AT)
        rows = stage(spark, spark.read.parquet(f"{warehouse}/{LOAD_REPORT}"), "report")
        new = (rows if out is None else rows.exceptAll(out.drop("run"))).withColumn("run", F.lit(run))
        out = new if out is None else out.unionByName(new)
    return out.select("file_name", "entity", "status", "rows_loaded", "all_loaded",
                      "result_text", "run")


# ---------------------------------------------------------------------------
# entity_from_file: names built from customer, matching and not matching

_NAME_RULE = """CASE c_mktsegment
        WHEN 'AUTOMOBILE' THEN base || '_2025_UTC.csv.gz'
        WHEN 'FURNITURE' THEN base || '_20250102030405_UTC_csv_gz'
        WHEN 'HOUSEHOLD' THEN base || '_20250102030405_UTC.csv.gz.bak'
        WHEN 'MACHINERY' THEN base || '.txt'
        ELSE base || '_2025' || lpad(CAST(c_nationkey + 1 AS STRING), 2, '0')
                  || '02030405_UTC.csv.gz' END"""

ENTITY_SQL = f"""
WITH n AS (
    SELECT c_custkey, {_NAME_RULE} AS file_name
    FROM (SELECT *, lower(replace(c_name, '#', '_')) AS base FROM customer))
SELECT c_custkey, file_name,
       upper(nullif(regexp_extract(file_name, '^(.*)_\\d{{14}}_UTC\\.csv\\.gz$', 1), '')) AS entity,
       CAST(try_strptime(regexp_extract(file_name, '_(\\d{{8}})\\d{{6}}_UTC', 1), '%Y%m%d') AS DATE)
           AS file_date
FROM n"""


@register("entity_from_file", ENTITY_SQL)
def entity_from_file_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    named = customer.withColumn("base", F.lower(F.replace("c_name", F.lit("#"), F.lit("_")))) \
        .select("c_custkey", F.expr(_NAME_RULE).alias("file_name"))
    return named.select("c_custkey", "file_name", entity_from_file("file_name").alias("entity"),
                        parse_date(F.regexp_extract("file_name", FILE_DATE_PATTERN, 1))
                        .alias("file_date"))


# ---------------------------------------------------------------------------
# file_listing: listing of landed orders and customer files, customer excluded

LISTING_SQL = f"""
SELECT DISTINCT {file_name_sql('orders', 'o_orderkey', ORDERS_PER_FILE)} AS relative_path,
       {file_name_sql('orders', 'o_orderkey', ORDERS_PER_FILE)} AS file_name,
       'ORDERS' AS entity, true AS has_bytes
FROM orders"""


@register("file_listing", LISTING_SQL)
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = new_landing(spark)
    land_table(spark, read_table(spark, sf_dir, "orders"), landing, "orders", "o_orderkey",
               ORDERS_PER_FILE)
    land_table(spark, read_table(spark, sf_dir, "customer"), landing, "customer", "c_custkey",
               CUSTOMERS_PER_FILE)
    listing = filter_names(list_files(spark, landing), exclude=r"customer_.*")
    return ordered(listing).select(
        "relative_path", "file_name", entity_from_file("file_name").alias("entity"),
        (F.col("length") > 0).alias("has_bytes"))


# ---------------------------------------------------------------------------
# clean_cells / clean_files_skip_existing: customer with junk cells -> landed
# files -> cleaned files (same names) -> read back

# Junk put into cells, chosen by the customer's nation (fixed values).
# {TAB} {NBSP} {FFFD} {FS} {US} {IDEO} stand for U+0009, U+00A0, U+FFFD,
# U+001C, U+001F and U+3000.
_JUNK_NAME = """CASE c_nationkey
        WHEN 0 THEN {TAB} || ' ' || c_name || '  '
        WHEN 1 THEN 'NA'
        WHEN 2 THEN ' NA '
        WHEN 3 THEN 'NULL'
        WHEN 4 THEN ' null '
        WHEN 5 THEN 'NaN'
        WHEN 6 THEN {NBSP} || c_name || {NBSP}
        WHEN 7 THEN ''
        WHEN 8 THEN 'None '
        WHEN 9 THEN '#N/A'
        WHEN 10 THEN c_name || {FFFD}
        WHEN 12 THEN {FS} || c_name || {US}
        WHEN 13 THEN '-nan'
        WHEN 14 THEN 'n/a '
        ELSE c_name END"""
_JUNK_SEGMENT = """CASE WHEN c_nationkey = 11 THEN ' ' || c_mktsegment || {IDEO}
        ELSE c_mktsegment END"""
_CODES = {"TAB": 9, "NBSP": 160, "FFFD": 65533, "FS": 28, "US": 31, "IDEO": 12288}


def _sql_text(expr: str) -> str:
    """The junk rule as DuckDB SQL."""
    return expr.format(**{k: f"chr({v})" for k, v in _CODES.items()})


def _spark_text(expr: str) -> str:
    """The junk rule as Spark SQL (literal characters in quotes)."""
    return expr.format(**{k: "'" + chr(v) + "'" for k, v in _CODES.items()})


def _clean_sql(x: str) -> str:
    from sluice.functions.text import (CLEANED_NULL_TOKENS, PANDAS_DEFAULT_NA,
                                       REPLACEMENT_CHAR, WHITESPACE_CLASS)
    a = ", ".join("'" + t.replace("'", "''") + "'" for t in PANDAS_DEFAULT_NA)
    b = ", ".join("'" + t + "'" for t in CLEANED_NULL_TOKENS)
    dropped = f"replace({x}, chr({ord(REPLACEMENT_CHAR)}), '')"
    stripped = (f"regexp_replace({dropped}, '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '', 'g')")
    return (f"CASE WHEN {dropped} IS NULL OR {dropped} IN ({a}) THEN NULL "
            f"WHEN {stripped} IN ({b}) THEN NULL ELSE {stripped} END")


def _junk_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    return customer.select("c_custkey", F.expr(_spark_text(_JUNK_NAME)).alias("c_name"),
                           "c_nationkey", "c_acctbal",
                           F.expr(_spark_text(_JUNK_SEGMENT)).alias("c_mktsegment"))


CLEAN_SQL = f"""
WITH j AS (
    SELECT c_custkey, {_sql_text(_JUNK_NAME)} AS c_name, c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal,
           {_sql_text(_JUNK_SEGMENT)} AS c_mktsegment
    FROM customer)
SELECT {file_name_sql('customer', 'c_custkey', CUSTOMERS_PER_FILE)} AS file_name,
       CAST(c_custkey AS VARCHAR) AS c_custkey,
       {_clean_sql('c_name')} AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_acctbal,
       {_clean_sql('c_mktsegment')} AS c_mktsegment
FROM j"""


def _read_cleaned(spark: SparkSession, target: str) -> DataFrame:
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    df = spark.read.options(header="true").schema(", ".join(f"{c} string" for c in cols)) \
        .csv(f"{target}/*.csv.gz")
    return df.select(F.col("_metadata.file_name").alias("file_name"), *cols)


@register("clean_cells", CLEAN_SQL)
def clean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.operators.clean import clean_csv_files
    landing = new_landing(spark, "raw-files")
    target = scratch_path(spark, "prepped-files")
    land_table(spark, _junk_customer(spark, sf_dir), landing, "customer", "c_custkey",
               CUSTOMERS_PER_FILE)
    clean_csv_files(spark, landing, target, on_bad_utf8="replace")
    return _read_cleaned(spark, target)


# Files that a careless cleaner cuts, tears or loses: quoted line breaks, rows
# with a field too many, a real U+FFFD, a single column with empty cells, and a
# header without rows.
HEADER_ONLY = "empty_20250102000000_UTC.csv.gz"

AWKWARD_SQL = f"""
SELECT {file_name_sql('lines', 'c_custkey', CUSTOMERS_PER_FILE)} AS file_name,
       'processed' AS status, CAST(NULL AS VARCHAR) AS reason,
       CAST(c_custkey AS VARCHAR) AS k, 'a, "b"' || chr(10) || c_name AS v
FROM customer
UNION ALL
SELECT {file_name_sql('mark', 's_suppkey', PARTS_PER_FILE)}, 'processed', NULL,
       CAST(s_suppkey AS VARCHAR), s_name || chr(65533)
FROM supplier
UNION ALL
SELECT {file_name_sql('single', 's_suppkey', PARTS_PER_FILE)}, 'processed', NULL,
       CASE WHEN s_suppkey % 3 <> 0 THEN s_name END, NULL
FROM supplier
UNION ALL
SELECT DISTINCT {file_name_sql('wide', 's_suppkey', PARTS_PER_FILE)}, 'skipped',
       'rows with more fields than the header', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM supplier
UNION ALL
SELECT '{HEADER_ONLY}', 'processed', NULL, NULL, NULL"""


def _land_raw(spark: SparkSession, df: DataFrame, landing: str, entity: str, line) -> None:
    """Files of ready lines behind the header ``k,v`` (``v`` alone for one column)."""
    name = file_name_col(entity, "s_suppkey", PARTS_PER_FILE)
    head = "v" if entity == "single" else "k,v"
    rows = df.select(name.alias("__name"), F.col("s_suppkey").alias("o"), line.alias("value"))
    heads = rows.select("__name").distinct().select("__name", F.lit(None).cast("bigint").alias("o"),
                                                    F.lit(head).alias("value"))
    tmp = f"{landing}/_tmp_raw"
    rows.unionByName(heads).repartition("__name").sortWithinPartitions("__name", "o") \
        .select("__name", "value").write.partitionBy("__name").options(compression="gzip").text(tmp)
    publish_named(spark, tmp, landing, "__name")


@register("clean_awkward_files", AWKWARD_SQL)
def clean_awkward_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.operators.clean import _write_header, clean_csv_files
    landing = new_landing(spark, "raw-files")
    target = scratch_path(spark, "prepped-files")
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    land_table(spark, customer.select("c_custkey", F.concat(F.lit('a, "b"\n'), "c_name").alias("v")),
               landing, "lines", "c_custkey", CUSTOMERS_PER_FILE)
    land_table(spark, supplier.select("s_suppkey", F.concat("s_name", F.lit("\ufffd")).alias("v")),
               landing, "mark", "s_suppkey", PARTS_PER_FILE)
    _land_raw(spark, supplier, landing, "wide", F.concat(
        F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 4 == 1, F.lit(",x,"))
        .otherwise(F.lit(",x"))))
    _land_raw(spark, supplier, landing, "single", F.when(F.col("s_suppkey") % 3 != 0,
                                                         F.col("s_name")).otherwise("NA"))
    _write_header(spark, f"{landing}/{HEADER_ONLY}", ["k", "v"], True)
    done = clean_csv_files(spark, landing, target)
    cells = spark.read.options(header="true", multiLine="true", escape='"') \
        .schema("k string, v string").csv(f"{target}/*.csv.gz") \
        .select(F.col("_metadata.file_name").alias("file_name"),
                F.nullif("k", F.lit("")).alias("k"), "v")
    files = done.report.select(F.element_at(F.split("source_file", "/"), -1).alias("file_name"),
                               "status", "reason")
    return files.join(cells, "file_name", "left")


SKIP_EXISTING_SQL = f"""
SELECT DISTINCT {file_name_sql('customer', 'c_custkey', CUSTOMERS_PER_FILE)} AS file_name,
       'skipped' AS status, 'target_exists' AS reason
FROM customer"""


@register("clean_files_skip_existing", SKIP_EXISTING_SQL)
def clean_files_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.operators.clean import clean_csv_files
    landing = new_landing(spark, "raw-files")
    target = scratch_path(spark, "prepped-files")
    land_table(spark, _junk_customer(spark, sf_dir), landing, "customer", "c_custkey",
               CUSTOMERS_PER_FILE)
    clean_csv_files(spark, landing, target, on_bad_utf8="replace")
    second = clean_csv_files(spark, landing, target, on_bad_utf8="replace")
    return second.report.select(F.element_at(F.split("source_file", "/"), -1).alias("file_name"),
                                "status", "reason")


# ---------------------------------------------------------------------------
# table_export: tables having the key column, exported ordered by it to
# compressed CSV, read back


def _export_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "accounts": read_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey"),
        "purchases": read_table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey"),
        "regions": read_table(spark, sf_dir, "region"),
    }


EXPORT_SQL = """
SELECT 'accounts' AS table_name, count(*) AS rows_exported, CAST(sum(c_custkey) AS BIGINT) AS key_sum,
       min(c_custkey) AS key_min, max(c_custkey) AS key_max FROM customer
UNION ALL
SELECT 'purchases', count(*), CAST(sum(o_custkey) AS BIGINT), min(o_custkey), max(o_custkey)
FROM orders"""


@register("table_export", EXPORT_SQL)
def table_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.sources.export import export_ordered_csv
    out = scratch_path(spark, "export")
    tables = _export_tables(spark, sf_dir)
    export_ordered_csv(spark, tables, "custkey", out, RUN_AT)
    parts = []
    for name in ("accounts", "purchases"):
        back = spark.read.options(header="true").csv(f"{out}/{name}_*.csv.gz")
        parts.append(back.select(F.lit(name).alias("table_name"),
                                 F.col("custkey").cast("bigint").alias("custkey")))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows_exported"), F.sum("custkey").alias("key_sum"), F.min("custkey").alias("key_min"), F.max("custkey").alias("key_max"))


# ---------------------------------------------------------------------------
# stream_ingest: events land in two rounds; a file stream triggers
# create -> load each round; a third run finds nothing new

EVENTS_PER_FILE = 2000
_ROUND_ONE = ("click", "view")

STREAM_SQL = f"""
WITH f AS (
    SELECT *, 'events_' || CASE WHEN event_type IN ('click', 'view') THEN '20250102'
                                ELSE '20250103' END
              || lpad(CAST(event_id // {EVENTS_PER_FILE} AS VARCHAR), 6, '0') || '_UTC.csv.gz' AS fname
    FROM events),
k AS (
    SELECT f.*, CAST(p_size AS BIGINT) AS part_size,
           md5(CAST(event_id AS VARCHAR) || CAST(coalesce(p_size, 0) AS VARCHAR)) AS key
    FROM f LEFT JOIN part ON p_partkey = event_id),
m AS (  -- the key has no delimiter: what collides with the first round is not merged again
    SELECT *, substr(fname, 8, 8) = '20250102'
              OR key NOT IN (SELECT key FROM k WHERE substr(fname, 8, 8) = '20250102') AS merged
    FROM k)
SELECT fname AS source_file_name,
       CAST(strptime(substr(fname, 8, 8), '%Y%m%d') AS DATE) AS source_file_date_utc,
       row_number() OVER (PARTITION BY fname ORDER BY event_id) AS source_file_row_number,
       CASE WHEN merged THEN key END AS lookup_key, CASE WHEN merged THEN event_id END AS event_id,
       CASE WHEN merged THEN part_size END AS part_size, ts, user_id, event_type,
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value, props
FROM m"""


@register("stream_ingest", STREAM_SQL)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.master import Side
    from sluice.plans.procedures import merge_data_to_master
    from sluice.streaming.ingest import run_available
    events = read_table(spark, sf_dir, "events")
    landing = new_landing(spark, "stream-landing")
    warehouse = scratch_path(spark, "stream-warehouse")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    first = events.where(F.col("event_type").isin(*_ROUND_ONE))
    rest = events.where(~F.col("event_type").isin(*_ROUND_ONE))
    lookup = f"{warehouse}/EVENT_LOOKUP"
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("bigint").alias("p_size"))

    def merge(session: SparkSession, wh: str, result) -> None:
        """The chain's last step: the lookup of the batch's files, merged insert-only."""
        files = result.report.where(F.col("status") == "LOADED") \
            .select(F.col("file_name").alias("source_file_name"))
        new = read_table_rows(session, wh, "EVENTS").join(files, "source_file_name", "left_semi") \
            .withColumn("EVENT_ID", F.col("EVENT_ID").cast("bigint"))
        merge_data_to_master(session, new, "EVENT_ID", "event_id",
                             [Side(part, "p_partkey", "p_size", "part_size", unique=True)],
                             "lookup_key", lookup, RUN_AT.date())

    def run() -> int:
        return run_available(spark, landing, warehouse, checkpoint, loaded_at=RUN_AT,
                             after_load=merge)

    land_table(spark, first, landing, "events", "event_id", EVENTS_PER_FILE, date="20250102")
    b1 = run()
    land_table(spark, rest, landing, "events", "event_id", EVENTS_PER_FILE, date="20250103")
    b2 = run()
    b3 = run()
    if (b1, b2, b3) != (1, 1, 0):
        raise RuntimeError(f"unexpected micro-batches per run: {(b1, b2, b3)}")
    keys = spark.read.parquet(lookup).select("source_file_name", "source_file_row_number",
                                             "lookup_key", "event_id", "part_size")
    table = read_table_rows(spark, warehouse, "EVENTS").join(
        keys, ["source_file_name", "source_file_row_number"], "left")
    return table.select(
        "source_file_name", "source_file_date_utc", "source_file_row_number", "lookup_key",
        keys["event_id"], "part_size", F.col("TS").alias("ts"),
        F.col("USER_ID").cast("bigint").alias("user_id"), F.col("EVENT_TYPE").alias("event_type"),
        F.col("VALUE").cast("double").alias("value"), F.col("PROPS").alias("props"))

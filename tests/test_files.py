"""File operators on small generated files."""

from __future__ import annotations

import datetime as dt
import decimal
import gzip
import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.operators.clean import clean_csv_files
from sluice.operators.infer import infer_schema, table_schema
from sluice.operators.load import (create_entity_tables, load_files, read_table_rows, verify,
                                   verify_summary)
from sluice.operators.snapshot import list_status
from sluice.sources.export import export_ordered_csv
from sluice.sources.files import discover_files, filter_names, list_files
from sluice.sources.jdbc import discovery_query, literal, quantile_query, range_predicates
from sluice.sources.landing import entity_from_file, read_landed_csv, with_lineage
from sluice.sources import streams
from sluice.sources.streams import DRIVER_MOVES
from sluice.sources.unload import read_unloaded, unload_json
from sluice.streaming.ingest import has_new_files, run_available

RUN = dt.datetime(2025, 1, 2, 3, 4, 5)
SF_TINY = "/root/testdata/sf0.001"


def gz(path: str, text: str | bytes) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wb") as f:
        f.write(text.encode("utf-8") if isinstance(text, str) else text)
    return path


def test_entity_from_file(spark):
    names = ["customer_20250102030405_UTC.csv.gz", "customer_2025_UTC.csv.gz", "notes.txt",
             "a_b_20250102030405_UTC.csv.gz", "x_20250102030405_UTCxcsvxgz"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(entity_from_file("n")).collect()]
    assert got == ["CUSTOMER", None, None, "A_B", None]


def test_infer_mixed_scale_and_types(spark, tmp):
    p = gz(f"{tmp}/l/t_20250102030405_UTC.csv.gz",
           "id,amount,flag,day,at,name,empty\n"
           "1,1.5,true,2024-01-02,2024-01-02 03:04:05,a,\n"
           "007,-12.25,FALSE,2024-02-03,2024-01-02T03:04:05.123,b,\n"
           "12345,3,true,2024-03-04,2024-01-02 03:04:05,10,\n")
    rows = {r["column_name"]: (r["type"], r["normalised_type"], r["order_id"])
            for r in infer_schema(spark, [p]).collect()}
    assert rows["id"] == ("NUMBER(5,0)", "NUMBER(38,0)", 0)
    assert rows["amount"] == ("NUMBER(4,2)", "NUMBER(38,2)", 1)
    assert rows["flag"][0] == "BOOLEAN"
    assert rows["day"] == ("DATE", "VARCHAR", 3)
    assert rows["at"][0] == "TIMESTAMP_NTZ"
    assert rows["name"] == ("TEXT", "VARCHAR", 5)
    assert rows["empty"][0] == "TEXT"


def test_discovery_skips_empty_and_header_only(spark, tmp):
    gz(f"{tmp}/d/a_20250102030405_UTC.csv.gz", "x\n1\n")
    gz(f"{tmp}/d/b_20250102030405_UTC.csv.gz", "x\n")
    gz(f"{tmp}/d/c_20250102030405_UTC.csv.gz", "")
    got = [r[0] for r in discover_files(spark, f"{tmp}/d").collect()]
    assert got == ["a_20250102030405_UTC.csv.gz"]
    listing = filter_names(list_files(spark, f"{tmp}/d"), exclude=r"b_.*")
    assert sorted(r["file_name"] for r in listing.collect()) == [
        "a_20250102030405_UTC.csv.gz", "c_20250102030405_UTC.csv.gz"]


def test_lineage_row_numbers_and_keys(spark, tmp):
    p1 = gz(f"{tmp}/l/t_20250102030405_UTC.csv.gz", "a,b\n" + "".join(f"{i},x{i}\n" for i in range(50)))
    p2 = gz(f"{tmp}/l/t_20250103000000_UTC.csv.gz", "a,b\n9,y\n8,z\n")
    df = with_lineage(read_landed_csv(spark, [p1, p2], ["a", "b"]), RUN)
    rows = {(r["source_file_name"], r["a"]): r for r in df.collect()}
    r = rows[("t_20250103000000_UTC.csv.gz", "8")]
    assert r["source_file_row_number"] == 2 and r["source_file_date_utc"] == dt.date(2025, 1, 3)
    import hashlib
    fk = hashlib.md5(b"2025-01-02 03:04:05.000 +0000t_20250103000000_UTC.csv.gz").hexdigest()
    assert r["source_file_unique_key"] == fk
    assert r["source_file_record_unique_key"] == hashlib.md5((fk + "2").encode()).hexdigest()
    assert rows[("t_20250102030405_UTC.csv.gz", "49")]["source_file_row_number"] == 50


def test_create_load_reload_isolation(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    gz(f"{land}/cust_20250102000000_UTC.csv.gz", "id,amt\n1,1.5\n2,2.25\n")
    gz(f"{land}/cust_20250103000000_UTC.csv.gz", "id,amt,extra\n3,1.123,zz\n")  # wider scale, new col
    gz(f"{land}/cust_20250104000000_UTC.csv.gz", "id,amt\n4,abc\n")               # bad value
    body = gzip.compress(b"id,amt\n" + b"".join(b"%d,%d.5\n" % (i, i * 7919 % 1000)
                                                 for i in range(5000)))
    with open(f"{land}/cust_20250105000000_UTC.csv.gz", "wb") as f:               # truncated gzip
        f.write(body[: len(body) // 2])
    gz(f"{land}/notes_2025_UTC.csv.gz", "x\n1\n")                                  # no entity
    created = create_entity_tables(spark, land, wh)
    assert [r["entity"] for r in created.collect()] == ["CUST"]
    schema = table_schema(spark, f"{wh}/CUST")
    assert [f.name for f in schema.fields][6:] == ["ID", "AMT"]   # first file decides
    run = load_files(spark, land, wh, RUN)
    st = {r["file_name"]: (r["status"], r["rows_loaded"]) for r in run.report.collect()}
    assert st["cust_20250102000000_UTC.csv.gz"] == ("LOADED", 2)
    assert st["cust_20250103000000_UTC.csv.gz"][0] == "FAILED"   # 3 fields for 2 columns
    assert st["cust_20250104000000_UTC.csv.gz"][0] == "FAILED"
    assert st["cust_20250105000000_UTC.csv.gz"][0] == "FAILED"
    summary = verify_summary(run.report).first()
    assert summary["all_loaded"] is False and summary["files_loaded"] == 1
    per_file = {r["file_name"]: r for r in verify(run.report).collect()}
    ok = per_file["cust_20250102000000_UTC.csv.gz"]
    assert ok["all_loaded"] and '"status":"LOADED"' in ok["result_text"]
    assert per_file["cust_20250104000000_UTC.csv.gz"]["all_loaded"] is False
    again = load_files(spark, land, wh, RUN)
    st2 = {r["file_name"]: r["status"] for r in again.report.collect()}
    assert st2["cust_20250102000000_UTC.csv.gz"] == "SKIPPED"
    table = read_table_rows(spark, wh, "CUST")
    assert sorted(float(r["AMT"]) for r in table.collect()) == [1.5, 2.25]
    assert str(table.schema["AMT"].dataType) == "DecimalType(38,2)"
    assert has_new_files(spark, land, wh)  # failed files are still pending


def test_orphan_load_folder_is_never_read_and_dropped_when_old(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    gz(f"{land}/t_20250102000000_UTC.csv.gz", "id\n1\n")
    create_entity_tables(spark, land, wh)
    load_files(spark, land, wh, RUN)
    # a run that is under way or broke off: data folder written, ledger not
    rows = read_table_rows(spark, wh, "T").drop("load_id")
    crashed = f"{wh}/T/load_id=crashed"
    rows.write.parquet(crashed)
    gz(f"{land}/t_20250103000000_UTC.csv.gz", "id\n2\n")
    load_files(spark, land, wh, RUN)
    assert os.path.exists(crashed) and read_table_rows(spark, wh, "T").count() == 2
    old = dt.datetime.now().timestamp() - 2 * 86400
    os.utime(f"{wh}/T/load_id=crashed", (old, old))
    gz(f"{land}/t_20250104000000_UTC.csv.gz", "id\n3\n")
    load_files(spark, land, wh, RUN)
    assert not os.path.exists(crashed) and read_table_rows(spark, wh, "T").count() == 3


def test_replaced_file_of_equal_length_is_loaded(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    path = f"{land}/t_20250102000000_UTC.csv.gz"
    gz(path, "id\n1\n")
    os.utime(path, (1_700_000_000, 1_700_000_000))
    create_entity_tables(spark, land, wh)
    load_files(spark, land, wh, RUN)
    gz(path, "id\n2\n")
    os.utime(path, (1_700_000_500, 1_700_000_500))
    rep = load_files(spark, land, wh, RUN).report.collect()
    assert [r["status"] for r in rep] == ["LOADED"]
    again = load_files(spark, land, wh, RUN).report.collect()
    assert [r["status"] for r in again] == ["SKIPPED"]


def test_cut_second_gzip_member_is_found(spark, tmp):
    from sluice.operators.load import check_compression
    os.makedirs(f"{tmp}/z")
    one, two = gzip.compress(b"a\n1\n"), gzip.compress(b"2\n3\n" * 50)
    for name, data in (("good", one + two), ("cut", one + two[:-9]), ("single", one)):
        with open(f"{tmp}/z/{name}.csv.gz", "wb") as f:
            f.write(data)
    bad = check_compression(spark, [f"{tmp}/z/{n}.csv.gz" for n in ("good", "cut", "single")])
    assert [p.rsplit("/", 1)[1] for p in bad] == ["cut.csv.gz"]


def test_clean_files(spark, tmp):
    src, dst = f"{tmp}/raw", f"{tmp}/prep"
    gz(f"{src}/a_20250102000000_UTC.csv.gz",
       "id,name\n" + "".join(f"{i},\" n{i} \"\n" for i in range(300)) + "x,NA\ny, NA \nz,null\n")
    gz(f"{src}/b_20250102000000_UTC.csv.gz", b"id,name\n1,ok\xff\n")
    res = clean_csv_files(spark, src, dst, on_bad_utf8="skip")
    summary = json.loads(res.summary)
    assert [s["skipped file"].endswith("b_20250102000000_UTC.csv.gz")
            for s in summary["skipped_files"]] == [True]
    with gzip.open(f"{dst}/a_20250102000000_UTC.csv.gz", "rt") as f:
        lines = f.read().splitlines()
    assert lines[0] == "id,name" and lines[1] == "0,n0" and lines[300] == "299,n299"
    assert lines[301:] == ["x,", "y,NA", "z,"]
    again = clean_csv_files(spark, src, dst, on_bad_utf8="replace")
    reasons = {r["source_file"].rsplit("/", 1)[1]: r["reason"] for r in again.report.collect()}
    assert reasons["a_20250102000000_UTC.csv.gz"] == "target_exists"
    with gzip.open(f"{dst}/b_20250102000000_UTC.csv.gz", "rt") as f:
        assert f.read().splitlines()[1] == "1,ok"


def test_unload_caps_and_names(spark, tmp):
    rows = [("neo", '{"i": %d, "pad": "%s"}' % (i, "x" * 50)) for i in range(400)] + \
           [("tle", '{"i": 1}')]
    df = spark.createDataFrame(rows, "api_name string, s string").select(
        "api_name", F.parse_json("s").alias("json_response"))
    out = unload_json(spark, df, f"{tmp}/u", dt.date(2025, 1, 2), max_file_size=8000)
    feeds = {r["feed"]: r for r in out.collect()}
    assert feeds["tle"]["files"] == ["tle_20250102.json.gz"] and feeds["tle"]["rows_unloaded"] == 1
    assert len(feeds["neo"]["files"]) >= 3 and feeds["neo"]["rows_unloaded"] == 400
    assert 0 < feeds["neo"]["output_bytes"] < feeds["neo"]["input_bytes"]
    back = read_unloaded(spark, f"{tmp}/u")
    assert back.count() == 401 and back.where(F.col("feed") == "neo").count() == 400
    for name in feeds["neo"]["files"]:
        with gzip.open(f"{tmp}/u/{name}", "rb") as f:
            assert len(f.read()) <= 8000
    unload_json(spark, df.limit(20), f"{tmp}/u", dt.date(2025, 1, 2), max_file_size=8000)
    assert read_unloaded(spark, f"{tmp}/u").where(F.col("feed") == "neo").count() <= 20
    with pytest.raises(ValueError):
        unload_json(spark, df, f"{tmp}/u2", dt.date(2025, 1, 2), max_file_size=8000, single=True)


def test_unload_again_into_many_files(spark, tmp):
    """The first run's few files are renamed by the driver, the second run's many by
    tasks: what the first one leaves beside its files must not spoil the new ones."""
    def rows(n: int, pad: str):
        return spark.range(n).select(F.lit("f").alias("api_name"), F.parse_json(F.concat(
            F.lit('{"i":'), F.col("id").cast("string"), F.lit(f',"p":"{pad}"}}'))).alias("json_response"))

    first = unload_json(spark, rows(200, "a"), f"{tmp}/u", dt.date(2025, 1, 2), max_file_size=500)
    second = unload_json(spark, rows(3000, "b"), f"{tmp}/u", dt.date(2025, 1, 2), max_file_size=500)
    few, many = len(first.first()["files"]), len(second.first()["files"])
    assert 1 < few <= DRIVER_MOVES < many
    back = read_unloaded(spark, f"{tmp}/u").select(F.to_json("value").alias("v")).collect()
    assert sorted(json.loads(r["v"])["i"] for r in back) == list(range(3000))
    assert {json.loads(r["v"])["p"] for r in back} == {"b"}


def test_listing_and_checksums(spark, tmp):
    for name, text in (("new/part-0", "new text"), ("old/a b=c", "old")):
        spark.range(1).select(F.lit(text)).coalesce(1).write.text(f"{tmp}/w/{name}")
    at = {n: next(f for f in list_status(spark, f"{tmp}/w/{n}") if f[0].startswith("part-"))
          for n in ("new/part-0", "old/a b=c")}
    src, dst = at["new/part-0"], at["old/a b=c"]
    assert src[1] == f"file:{tmp}/w/new/part-0/{src[0]}" and src[2] == 9 and not src[3]
    assert {f[0] for f in list_status(spark, f"{tmp}/w/old/a b=c")} == {"_SUCCESS", dst[0]}
    assert list_status(spark, f"{tmp}/none") == []
    assert streams._move(src[1], dst[1], True) is None
    assert [r[0] for r in spark.read.text(dst[1]).collect()] == ["new text"]
    assert os.path.exists(f"{tmp}/w/old/a b=c/.{dst[0]}.crc")  # still checked
    assert not os.path.exists(f"{tmp}/w/new/part-0/.{src[0]}.crc")


def test_unload_splits_equal_rows(spark, tmp):
    df = spark.range(500).select(F.lit("f").alias("api_name"),
                                 F.parse_json(F.lit('{"a": "ü"}')).alias("json_response"))
    out = unload_json(spark, df, f"{tmp}/u", dt.date(2025, 1, 2), max_file_size=1000).first()
    assert len(out["files"]) >= 6 and out["input_bytes"] == 500 * 11
    assert read_unloaded(spark, f"{tmp}/u").count() == 500


def test_requests_spread_and_failures_land(spark, tmp):
    from sluice.sources.api import fetch_responses, land_responses

    class Fetch:
        def __call__(self, n=None):
            if n is None:
                return {"all": True}
            if int(n) % 10 == 0:
                raise RuntimeError("down")
            return "not json" if int(n) % 10 == 1 else {"n": n}

    req = spark.range(300).select(F.lit("f").alias("api_name"), F.col("id").alias("n")).coalesce(1)
    got = fetch_responses(req, Fetch, ["n"], requests_per_task=50)
    assert got.rdd.getNumPartitions() == 6
    err = f"{tmp}/errors"
    rows = land_responses(req, Fetch, ["n"], dt.date(2025, 1, 2), strict=False, errors_path=err)
    assert rows.count() == 240
    assert {r["error"] for r in spark.read.parquet(err).collect()} == {
        "RuntimeError: down", "answer is not JSON"}
    assert spark.read.parquet(err).count() == 60
    with pytest.raises(Exception, match="down"):
        land_responses(req.where("n % 10 <> 1"), Fetch, ["n"], dt.date(2025, 1, 2)).collect()
    one = land_responses(req.select("api_name").limit(1), Fetch, [], dt.date(2025, 1, 2))
    assert one.select(F.to_json("json_response")).first()[0] == '{"all":true}'


def test_stream_runs_only_on_new_files(spark, tmp):
    land, wh, ck = f"{tmp}/land", f"{tmp}/wh", f"{tmp}/ck"
    gz(f"{land}/e_20250102000000_UTC.csv.gz", "id\n1\n2\n")
    assert run_available(spark, land, wh, ck, loaded_at=RUN) == 1
    assert run_available(spark, land, wh, ck, loaded_at=RUN) == 0
    gz(f"{land}/e_20250103000000_UTC.csv.gz", "id\n3\n")
    assert run_available(spark, land, wh, ck, loaded_at=RUN) == 1
    assert read_table_rows(spark, wh, "E").count() == 3


def test_stream_batches_load_their_own_files(spark, tmp):
    land, wh, ck = f"{tmp}/land", f"{tmp}/wh", f"{tmp}/ck"
    for d in range(1, 5):
        gz(f"{land}/e_2025010{d}000000_UTC.csv.gz", f"id\n{d}\n")
    sizes = []
    n = run_available(spark, land, wh, ck, loaded_at=RUN, max_files_per_trigger=1,
                      after_load=lambda s, w, r: sizes.append(
                          r.report.where(F.col("status") == "LOADED").count()))
    assert n == 4 and sizes == [1, 1, 1, 1]
    assert read_table_rows(spark, wh, "E").count() == 4


def test_export_guard_and_order(spark, tmp):
    df = spark.range(0, 1000).select((999 - F.col("id")).alias("k"), F.lit("v").alias("v"))
    out = f"{tmp}/exp"
    rep = export_ordered_csv(spark, {"t": df.repartition(4), "u": df.drop("k")}, "k", out, RUN)
    names = [r["file_name"] for r in rep.collect()]
    assert all(n.startswith("t_20250102030405_UTC") for n in names)
    keys = []
    for n in sorted(names):
        with gzip.open(f"{out}/{n}", "rt") as f:
            keys += [int(line.split(",")[0]) for line in f.read().splitlines()[1:]]
    assert keys == list(range(1000))
    with pytest.raises(FileExistsError):
        export_ordered_csv(spark, {"t": df}, "k", out, RUN)


def test_jdbc_table_that_cannot_be_read_does_not_stop_the_others(spark, tmp, monkeypatch):
    from sluice.sources import jdbc

    def read(spark_, url, table, key, properties=None):
        if table[1] == "b":
            raise RuntimeError("no such type")
        return spark_.createDataFrame([(2, "x"), (1, "y")], "id int, v string")

    monkeypatch.setattr(jdbc, "jdbc_tables_with_column", lambda *a: ["a", "b", "c"])
    monkeypatch.setattr(jdbc, "jdbc_read_table", read)
    rep = jdbc.jdbc_to_landing(spark, "jdbc:none", "s", "id", f"{tmp}/out", RUN).collect()
    assert sorted((r["table_name"], r["status"]) for r in rep) == [
        ("a", "exported"), ("b", "failed"), ("c", "exported")]
    assert jdbc.quoted("s", 'a"b') == '"s"."a""b"'


def test_jdbc_option_building():
    q = discovery_query("clinic", "master_patient_id")
    assert "table_schema = 'clinic'" in q and "column_name = 'master_patient_id'" in q
    assert discovery_query("o'x", "c").count("'o''x'") == 1
    assert [literal(v) for v in (7, decimal.Decimal("1E+2"), "o'x", dt.date(2025, 1, 2), RUN)] == [
        "7", "100", "'o''x'", "DATE '2025-01-02'", "TIMESTAMP '2025-01-02 03:04:05.000000'"]
    assert [literal(v) for v in (1.5, True, b"x", "a\\b", None)] == [None] * 5
    assert range_predicates("k", [1, 1, 4, 9, 9]) == ["k < 4 OR k IS NULL", "k >= 4 AND k < 9",
                                                     "k >= 9"]
    assert range_predicates("k", []) == range_predicates("k", [3, 3]) == []
    assert range_predicates("k", [1.5, 2.5]) == []


class _Reader:
    """``spark.read.jdbc`` over an in-process SQL engine; keeps what was asked."""

    def __init__(self, spark, con):
        self.spark, self.con, self.asked = spark, con, []
        self.read = self

    def jdbc(self, url, table, predicates=None, properties=None):
        self.asked.append((table, predicates))
        frames = [self.con.execute(f"SELECT * FROM {table} WHERE {p}").to_arrow_table()
                  for p in predicates or ["true"]]
        self.sizes = [f.num_rows for f in frames]
        return self.spark.createDataFrame(pa.concat_tables(frames))


@pytest.mark.parametrize("key", ["skewed", "l_shipdate", "name", "l_quantity", "flag"])
def test_jdbc_ranges_follow_the_keys_quantiles(spark, key):
    """Every row is read once, NULL keys too; the ranges hold as many rows
    each on skewed, date, text and decimal keys, and one hot key is one range."""
    import duckdb

    from sluice.sources.jdbc import jdbc_read_table
    con = duckdb.connect()
    con.execute(f"""CREATE TABLE t AS SELECT l_orderkey, l_linenumber, l_shipdate,
        CAST(l_quantity AS DECIMAL(12, 2)) AS l_quantity, l_returnflag AS flag,
        CASE WHEN l_orderkey % 7 > 0 THEN l_orderkey ** 3 END AS cube,
        CAST(CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey ** 3 END AS BIGINT) AS skewed,
        'O' || chr(39) || l_returnflag || l_orderkey AS name
        FROM read_parquet('{SF_TINY}/lineitem.parquet')""")
    n = con.execute("SELECT count(*) FROM t").fetchone()[0]
    reader = _Reader(spark, con)
    got = jdbc_read_table(reader, "jdbc:none", ("main", "t"), key,
                          rows_per_partition=n // 10, max_connections=8)
    rows = sorted((r["l_orderkey"], r["l_linenumber"]) for r in got.collect())
    assert rows == con.execute("SELECT l_orderkey, l_linenumber FROM t ORDER BY ALL").fetchall()
    keys = con.execute(f"SELECT count(DISTINCT {key}) FROM t").fetchone()[0]
    nulls, hot = (con.execute(q).fetchone()[0] or 0 for q in (
        f"SELECT count(*) FROM t WHERE {key} IS NULL",
        f"SELECT max(c) FROM (SELECT count(*) c FROM t WHERE {key} IS NOT NULL GROUP BY {key})"))
    assert 1 < len(reader.sizes) <= 8 and (keys < 100 or len(reader.sizes) == 8)
    assert max(reader.sizes) <= n / 8 + nulls + 2 * hot
    one = jdbc_read_table(reader, "jdbc:none", ("main", "t"), "cube", rows_per_partition=n // 10)
    assert one.count() == n and reader.asked[-1][1] is None  # floats: one connection
    jdbc_read_table(reader, "jdbc:none", ("main", "t"), key, rows_per_partition=n)
    assert reader.asked[-1][1] is None                       # one range


def test_replayed_batch_adds_no_rows(spark, tmp):
    """foreachBatch is at-least-once: running the chain again for the same
    files (a replayed micro-batch) must not duplicate rows."""
    from sluice.streaming.ingest import run_chain
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    gz(f"{land}/e_20250102000000_UTC.csv.gz", "id,v\n1,a\n2,b\n")
    run_chain(spark, land, wh, RUN)
    run_chain(spark, land, wh, RUN)  # replay
    assert read_table_rows(spark, wh, "E").count() == 2


def test_stream_archives_committed_files(spark, tmp):
    land, wh, ck, arc = f"{tmp}/land", f"{tmp}/wh", f"{tmp}/ck", f"{tmp}/archive"
    gz(f"{land}/e_20250102000000_UTC.csv.gz", "id\n1\n")
    assert run_available(spark, land, wh, ck, loaded_at=RUN, clean_source="archive",
                         archive_dir=arc) == 1
    gz(f"{land}/e_20250103000000_UTC.csv.gz", "id\n2\n")
    assert run_available(spark, land, wh, ck, loaded_at=RUN, clean_source="archive",
                         archive_dir=arc) == 1
    archived = [f for _, _, fs in os.walk(arc) for f in fs if f.endswith(".gz")]
    assert "e_20250102000000_UTC.csv.gz" in archived
    assert read_table_rows(spark, wh, "E").count() == 2


def test_stream_landed_rows_with_file_names(spark, tmp):
    from sluice.streaming.ingest import stream_landed_csv
    land = f"{tmp}/land"
    gz(f"{land}/e_20250102000000_UTC.csv.gz", "id,v\n1,a\n2,b\n")
    rows = []

    def keep(batch, _):
        rows.extend(tuple(r) for r in batch.collect())

    q = (stream_landed_csv(spark, land, ["id", "v"]).writeStream.foreachBatch(keep)
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(rows) == [("1", "a", "e_20250102000000_UTC.csv.gz"),
                            ("2", "b", "e_20250102000000_UTC.csv.gz")]


def test_create_skips_empty_first_file(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    gz(f"{land}/p_20250101000000_UTC.csv.gz", "")                       # no row 1
    gz(f"{land}/p_20250102000000_UTC.csv.gz", "id,amt\n1,2.5\n")
    rows = {r["entity"]: r for r in create_entity_tables(spark, land, wh).collect()}
    assert rows["P"]["created"] and rows["P"]["file_name"] == "p_20250102000000_UTC.csv.gz"
    assert [f.name for f in table_schema(spark, f"{wh}/P").fields][6:] == ["ID", "AMT"]
    again = {r["entity"]: r for r in create_entity_tables(spark, land, wh).collect()}
    assert again["P"]["created"] is False and again["P"]["columns"] == "exists"


def test_row_number_in_splittable_file(spark, tmp):
    """An uncompressed file read in many splits still gets 1..n in file order."""
    os.makedirs(f"{tmp}/plain", exist_ok=True)
    p = f"{tmp}/plain/t_20250102000000_UTC.csv"
    with open(p, "w") as f:
        f.write("a,b\n" + "".join(f"{i},row{i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = read_landed_csv(spark, [p], ["a", "b"])
        assert raw.select("__split").distinct().count() > 5          # really split
        got = {int(r["a"]): r["source_file_row_number"]
               for r in with_lineage(raw, RUN).select("a", "source_file_row_number").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: i + 1 for i in range(5000)}


def test_abort_on_error_commits_nothing(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    gz(f"{land}/c_20250102000000_UTC.csv.gz", "id\n1\n")
    gz(f"{land}/c_20250103000000_UTC.csv.gz", "id\nnot-a-number\n")
    create_entity_tables(spark, land, wh)
    with pytest.raises(RuntimeError):
        load_files(spark, land, wh, RUN, on_error="abort")
    assert read_table_rows(spark, wh, "C").count() == 0
    assert not os.path.exists(f"{wh}/_ledger")


def test_clean_split_uncompressed_file_keeps_order(spark, tmp):
    os.makedirs(f"{tmp}/raw", exist_ok=True)
    with open(f"{tmp}/raw/p.csv", "w") as f:
        f.write("id,v\n" + "".join(f"{i}, v{i} \n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        clean_csv_files(spark, f"{tmp}/raw", f"{tmp}/prep")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with open(f"{tmp}/prep/p.csv") as f:              # still plain text
        lines = f.read().splitlines()
    assert lines == ["id,v"] + [f"{i},v{i}" for i in range(4000)]


def test_catalog_discovery_and_source_delete(spark, tmp):
    from sluice.sources.export import catalog_tables_with_column, tables_with_column
    a = spark.createDataFrame([(1, "x")], "master_patient_id bigint, v string")
    b = spark.createDataFrame([(2,)], "other bigint")
    a.createOrReplaceTempView("sluice_t_a")
    b.createOrReplaceTempView("sluice_t_b")
    assert "sluice_t_a" in catalog_tables_with_column(spark, "master_patient_id")
    assert "sluice_t_b" not in catalog_tables_with_column(spark, "master_patient_id")
    assert tables_with_column({"b": b, "a": a}, "master_patient_id") == ["a"]
    gz(f"{tmp}/raw/a_20250102000000_UTC.csv.gz", "c\nx\n")
    clean_csv_files(spark, f"{tmp}/raw", f"{tmp}/prep", source_action="delete")
    assert not os.path.exists(f"{tmp}/raw/a_20250102000000_UTC.csv.gz")
    assert os.path.exists(f"{tmp}/prep/a_20250102000000_UTC.csv.gz")


def test_pretty_json_and_object_text(spark):
    from sluice.functions import object_text, pretty_json
    df = spark.createDataFrame([(1, None, "s")], "a int, b string, c string")
    assert df.select(object_text("a", "b", "c")).first()[0] == '{"a":1,"c":"s"}'  # NULL dropped
    text = df.select(pretty_json(F.struct("a", "c"))).first()[0]
    assert json.loads(text) == {"a": 1, "c": "s"} and "\n" in text


def test_stream_with_interval_trigger(spark, tmp):
    from sluice.streaming.ingest import ingest_stream
    land, wh, ck = f"{tmp}/land", f"{tmp}/wh", f"{tmp}/ck"
    gz(f"{land}/e_20250102000000_UTC.csv.gz", "id\n1\n2\n")
    q = ingest_stream(spark, land, wh, ck, trigger="1 second", loaded_at=RUN)
    try:
        q.processAllAvailable()
        gz(f"{land}/e_20250103000000_UTC.csv.gz", "id\n3\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_table_rows(spark, wh, "E").count() == 3


def _row_numbers_ok(spark, wh, entity):
    t = read_table_rows(spark, wh, entity)
    got = sorted((r["source_file_name"], r["source_file_row_number"], int(r["ID"]))
                 for r in t.collect())
    # files hold ids k*100 .. k*100+n-1 in order: row number = id - k*100 + 1
    return all(rn == i - int(f.split("_")[1][8:]) * 100 + 1 for f, rn, i in got), len(got)


def test_load_row_numbers_one_scan_and_fallback(spark, tmp, monkeypatch):
    import sluice.operators.load as L
    calls = []
    real = L._write_pass

    def spy(*a, **k):
        res = real(*a, **k)
        calls.append((a[-1], res is not None))
        return res
    monkeypatch.setattr(L, "_write_pass", spy)
    for mode, cost in (("one", L.ONE_FILE_OPEN_COST), ("packed", "0")):
        land, wh = f"{tmp}/{mode}/land", f"{tmp}/{mode}/wh"
        for k, n in ((0, 7), (1, 30), (2, 1)):
            gz(f"{land}/e_20250102{k:06d}_UTC.csv.gz",
               "id\n" + "".join(f"{k * 100 + i}\n" for i in range(n)))
        monkeypatch.setattr(L, "ONE_FILE_OPEN_COST", cost)
        calls.clear()
        create_entity_tables(spark, land, wh)
        # one input partition would take all three small files if allowed
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        try:
            load_files(spark, land, wh, RUN)
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        ok, n = _row_numbers_ok(spark, wh, "E")
        assert ok and n == 38
        if mode == "one":
            assert calls == [(True, True)]                  # one scan, check passed
        else:
            assert calls == [(True, False), (False, True)]  # packed -> fallback


def test_clean_skips_truncated_gzip(spark, tmp):
    gz(f"{tmp}/raw/a_20250102000000_UTC.csv.gz", "c\n x \n")
    body = gzip.compress(b"c\n" + b"".join(b"%d\n" % (i * 7919 % 100003) for i in range(20000)))
    with open(f"{tmp}/raw/b_20250102000000_UTC.csv.gz", "wb") as f:
        f.write(body[: len(body) // 2])
    res = clean_csv_files(spark, f"{tmp}/raw", f"{tmp}/prep")
    status = {r["source_file"].rsplit("/", 1)[1]: r["status"] for r in res.report.collect()}
    assert status == {"a_20250102000000_UTC.csv.gz": "processed",
                      "b_20250102000000_UTC.csv.gz": "skipped"}


def test_clean_same_name_in_two_folders(spark, tmp):
    gz(f"{tmp}/raw/east/x_20250102000000_UTC.csv.gz", "c\n east \n")
    gz(f"{tmp}/raw/west/x_20250102000000_UTC.csv.gz", "c\n west \n")
    res = clean_csv_files(spark, f"{tmp}/raw", f"{tmp}/prep")
    assert sorted(r["status"] for r in res.report.collect()) == ["processed", "processed"]
    for side in ("east", "west"):
        with gzip.open(f"{tmp}/prep/{side}/x_20250102000000_UTC.csv.gz", "rt") as f:
            assert f.read().splitlines() == ["c", side]


def test_load_refuses_duplicate_names(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    gz(f"{land}/a/t_20250102000000_UTC.csv.gz", "id\n1\n")
    gz(f"{land}/b/t_20250102000000_UTC.csv.gz", "id\n2\n")
    gz(f"{land}/t_20250103000000_UTC.csv.gz", "id\n3\n")
    create_entity_tables(spark, land, wh)
    st = sorted((r["file_name"], r["status"]) for r in load_files(spark, land, wh, RUN).report.collect())
    assert st == [("t_20250102000000_UTC.csv.gz", "FAILED"), ("t_20250102000000_UTC.csv.gz", "FAILED"),
                  ("t_20250103000000_UTC.csv.gz", "LOADED")]


def test_export_splits_a_hot_key(spark, tmp):
    """90% of rows share one key: the tie-breaker lets the range partitioner
    spread that key over several part files, still in key order."""
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(5)).alias("k"),
        F.col("id").alias("v"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # keep the range split visible
    spark.conf.set(key, "false")
    try:
        rep = export_ordered_csv(spark, {"t": df}, "k", f"{tmp}/exp", RUN)
    finally:
        spark.conf.set(key, "true")
    names = sorted(r["file_name"] for r in rep.collect())
    keys_per_file = []
    for n in names:
        with gzip.open(f"{tmp}/exp/{n}", "rt") as f:
            keys_per_file.append([int(x.split(",")[0]) for x in f.read().splitlines()[1:]])
    with_hot = [ks for ks in keys_per_file if 5 in ks]
    assert len(with_hot) > 1                                   # the hot key is split
    flat = [k for ks in keys_per_file for k in ks]
    assert flat == sorted(flat) and len(flat) == 20000        # whole and ordered

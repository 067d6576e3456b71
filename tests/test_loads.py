"""Headers, streams, the ledger, and what loads must survive."""

from __future__ import annotations

import datetime as dt
import gzip
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import ledger as lg
from sluice.operators import load as ld
from sluice.operators.clean import clean_csv_files
from sluice.operators.infer import infer_schema, table_schema
from sluice.sources import streams
from sluice.sources.headers import Header, distinct_names, header_fault, read_header, read_headers

RUN = dt.datetime(2025, 1, 2, 3, 4, 5)
OPEN = "the header record does not end: a quote is left open"


def gz(path: str, text: str | bytes) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wb") as f:
        f.write(text.encode("utf-8") if isinstance(text, str) else text)
    return path


@pytest.mark.parametrize("data, columns, fault", [
    (b"a,b\n1,2\n", ["a", "b"], None), (b"a,b", ["a", "b"], None), (b"", None, None),
    (b"\n \r\n a , b \r\n1,2", ["a", "b"], None), (b'"a\nb",c\n', ["a\nb", "c"], None),
    (b'"a\r\nb",c\r\n1', ["a\nb", "c"], None), (b'"a ""q"" b",c\n', ['a "q" b', "c"], None),
    (b"\xef\xbb\xbfa,b\n", ["a", "b"], None), (b"a\xff,b\n", ["a�", "b"], None),
    (b'"a,b\n1,2\n', [], OPEN), (b"\n\n  \n", None, None), (b"a,,a\n", ["a", "", "a"], None),
    (b"x" * 90 + b"\n", [], "the header record does not end within 64 characters")])
def test_header_record(data, columns, fault):
    for step in (1, 3, 1 << 14):
        from sluice.sources import headers
        old, headers._CHUNK = headers._CHUNK, step
        try:
            got = read_header("f.csv", io.BytesIO(data), limit=64)
        finally:
            headers._CHUNK = old
        assert got == (None if columns is None else Header(columns, fault)), step


def test_header_faults_and_names():
    assert header_fault(Header(["a", "b"], None), ["load_id"]) is None
    assert "occurs more than once" in header_fault(Header(["a", "b", "A"], None))
    assert header_fault(Header(["a", ""], None)) == "column 2 of the header has no name"
    assert "taken by the table" in header_fault(Header(["LOAD_ID"], None), ["load_id"])
    assert header_fault(Header([], OPEN)) == OPEN
    assert distinct_names(["v", "", "v", "v.1", "v", ""]) == [
        "v", "Unnamed: 1", "v.1", "v.1.1", "v.2", "Unnamed: 5"]


def test_headers_stop_early_and_stop_no_other_file(spark, tmp, monkeypatch):
    body = gzip.compress(b"m,n\n" + os.urandom(200_000).hex().encode())
    for name, data in {"cut.csv.gz": body[:len(body) // 2], "plain.csv.gz": b"x,y\n",
                       "empty.csv.gz": b"", "one cell.csv": b"only"}.items():
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(data)
    gz(f"{tmp}/good.csv.gz", "a,b\n1,2\n")
    paths = [f"{tmp}/{n}" for n in sorted(os.listdir(tmp))]

    def heads():
        return {os.path.basename(p): h.columns for p, h in read_headers(spark, paths).items()}

    want = {"cut.csv.gz": ["m", "n"], "good.csv.gz": ["a", "b"], "one cell.csv": ["only"]}
    assert heads() == want
    paths = ["file:" + p for p in paths]  # as Spark spells them
    assert heads() == want
    read = []

    class Counted(io.BytesIO):
        def read(self, n=-1):
            read.append(n)
            return super().read(n)

    big = gzip.compress(b"a,b\n" + os.urandom(4_000_000).hex().encode())
    read_header("big.csv.gz", Counted(big))
    assert len(read) == 1 and read[0] < 100_000


def test_files_of_a_store_that_only_spark_reads(spark, tmp, monkeypatch):
    paths = [gz(f"{tmp}/s/f{k}.csv.gz", f"c{k},d\n" + "1,2\n" * 9) for k in range(3)]
    direct = streams.each_file(spark, paths, _length, "path string, n long")

    def away(path, stream):  # the first try has no stream, the whole file comes from Spark
        if not isinstance(stream, io.BytesIO):
            raise streams.NoStream("only Spark reads this")
        return _length(path, stream)

    by_spark = streams.each_file(spark, paths, away, "path string, n long")
    assert sorted(by_spark) == sorted(direct) == [(p, 41) for p in paths]


def _length(path, stream):
    return path, sum(map(len, streams.file_chunks(path, stream)))


def test_inflated_members_padding_and_faults():
    one, two = gzip.compress(b"a" * 70_000), gzip.compress(os.urandom(50_000))
    for chunk in (7_000, 1 << 20):
        def whole(data):
            got = list(streams.inflated(io.BytesIO(data), chunk))
            assert all(len(x) <= chunk for x in got)
            return b"".join(got)

        assert whole(one + two) == gzip.decompress(one) + gzip.decompress(two)
        assert whole(one + b"\0" * 9 + two + b"\0") == gzip.decompress(one + two)
        with pytest.raises(EOFError):
            whole(one + two[:-9])
        with pytest.raises(zlib.error):
            whole(b"id,v\n")


def test_move_files_in_tasks(spark, tmp, monkeypatch):
    monkeypatch.setattr(streams, "DRIVER_MOVES", 0)
    os.makedirs(f"{tmp}/a")
    for k in range(40):
        with open(f"{tmp}/a/{k} x.txt", "w") as f:
            f.write(str(k))
    moves = [(f"file:{tmp}/a/{k} x.txt", f"{tmp}/b/{k % 3}/{k}.txt") for k in range(40)]
    streams.move_files(spark, moves)
    assert os.listdir(f"{tmp}/a") == []
    assert open(f"{tmp}/b/1/37.txt").read() == "37"
    streams.move_files(spark, moves)  # as a task that runs again
    with open(f"{tmp}/a/0 x.txt", "w") as f:
        f.write("new")
    with pytest.raises(OSError, match="exists already"):
        streams.move_files(spark, moves[:1])
    streams.move_files(spark, moves[:1], overwrite=True)
    assert open(f"{tmp}/b/0/0.txt").read() == "new"
    with pytest.raises(OSError, match="is gone"):
        streams.move_files(spark, [(f"{tmp}/none", f"{tmp}/c/none")])


def test_multi_line_header_and_cells(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    p = gz(f"{land}/t_20250102000000_UTC.csv.gz", '"id\nno",v\n1,"x\ny"\n2,z\n')
    assert [r["column_name"] for r in infer_schema(spark, [p]).orderBy("order_id").collect()] == [
        "id\nno", "v"]
    ld.create_entity_tables(spark, land, wh)
    assert table_schema(spark, f"{wh}/T").fieldNames()[6:] == ["ID\nNO", "V"]
    run = ld.load_files(spark, land, wh, RUN)
    assert [(r["status"], r["rows_loaded"]) for r in run.report.collect()] == [("LOADED", 2)]
    rows = ld.read_table_rows(spark, wh, "T").orderBy("source_file_row_number").collect()
    assert [(int(r["ID\nNO"]), r["V"]) for r in rows] == [(1, "x\ny"), (2, "z")]


def test_faulty_headers_stop_nothing(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    for entity in "qrst":
        gz(f"{land}/{entity}_20250103000000_UTC.csv.gz", "id,v\n1,2\n")
    gz(f"{land}/q_20250101000000_UTC.csv.gz", "id,v,V\n1,2,3\n")
    gz(f"{land}/r_20250101000000_UTC.csv.gz", "id,\n1,2\n")
    gz(f"{land}/s_20250101000000_UTC.csv.gz", '"id,v\n1,2\n')
    gz(f"{land}/u_20250101000000_UTC.csv.gz", "v,v\n1,2\n")
    created = {(r["entity"], r["file_name"][2:10]): (r["created"], r["columns"])
               for r in ld.create_entity_tables(spark, land, wh).collect()}
    assert created["Q", "20250103"] == (True, "ID NUMBER(38,0), V NUMBER(38,0)")
    assert "occurs more than once" in created["Q", "20250101"][1]
    assert created["S", "20250101"] == (False, f"rejected: {OPEN}")
    assert not created["U", "20250101"][0]
    for _ in range(3):
        run = ld.load_files(spark, land, wh, RUN)
    st = {r["file_name"][:10]: (r["status"], r["message"]) for r in run.report.collect()}
    assert [st[f"{e}_20250103"][0] for e in "qrst"] == ["SKIPPED"] * 4
    assert all(st[f"{e}_20250101"][0] == "FAILED" for e in "qrsu")
    assert "column 2 of the header has no name" in st["r_20250101"][1]
    # a failure that is known adds no row to the ledger
    assert lg.read_ledger(spark, wh).where("status = 'FAILED'").count() == 3
    assert ld.read_table_rows(spark, wh, "Q").count() == 1


def test_a_fault_of_one_entity_is_its_own(spark, tmp, monkeypatch):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    for entity in "abc":
        gz(f"{land}/{entity}_20250103000000_UTC.csv.gz", "id,v\n1,2\n")
    ld.create_entity_tables(spark, land, wh)
    real = ld._write_load

    def write(spark, load_dir, *rest):
        if "/B/" in load_dir:
            raise RuntimeError("disk full\nat line 1")
        return real(spark, load_dir, *rest)

    monkeypatch.setattr(ld, "_write_load", write)
    st = {r["entity"]: (r["status"], r["message"])
          for r in ld.load_files(spark, land, wh, RUN).report.collect()}
    assert st == {"A": ("LOADED", "loaded"), "B": ("FAILED", "RuntimeError: disk full"),
                  "C": ("LOADED", "loaded")}
    monkeypatch.setattr(ld, "_write_load", real)
    st = {r["entity"]: r["status"] for r in ld.load_files(spark, land, wh, RUN).report.collect()}
    assert st == {"A": "SKIPPED", "B": "LOADED", "C": "SKIPPED"}


def test_truncated_first_file_leaves_the_next_to_decide(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    body = gzip.compress(b"id,w\n" + b"".join(b"%d,%d\n" % (i, i * 7919 % 1009)
                                              for i in range(60_000)))
    gz(f"{land}/t_20250102000000_UTC.csv.gz", "id,v\n1,2\n")
    with open(f"{land}/t_20250101000000_UTC.csv.gz", "wb") as f:
        f.write(body[:len(body) // 2])
    rows = ld.create_entity_tables(spark, land, wh).collect()
    assert [(r["created"], r["columns"][:9]) for r in rows] == [(False, "rejected:"), (True, "ID NUMBER")]
    st = {r["status"] for r in ld.load_files(spark, land, wh, RUN).report.collect()}
    assert st == {"LOADED", "FAILED"} and table_schema(spark, f"{wh}/T").fieldNames()[-1] == "V"


def _touch(path: str, at: int) -> None:
    os.utime(path, (at, at))


def test_replaced_files_supersede(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    path = f"{land}/t_20250102000000_UTC.csv.gz"
    gz(f"{land}/t_20250103000000_UTC.csv.gz", "id\n7\n")

    def load(text, at):
        gz(path, text)
        _touch(path, at)
        report = ld.load_files(spark, land, wh, RUN).report
        return {r["file_name"][8:10]: r["status"] for r in report.collect()}

    gz(path, "id\n1\n2\n")
    ld.create_entity_tables(spark, land, wh)

    def ids():
        rows = ld.read_table_rows(spark, wh, "T")
        keys = [r[0] for r in rows.select("source_file_record_unique_key").collect()]
        assert len(set(keys)) == len(keys)
        return sorted(int(r["ID"]) for r in rows.collect())

    assert load("id\n1\n2\n", 1_700_000_000)["02"] == "LOADED" and ids() == [1, 2, 7]
    assert load("id\n3\n", 1_700_000_100)["02"] == "LOADED" and ids() == [3, 7]
    assert load("id\nx\n", 1_700_000_200)["02"] == "FAILED" and ids() == [3, 7]
    assert load("id\n1\n2\n", 1_700_000_000)["02"] == "LOADED" and ids() == [1, 2, 7]  # taken back
    assert load("id\n1\n2\n", 1_700_000_000)["02"] == "SKIPPED"
    before = [d for d in os.listdir(f"{wh}/T") if d.startswith("load_id=")]
    old = dt.datetime.now().timestamp() - 2 * 86400
    for d in before:
        _touch(f"{wh}/T/{d}", int(old))
    gz(f"{land}/t_20250104000000_UTC.csv.gz", "id\n9\n")
    ld.load_files(spark, land, wh, RUN)
    after = [d for d in os.listdir(f"{wh}/T") if d.startswith("load_id=")]
    assert ids() == [1, 2, 7, 9] and len(after) == 3 < len(before) + 1


def test_one_folder_per_load_and_key_ranges(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    for k in range(3):
        for j in range(4):
            rows = "".join(f"{100 * k + 10 * j + i},x\n" for i in range(5))
            gz(f"{land}/t_2025010{k + 1}00000{j}_UTC.csv.gz", f"id,v\n{rows}")
        if k == 0:
            gz(f"{land}/t_20250101000009_UTC.csv.gz", "id,v\n1000,x,y\n")  # a bad row
            ld.create_entity_tables(spark, land, wh)
        ld.load_files(spark, land, wh, RUN)
    folders = [d for d in os.listdir(f"{wh}/T") if d.startswith("load_id=")]
    assert len(folders) == 3
    rows = lg.current_loads(lg.read_ledger(spark, wh)).collect()
    assert {(r["key_min"], r["key_max"], r["rows_loaded"]) for r in rows} == {
        (str(100 * k + 10 * j), str(100 * k + 10 * j + 4), 5) for k in range(3) for j in range(4)}
    assert ld.read_table_rows(spark, wh, "T").count() == 60  # not the bad file's row
    some = ld.read_table_rows(spark, wh, "T", keys=(112, 131))
    assert sorted(int(r["ID"]) for r in some.collect()) == [112, 113, 114, 120, 121, 122, 123, 124,
                                                            130, 131]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert sum(d[8:] in plan for d in folders) == 1  # the other loads' folders are pruned


def _rows(spark, names, at, status="LOADED"):
    return spark.createDataFrame(
        [("T", n, 1, dt.datetime(2025, 1, 1), f"load{at}", RUN, at, status, "m", None, None)
         for n in names], T.StructType(lg.LEDGER_SCHEMA.fields[:-1]))


def test_ledger_stays_small_and_newest_wins(spark, tmp):
    commits = 70
    for at in range(1, commits + 1):
        names = [f"f{k}" for k in range(at % 5 + 1)] + [f"only{at}"]
        assert lg.append_ledger(spark, tmp, _rows(spark, names, at), fan=4, rows_per_bucket=15) == at
    lg.append_ledger(spark, tmp, _rows(spark, ["f0", "broken"], 71, "FAILED"), fan=4)
    runs = lg.ledger_runs(spark, tmp)
    assert len(runs) <= 4 * 4 and any(r.buckets > 1 for r in runs)
    assert len(os.listdir(f"{tmp}/_ledger")) <= len(runs) + 4
    now = {r["file_name"]: r["load_id"] for r in lg.current_loads(
        lg.read_ledger(spark, tmp)).collect()}
    want = {f"only{at}": f"load{at}" for at in range(1, commits + 1)}
    want |= {f"f{k}": f"load{max(a for a in range(1, commits + 1) if a % 5 >= k)}" for k in range(5)}
    assert now == want
    assert {r["file_name"] for r in lg.last_failures(lg.read_ledger(spark, tmp)).collect()} == {
        "f0", "broken"}
    some = spark.createDataFrame([("only3",), ("f2",), ("new",)], "file_name string")
    part = lg.read_ledger(spark, tmp, some)
    got = {r["file_name"]: r["load_id"] for r in lg.current_loads(part).collect()}
    assert got["only3"] == "load3" and got["f2"] == want["f2"] and "new" not in got
    assert part.count() < lg.read_ledger(spark, tmp).count()  # buckets of the names only


def test_ledger_merge_that_broke_off(spark, tmp):
    for at in range(1, 4):
        lg.append_ledger(spark, tmp, _rows(spark, [f"f{at}"], at), fan=4)
    half = f"{tmp}/_ledger/run-1-{1:012d}-{4:012d}-1"
    _rows(spark, ["junk"], 9).withColumn("seq", F.lit(9)).write.parquet(half)  # no marker
    assert {r["file_name"] for r in lg.read_ledger(spark, tmp).collect()} == {"f1", "f2", "f3"}
    lg.append_ledger(spark, tmp, _rows(spark, ["f4"], 4), fan=4)
    assert [(r.level, r.first, r.last) for r in lg.ledger_runs(spark, tmp)] == [(1, 1, 4)]
    assert {r["file_name"] for r in lg.read_ledger(spark, tmp).collect()} == {
        "f1", "f2", "f3", "f4"}


def test_clean_awkward_headers(spark, tmp):
    src, dst = f"{tmp}/raw", f"{tmp}/prep"
    gz(f"{src}/a.csv.gz", '"id\nno",v\n 1 ,NA\n')
    gz(f"{src}/b.csv.gz", "v,V,v,\n1, 2 ,3,4\n")
    gz(f"{src}/c.csv.gz", '"id,v\n1,2\n')
    with open(f"{src}/d.csv", "w") as f:
        f.write('"x\ny",z\n1,  2\n')
    with open(f"{src}/e.csv.gz", "w") as f:
        f.write("not,gzip\n")
    res = clean_csv_files(spark, src, dst)
    why = {os.path.basename(r["source_file"]): r["reason"] for r in res.report.collect()}
    assert why["a.csv.gz"] is why["b.csv.gz"] is why["d.csv"] is None
    assert why["c.csv.gz"] == OPEN and "corrupt gzip" in why["e.csv.gz"]
    assert gzip.open(f"{dst}/a.csv.gz", "rt").read() == '"id\nno",v\n1,\n'
    assert gzip.open(f"{dst}/b.csv.gz", "rt").read() == "v,V,v.1,Unnamed: 3\n1,2,3,4\n"
    assert open(f"{dst}/d.csv").read() == '"x\ny",z\n1,2\n'
    assert not any(d.startswith("_tmp") for d in os.listdir(dst))


class _Api:
    """Logs its calls in a folder; the task dies at the request ``dies``, once."""

    def __init__(self, calls: str, dies: int | None = None):
        self.calls, self.dies = calls, dies

    def __call__(self, n):
        import uuid
        with open(f"{self.calls}/{n}-{uuid.uuid4().hex}", "w"):
            pass
        if self.dies is not None and int(n) == self.dies and len(
                [c for c in os.listdir(self.calls) if c.startswith(f"{n}-")]) == 1:
            raise SystemExit("killed")  # no Exception: the task ends here
        return {"n": n}


def _calls(folder: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for c in os.listdir(folder):
        out[c.split("-")[0]] = out.get(c.split("-")[0], 0) + 1
    return out


def test_answered_requests_are_not_made_again(spark, tmp):
    from sluice.sources.api import fetch_responses
    os.makedirs(f"{tmp}/calls")
    calls = f"{tmp}/calls"
    req = spark.range(30).select(F.lit("f").alias("api_name"), F.col("id").alias("n"))
    req = req.unionByName(req.where("n < 3")).coalesce(1)  # repeated rows are their own requests
    got = fetch_responses(req, lambda: _Api(calls), ["n"], log_dir=f"{tmp}/log")
    first = sorted(map(tuple, got.collect()))
    assert len(first) == 33 and sum(_calls(calls).values()) == 33
    assert sorted(map(tuple, got.collect())) == first  # the action again: from the log
    more = fetch_responses(req.unionByName(spark.range(30, 32).select(
        F.lit("f").alias("api_name"), F.col("id").alias("n"))), lambda: _Api(calls), ["n"],
        log_dir=f"{tmp}/log")
    assert len(more.collect()) == 35 and sum(_calls(calls).values()) == 35  # a later run resumes


def test_killed_task_resumes_its_requests(tmp):
    """In a process of its own: local mode with a second try for each task."""
    import subprocess
    import sys
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession, functions as F
from tests.test_loads import _Api, _calls
import os
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from sluice.sources.api import fetch_responses
os.makedirs({tmp + '/calls'!r})
calls = {tmp + '/calls'!r}
req = spark.range(40).select(F.lit("f").alias("api_name"), F.col("id").alias("n"))
rows = fetch_responses(req, lambda: _Api(calls, 17), ["n"], requests_per_task=40).collect()
made = _calls(calls)
assert len(rows) == 40 and all(r["error"] is None for r in rows), rows
assert made.pop("17") == 2 and set(made.values()) == {{1}}, made
print("resumed")
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert "resumed" in out.stdout, out.stderr[-2000:]


def test_unload_leaves_rows_without_a_feed_out(spark, tmp):
    from sluice.sources.unload import read_unloaded, unload_json
    df = spark.createDataFrame([("a", '{"i": 1}'), (None, '{"i": 2}'), ("null", '{"i": 3}')],
                               "api_name string, s string").select(
        "api_name", F.parse_json("s").alias("json_response"))
    out = {r["feed"]: (r["rows_unloaded"], r["files"])
           for r in unload_json(spark, df, f"{tmp}/u", dt.date(2025, 1, 2)).collect()}
    assert out == {"a": (1, ["a_20250102.json.gz"]), "null": (1, ["null_20250102.json.gz"]),
                   None: (0, [])}
    assert read_unloaded(spark, f"{tmp}/u").count() == 2


def test_small_files_share_write_tasks(spark, tmp):
    """Many small files: few tasks and part files, every row with its number in its file."""
    from sluice.operators import load
    from sluice.sources.landing import write_named_csv

    cores = spark.sparkContext.defaultParallelism
    files = 12 * cores + 1
    rows = spark.range(files * 5).select(
        F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"),
        F.concat(F.lit("m_2025010200"), F.lpad((F.col("id") / 5).cast("int").cast("string"), 4, "0"),
                 F.lit("_UTC.csv.gz")).alias("name"))
    write_named_csv(spark, rows, f"{tmp}/l", "name", order_by=["k"])
    load.create_entity_tables(spark, f"{tmp}/l", f"{tmp}/w")
    done = load.load_files(spark, f"{tmp}/l", f"{tmp}/w", dt.datetime(2025, 1, 2))
    assert done.report.where("status = 'LOADED' AND rows_loaded = 5").count() == files
    parts = [f for _, _, fs in os.walk(f"{tmp}/w/M") for f in fs
             if f.startswith("part-") and f.endswith(".parquet")]
    assert len(parts) <= files // 2
    got = {(r[0], r[1]): int(r[2]) for r in load.read_table_rows(spark, f"{tmp}/w", "M").select(
        "source_file_name", "source_file_row_number", "K").collect()}
    assert got == {(f"m_2025010200{i // 5:04d}_UTC.csv.gz", i % 5 + 1): i for i in range(files * 5)}


def test_write_tasks(spark):
    from sluice.operators.load import TASK_BYTES, _write_tasks

    cores = spark.sparkContext.defaultParallelism
    assert _write_tasks(spark, 3, 10) == 3
    assert _write_tasks(spark, 400 * cores, 1000) == 4 * cores
    assert _write_tasks(spark, 400 * cores, TASK_BYTES // 2) == 200 * cores
    assert _write_tasks(spark, 400 * cores, TASK_BYTES * 2) == 400 * cores  # one file a task

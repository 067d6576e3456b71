"""Land API responses in a variant column.

The reference calls a Python function per request from SQL and inserts
``(api_name, current_date, parse_json(response))``.  Here the requests are
rows of a DataFrame and the fetcher is any picklable callable
``fetch(**params) -> dict | str``, injected by the caller (tests pass a
fake one).  Calls run on the executors in Arrow batches with one fetcher
instance per partition (the reference reuses one HTTP session), and the
response text is parsed JVM-side with ``parse_json``.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_path, ship_package
from sluice.sources.streams import can_open, open_stream, write_whole

RESPONSES_SCHEMA = "api_name string, json_response_date date, json_response variant"


def _response_text(result) -> str:
    # The reference declares the function as returning text but returns a
    # dict; serialise explicitly.
    if isinstance(result, (bytes, bytearray)):
        return result.decode("utf-8")
    if isinstance(result, str):
        return result
    return json.dumps(result, sort_keys=True)


def request_key(feed: str, params: dict, nth: int) -> str:
    """Idempotency key: the request and which of its repeats this is."""
    return hashlib.sha256(json.dumps([feed, params, nth], sort_keys=True).encode()).hexdigest()


class RequestLog:
    """Answers by request key, one file each in a folder that all tasks share.

    An answer is written beside its place and then renamed, so a key either
    has its whole answer or none.  Failed requests are not logged: they are
    made again.  In a store that tasks cannot open there is no log.
    """

    def __init__(self, folder: str):
        self.folder, self.on = folder.rstrip("/"), can_open(folder)

    def _file(self, key: str) -> str:
        return f"{self.folder}/{key[:2]}/{key}"

    def get(self, key: str) -> str | None:
        if not self.on:
            return None
        try:
            with open_stream(self._file(key)) as f:
                return f.read().decode("utf-8")
        except FileNotFoundError:
            return None

    def put(self, key: str, text: str) -> None:
        if self.on:
            write_whole(self._file(key), text.encode("utf-8"))


def fetch_responses(requests: DataFrame, make_fetcher: Callable[[], Callable[..., object]],
                    param_cols: Sequence[str], feed_col: str = "api_name",
                    requests_per_task: int = 50, log_dir: str | None = None) -> DataFrame:
    """(api_name, response text, error) per request row.

    A request whose parameters are all left out (``param_cols`` empty) calls
    ``fetch()``.  Requests are dealt out round robin, ``requests_per_task`` to
    a task at most, so the number of calls running at once grows with the
    requests and not with the size of the request table.

    Every answer is logged as it arrives (``RequestLog`` in ``log_dir``; by
    default a new folder of the shared scratch).  A task that runs again, and
    an action that is repeated, takes answered requests from the log.  A
    ``log_dir`` of the caller's makes a later run resume an earlier one.
    Repeated request rows are requests of their own.
    """
    params = list(param_cols)
    spark = requests.sparkSession
    folder = log_dir or scratch_path(spark, "request-log")

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch, log = make_fetcher(), RequestLog(folder)  # one per partition
        for pdf in batches:
            records = pdf[params].to_dict("records") if params else [{}] * len(pdf)
            for feed, nth, rec in zip(pdf[feed_col], pdf["__nth"], records):
                rec = {k: None if v is None or v is pd.NA else v for k, v in rec.items()}
                key, text, error = request_key(str(feed), rec, int(nth)), None, None
                try:
                    text = log.get(key)
                    if text is None:
                        text = _response_text(fetch(**rec))
                        log.put(key, text)
                except Exception as exc:  # noqa: BLE001 - reported per request
                    error = f"{type(exc).__name__}: {exc}"
                yield pd.DataFrame({"api_name": [str(feed)], "json_data": [text],
                                    "error": [error]}, dtype=object)

    ship_package(spark)
    cols = [F.col(c).cast("string").alias(c) for c in params if c != feed_col]
    calls = requests.select(F.col(feed_col).cast("string").alias(feed_col), *cols)
    # the same numbers for repeats on every run, whatever the order of the rows
    calls = calls.groupBy(*calls.columns).agg(F.count(F.lit(1)).alias("__n")).select(
        "*", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")).alias("__nth")).drop("__n")
    tasks = max(1, -(-calls.count() // requests_per_task))
    return calls.repartition(tasks).mapInPandas(
        call, "api_name string, json_data string, error string")


def land_responses(requests: DataFrame, make_fetcher: Callable[[], Callable[..., object]],
                   param_cols: Sequence[str], run_date: _dt.date, feed_col: str = "api_name",
                   strict: bool = True, errors_path: str | None = None,
                   log_dir: str | None = None) -> DataFrame:
    """Rows ready to append to the responses table (api_name, date, variant).

    ``strict=True`` fails the job on a failed request or an answer that is
    not JSON, as the reference's insert does.  ``strict=False`` needs
    ``errors_path``: the answers of the one pass are kept under the shared
    scratch folder, the failures (api_name, date, json_data, error) are
    appended there and the rest is returned.  Answered requests are logged
    (``log_dir``, see ``fetch_responses``) and not made again.
    """
    raw = fetch_responses(requests, make_fetcher, param_cols, feed_col, log_dir=log_dir)
    if strict:
        failed = F.raise_error(F.concat(F.lit("request failed: "), F.col("error")))
        text = F.when(F.col("error").isNotNull(), failed).otherwise(F.col("json_data"))
        return raw.select("api_name", F.lit(run_date).alias("json_response_date"),
                          F.parse_json(text).alias("json_response"))
    if errors_path is None:
        raise ValueError("errors_path is required with strict=False")
    spark = requests.sparkSession
    path = scratch_path(spark, "responses")
    raw.withColumn("json_response_date", F.lit(run_date)) \
        .withColumn("json_response", F.try_parse_json("json_data")).write.parquet(path)
    kept = spark.read.parquet(path)
    kept.where(F.col("json_response").isNull()).select(
        "api_name", "json_response_date", "json_data",
        F.coalesce("error", F.lit("answer is not JSON")).alias("error")) \
        .write.mode("append").parquet(errors_path)
    return kept.where(F.col("json_response").isNotNull()).select(
        "api_name", "json_response_date", "json_response")

"""Ranked search of all documents for a stated set of query items.

Pipelined term partitioning: the items' terms are dealt to ``STAGES`` owners,
rarest terms first, and bundles of items travel from owner to owner.  A bundle
carries sparse accumulators (item, document, score so far) of one slice of
documents; at each owner it meets the owner's postings of that slice in a
cogroup, adds their integer contributions and goes on.  After the last owner
each slice gives its best documents of every item, and the best of those over
all slices are the result.

The documents are read once for each block of items (at most ``BLOCK_WORDS``
words, so what tasks get of the items is bounded): every task cuts its rows
into slices of at most ``SLICE_DOCS`` documents and writes the postings of the
items' terms.  Counts over all documents (N, L, df) come out of the same pass.
The slices are then dealt to owners, term weights and impacts already worked
out, and written; the stages read them owner by owner.  Every step reads a
written table, so a lost executor costs its tasks alone.

Accumulators that can no longer reach the best ``top`` are dropped, exactly:
contributions are never negative, so the ``top``-th best score so far of an
item over all slices is a floor of its final one, and a document whose score
plus all that the later owners can add stays below the floor is not in the
result.  For the same reason a late owner of common terms starts no new
accumulators where its own and the later terms cannot reach the floor.

A term's weight is ``floor(1000 ln((2N+2)/(2 df+1)))``, its contribution
``weight * ((1000000000 tf) div (1000 tf + 8 m))`` with
``m = 100 - 75 + (75 n N) div L``, all in 64-bit integers.

Defined cases: a null text has no terms and does not count in N; items
without terms, and items none of whose terms occur, have no rows; every row of
either table is an item or a document of its own, also where ids repeat; equal
scores go by document id, null ids last; other columns are not read; empty
tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import scratch_path, ship_package

TOP = 10
STAGES = 4
SLICE_DOCS = 4096
SLICE_POSTINGS = 4_000_000
BUNDLE_ITEMS = 256
BLOCK_WORDS = 200_000

#: Term bytes stay (A-Z lower-cased), all others are gaps.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
              else 32 for b in range(256))

_SLICE = "slice long, doc_ids binary, nulls binary, lens binary, terms binary, docs binary, tfs binary"
_BUNDLE = "bundle int, slice long, items binary, docs binary, scores binary"
_POSTINGS = "owner int, bundle int, slice long, terms binary, docs binary, impacts binary"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_blocks(items: DataFrame, item_id: str, text: str, block_words: int
                ) -> Iterator[list[tuple[int | str | None, list[bytes]]]]:
    """Items that have terms, in blocks of bounded size, partition by partition."""
    block, size = [], 0
    for row in items.select(item_id, text).toLocalIterator():
        terms = terms_of((row[1] or "").encode("utf-8", "surrogatepass"))
        if not terms:
            continue
        if block and size + len(terms) > block_words:
            yield block
            block, size = [], 0
        block.append((row[0], terms))
        size += len(terms)
    if block:
        yield block


def _index(docs: DataFrame, text: str, doc_id: str, vocab: dict[bytes, int], slice_docs: int,
           path: str) -> None:
    """Write the slices: document ids, their terms with repeats, postings of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, n_terms = shared.value.get, max(len(shared.value), 1)
        part, done = 0, 0
        ids, nulls, lens, keys, held = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, nulls, lens, keys, held, done
            uniq, tf = np.unique(np.concatenate(keys), return_counts=True)
            cells = [np.array(ids, "<i8"), np.array(nulls, "u1"), np.array(lens, "<i8"),
                     (uniq // slice_docs).astype("<i4"), (uniq % slice_docs).astype("<i4"),
                     tf.astype("<i4")]
            row = [pa.array([part << 32 | done], pa.int64()),
                   *[pa.array([c.tobytes()], pa.binary()) for c in cells]]
            ids, nulls, lens, keys, held, done = [], [], [], [], 0, done + 1
            return pa.RecordBatch.from_arrays(
                row, ["slice", "doc_ids", "nulls", "lens", "terms", "docs", "tfs"])

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            names = batch.column("doc").to_pylist()
            for name, body in zip(names, batch.column("body").cast(pa.binary()).to_pylist()):
                words = terms_of(body) if body else []
                if not words:
                    continue
                found = np.array([t for t in map(get, words) if t is not None], np.int64)
                keys.append(found * slice_docs + len(ids))
                ids.append(name or 0)
                nulls.append(name is None)
                lens.append(len(words))
                held += len(found)
                if len(ids) == slice_docs or held >= SLICE_POSTINGS:
                    yield close()
        if ids:
            yield close()

    docs.select(F.spark_partition_id().alias("part"), F.col(doc_id).cast("long").alias("doc"),
                F.col(text).alias("body")).mapInArrow(slices, _SLICE).write.parquet(path)


def _array(cell: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind) if cell.is_valid else np.zeros(0, kind)


def _counts(index: DataFrame) -> tuple[int, int, dict[int, int]]:
    """N, L and the df of every vocabulary term, summed within tasks first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for terms, lens in zip(batch.column("terms"), batch.column("lens")):
                here, lens = np.bincount(_array(terms, "<i4")), _array(lens, "<i8")
                df = np.pad(df, (0, max(len(here) - len(df), 0)))
                df[:len(here)] += here
                n, total = n + len(lens), total + int(lens.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *held]), pa.array([n, total, *df[held]])], ["term", "n"])

    rows = index.select("terms", "lens").mapInArrow(count, "term long, n long").groupBy(
        "term").agg(F.sum("n").alias("n")).collect()  # bounded by the block's vocabulary
    got = {r["term"]: r["n"] for r in rows}
    return got.pop(-1, 0), got.pop(-2, 0), got


class _Plan:
    """Weights, owners and bundles of one block of items."""

    def __init__(self, items: list[list[int]], n_docs: int, n_terms: int, df: dict[int, int],
                 stages: int, bundle_items: int):
        self.n_docs, self.n_terms, self.stages = n_docs, n_terms, stages
        self.bundle_items, self.n_items = bundle_items, len(items)
        size = max(df, default=-1) + 1
        self.weight = np.zeros(size, np.int64)
        for t, k in df.items():
            self.weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1)))
        # Owners by rising df; each owner holds about twice the postings of the one before.
        order = sorted(df, key=lambda t: (df[t], t))
        share = np.cumsum([df[t] for t in order]) / max(sum(df.values()), 1)
        bounds = [2.0 ** (k + 1 - stages) for k in range(stages - 1)]
        self.owner = np.zeros(size, np.int32)
        self.owner[order] = np.searchsorted(bounds, share, side="left") if order else 0
        self.n_bundles = -(-len(items) // bundle_items)
        #: bundle -> term -> [(item within the bundle, weight times repeats)]
        self.users: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(self.n_bundles)]
        for i, terms in enumerate(items):
            uniq, times = np.unique([t for t in terms if t in df], return_counts=True)
            for t, k in zip(uniq.astype(int).tolist(), times.tolist()):
                self.users[i // bundle_items].setdefault(t, []).append(
                    (i % bundle_items, int(self.weight[t]) * k))
        self.member = np.zeros((self.n_bundles, size), bool)
        for b, users in enumerate(self.users):
            self.member[b, list(users)] = True


def _route(index: DataFrame, plan, path: str) -> None:
    """Deal the slices' postings to owners and bundles, each with its impact."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            for slice_, lens, terms, docs, tfs in zip(*(batch.column(c) for c in (
                    "slice", "lens", "terms", "docs", "tfs"))):
                n = _array(lens, "<i8")
                m = 100 - 75 + (75 * n * p.n_docs) // p.n_terms
                terms, docs = _array(terms, "<i4"), _array(docs, "<i4")
                tf = _array(tfs, "<i4").astype(np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
                owner = p.owner[terms]
                rows = []
                for b in range(p.n_bundles):
                    mine = p.member[b][terms]
                    for k in range(p.stages):
                        at = np.flatnonzero(mine & (owner == k))
                        if len(at):
                            rows.append((k, b, slice_.as_py(), terms[at].tobytes(),
                                         docs[at].tobytes(), impact[at].astype("<i4").tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                        ["owner", "bundle", "slice", "terms", "docs", "impacts"])

    index.mapInArrow(route, _POSTINGS).write.partitionBy("owner").parquet(path)


def _highest(postings: DataFrame, size: int) -> np.ndarray:
    """Largest impact of every term."""
    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros(size, np.int64)
        for batch in batches:
            for terms, impacts in zip(batch.column("terms"), batch.column("impacts")):
                terms, impacts = _array(terms, "<i4"), _array(impacts, "<i4")
                first = np.flatnonzero(np.diff(terms, prepend=-1))  # ascending terms
                top[terms[first]] = np.maximum(top[terms[first]],
                                               np.maximum.reduceat(impacts, first))
        held = np.flatnonzero(top)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(top[held])], ["term", "top"])

    out = np.zeros(size, np.int64)
    for r in postings.select("terms", "impacts").mapInArrow(
            highest, "term long, top long").groupBy("term").agg(F.max("top").alias("top")).collect():
        out[r["term"]] = r["top"]  # bounded by the block's vocabulary
    return out


def _reach(plan: _Plan, top: np.ndarray) -> np.ndarray:
    """``[stage, item]``: the most that this stage and all later ones can add."""
    out = np.zeros((plan.stages + 1, plan.n_items), np.int64)
    for b, users in enumerate(plan.users):
        for t, mine in users.items():
            for i, w in mine:
                out[plan.owner[t], b * plan.bundle_items + i] += w * top[t]
    return out[::-1].cumsum(axis=0)[::-1]


def _stage(bundles: DataFrame | None, postings: DataFrame, stage: int, plan, limits, slice_docs: int
           ) -> DataFrame:
    """The bundles after one owner: accumulators added to, hopeless ones dropped."""
    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        p, (floor, reach) = plan.value, limits.value
        first = left if len(left) else right
        b, slice_ = int(first["bundle"].iloc[0]), int(first["slice"].iloc[0])
        lo = b * p.bundle_items
        n = min(p.bundle_items, p.n_items - lo)
        sums = np.zeros((n, slice_docs), np.int64)
        live = np.zeros((n, slice_docs), bool)
        for items, docs, scores in left[["items", "docs", "scores"]].itertuples(index=False):
            at = np.frombuffer(items, "<i4"), np.frombuffer(docs, "<i4")
            sums[at], live[at] = np.frombuffer(scores, "<i8"), True
        for terms, docs, impacts in right[["terms", "docs", "impacts"]].itertuples(index=False):
            terms, docs = np.frombuffer(terms, "<i4"), np.frombuffer(docs, "<i4")
            impacts = np.frombuffer(impacts, "<i4").astype(np.int64)
            edge = [*np.flatnonzero(np.diff(terms, prepend=-1)).tolist(), len(terms)]
            for a, z in zip(edge, edge[1:]):
                for i, w in p.users[b][int(terms[a])]:
                    sums[i, docs[a:z]] += w * impacts[a:z]  # a document once for each term
        floor, reach = floor[lo:lo + n, None], reach[:, lo:lo + n, None]
        live |= reach[stage] >= floor
        live &= (sums > 0) & (sums + reach[stage + 1] >= floor)
        items, docs = np.nonzero(live)
        if not len(items):
            return pd.DataFrame(columns=["bundle", "slice", "items", "docs", "scores"])
        return pd.DataFrame({
            "bundle": [b], "slice": [slice_], "items": [items.astype("<i4").tobytes()],
            "docs": [docs.astype("<i4").tobytes()],
            "scores": [sums[items, docs].astype("<i8").tobytes()]})

    mine = postings.filter(F.col("owner") == stage).drop("owner")
    keys = ["bundle", "slice"]
    if bundles is None:
        bundles = postings.sparkSession.createDataFrame([], _BUNDLE)
    return bundles.groupBy(*keys).cogroup(mine.groupBy(*keys)).applyInPandas(visit, _BUNDLE)


def _best(items: np.ndarray, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, top: int
          ) -> np.ndarray:
    """Places of the ``top`` best of every item."""
    order = np.lexsort((ids, nulls, -scores, items))
    first = np.flatnonzero(np.diff(items[order], prepend=-1))
    nth = np.arange(len(order)) - np.repeat(first, np.diff([*first, len(order)]))
    return order[nth < top]


def _floors(bundles: DataFrame, n_items: int, bundle_items: int, top: int) -> np.ndarray:
    """The ``top``-th best score so far of every item, 0 if it has fewer documents."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, items, scores in zip(batch.column("bundle"), batch.column("items"),
                                        batch.column("scores")):
                items, scores = _array(items, "<i4"), _array(scores, "<i8")
                none = np.zeros(len(items), np.int8)
                at = _best(items, scores, none, none, top)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items[at].astype(np.int64) + b.as_py() * bundle_items),
                     pa.array(scores[at])], ["item", "score"])

    by = Window.partitionBy("item").orderBy(F.col("score").desc())
    rows = bundles.select("bundle", "items", "scores").mapInArrow(
        local, "item long, score long").withColumn("rank", F.row_number().over(by)).filter(
        F.col("rank") <= top).filter(F.col("rank") == top).select("item", "score").collect()
    out = np.zeros(n_items, np.int64)
    for r in rows:
        out[r["item"]] = r["score"]
    return out


def _select(bundles: DataFrame, index: DataFrame, bundle_items: int, top: int) -> DataFrame:
    """``item, rank, doc_id, score``: the best of every slice, then of all slices."""
    def local(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"item": [], "doc_id": [], "score": []})
        if not len(left):
            return none
        all_ids = np.frombuffer(right["doc_ids"].iloc[0], "<i8")
        all_nulls = np.frombuffer(right["nulls"].iloc[0], "u1")
        out = []
        for b, items, docs, scores in left[["bundle", "items", "docs", "scores"]].itertuples(
                index=False):
            items, docs = np.frombuffer(items, "<i4"), np.frombuffer(docs, "<i4")
            scores = np.frombuffer(scores, "<i8")
            ids, nulls = all_ids[docs], all_nulls[docs]
            at = _best(items, scores, ids, nulls, top)
            out.append(pd.DataFrame({
                "item": items[at].astype(np.int64) + b * bundle_items,
                "doc_id": pd.array(ids[at], "Int64"), "score": scores[at]}))
            out[-1].loc[nulls[at] == 1, "doc_id"] = pd.NA
        return pd.concat(out)

    by = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return bundles.groupBy("slice").cogroup(
        index.select("slice", "doc_ids", "nulls").groupBy("slice")).applyInPandas(
        local, "item long, doc_id long, score long").withColumn(
        "rank", F.row_number().over(by)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, block: list, text: str, doc_id: str, item_type, top: int,
                  stages: int, slice_docs: int, bundle_items: int) -> DataFrame:
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"search-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    vocab: dict[bytes, int] = {}
    items = [[vocab.setdefault(t, len(vocab)) for t in terms] for _, terms in block]
    path = scratch_path(spark, "search-index")
    _index(docs, text, doc_id, vocab, slice_docs, path)
    index = spark.read.parquet(path)
    n_docs, n_terms, df = _counts(index)
    plan = _Plan(items, n_docs, n_terms, df, stages, bundle_items)
    shared = spark.sparkContext.broadcast(plan)
    path = scratch_path(spark, "search-postings")
    _route(index, shared, path)
    postings = spark.read.schema(_POSTINGS).parquet(path)
    reach = _reach(plan, _highest(postings, len(plan.weight)))
    floor, bundles = np.zeros(plan.n_items, np.int64), None
    for stage in range(stages):
        limits = spark.sparkContext.broadcast((floor, reach))
        bundles = written(_stage(bundles, postings, stage, shared, limits, slice_docs),
                          f"bundles-{stage}")
        floor = np.maximum(floor, _floors(bundles, plan.n_items, bundle_items, top))
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)],
                                  f"item long, item_id {item_type}")
    return written(_select(bundles, index, bundle_items, top).join(F.broadcast(names), "item")
                   .select("item_id", "rank", "doc_id", "score"), "result")


def search(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
           item_id: str = "item_id", item_text: str = "text", top: int = TOP,
           stages: int = STAGES, slice_docs: int = SLICE_DOCS, bundle_items: int = BUNDLE_ITEMS,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every item."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in item_blocks(items, item_id, item_text, block_words):
        out = out.unionByName(_search_block(docs, block, text, doc_id, kind, top, stages,
                                            slice_docs, bundle_items))
    return out

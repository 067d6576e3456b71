"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints: 64 bits, the majority over the XXH64 values of the text's
four-word shingles.  Two fingerprints link at ``max_bits`` or fewer
differing bits; a group is a connected component of links.

Search over the distinct fingerprints (copies are folded first):

1. Bit statistics over all fingerprints: how often each pair of bits is set
   together (64 x 64 sums).  Correlated bits go into the same partition, so
   that partitions are as independent of one another as the data allow.
2. With m partitions and thresholds t_i that add up to ``max_bits - m + 1``
   (t_i = -1 leaves a partition out), every linked pair differs by t_i bits
   or fewer in some partition i.  Collision counts per partition are taken
   over all fingerprints; a dynamic programme gives each partition its
   threshold so that the rows probed plus the candidates expected are
   least, and the cheapest m wins.
3. Probe: a fingerprint stands under its own key in every partition kept,
   and also visits every key within t_i flips.  Rows of one key meet in one
   group and each candidate is verified by its bit distance.  A group gives
   a star of links for each of its local components, never all its pairs.
   Groups beyond ``block`` rows are dealt into pairs of blocks, so that no
   task holds more than two blocks of a key.

Defined cases: null and empty texts have fingerprint zero and link like any
other; a null id is never a component's name unless the whole component has
none; repeated ids are rows of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.session import scratch_path, ship_package

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 4096
_PIECE = 65_536


def text_fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Majority fingerprint of one text as a signed 64-bit integer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    starts = [0, *ends[:n - 1]]
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _PIECE):
        hashes = [xxhash.xxh64_intdigest(joined[a:b - 1], SEED)
                  for a, b in zip(starts[lo:lo + _PIECE], last[lo:lo + _PIECE])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str,
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, t, fp`` of every row; t is a hash of the text."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("t"),
                       fp(F.col(text).cast("string")).alias("fp"))


# --- choice of partitions and thresholds -------------------------------------------------

def bit_sums(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 sums of bits set together."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((64, 64)), 0
        for f in frames:
            bits = np.unpackbits(f["fp"].to_numpy("<i8").view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(f)
        at = np.arange(64 * 64 + 1)
        yield pd.DataFrame({"at": at, "n": np.append(total.ravel(), n).astype(np.int64)})

    rows = distinct.select("fp").mapInPandas(partial, "at int, n long") \
        .groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4,097 rows at any size
    got = np.zeros(64 * 64 + 1)
    for r in rows:
        got[r["at"]] = r["n"]
    return int(got[-1]), got[:-1].reshape(64, 64)


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits, each grown from a seed by the strongest correlation."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        order = sorted(free)
        seed = max(order, key=lambda b: (corr[b, order].sum(), -b))
        group = [seed]
        free.remove(seed)
        while len(group) < width:
            best = max(sorted(free), key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    """Signed 64-bit mask."""
    return int(np.array(sum(1 << b for b in bits), np.uint64).view(np.int64))


def flips(bits: list[int], most: int) -> list[int]:
    """Masks of up to ``most`` flipped bits, none excluded."""
    return [mask_of(list(c)) for k in range(1, most + 1) for c in combinations(bits, k)]


def allocate(n: int, p: np.ndarray, groups: list[list[int]], collisions: list[float],
             max_bits: int, row_cost: float = 1.0, pair_cost: float = 0.02
             ) -> tuple[float, list[int]]:
    """Least cost and the thresholds that reach it, by dynamic programming.

    ``collisions`` has for each group the pairs that share its key.  Pairs
    within t flips are estimated from them by the distribution of differing
    bits, taking the bits' own frequencies.
    """
    costs = []
    for bits, pairs in zip(groups, collisions):
        dist = np.array([1.0])
        for b in bits:
            q = min(max(2 * p[b] * (1 - p[b]), 1e-6), 0.999)
            dist = np.convolve(dist, [1 - q, q])
        by_t, keys = [0.0], 0.0
        for t in range(max_bits + 1):
            keys = keys + float(len(list(combinations(bits, t)))) if t <= 2 else np.inf
            cand = pairs * dist[:t + 1].sum() / dist[0] + n * n / 2 * (dist[:t + 1].sum()
                                                                    - dist[0])
            by_t.append(row_cost * n * keys + pair_cost * cand)
        costs.append(by_t)  # index t + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for by_t in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for t1, c in enumerate(by_t):
                k, total = min(used + t1, max_bits + 1), cost + c
                if k not in nxt or total < nxt[k][0]:
                    nxt[k] = (total, [*ts, t1 - 1])
        best = nxt
    return best.get(max_bits + 1, (np.inf, []))


def plan_partitions(distinct: DataFrame, max_bits: int
                    ) -> tuple[list[list[int]], list[int]]:
    """Bit groups and thresholds of the cheapest plan for these fingerprints."""
    n, together = bit_sums(distinct)
    p = np.diag(together) / max(n, 1)
    choices = {m: group_bits(n, together, m)
               for m in range(max(1, (max_bits + 1) // 2), max_bits + 2)}
    keys = F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"),
                 F.col("fp").bitwiseAND(F.lit(mask_of(g))).alias("key"))
        for m, groups in choices.items() for i, g in enumerate(groups)]))
    counts = distinct.select(keys.alias("k")).groupBy("k").count() \
        .groupBy("k.m", "k.i").agg(
            F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs"))
    pairs = {(r["m"], r["i"]): r["pairs"] for r in counts.collect()}  # a row per partition
    plans = [(*allocate(n, p, groups, [pairs.get((m, i), 0.0) for i in range(m)], max_bits), m)
             for m, groups in choices.items()]
    _, thresholds, m = min(plans, key=lambda x: (x[0], x[2]))
    return choices[m], thresholds


# --- probe and verify --------------------------------------------------------------------

def local_links(fps: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Star links of the components that one group's verified pairs form.

    Only pairs with a home row are compared; a row is taken up once and
    compared with those not yet reached, so a tight group costs little more
    than one pass.
    """
    us, vs = [], []
    left = np.arange(len(fps))
    while left.size > 1:
        todo, members, left = [left[0]], [left[0]], left[1:]
        while todo and left.size:
            a = todo.pop()
            near = np.bitwise_count(fps[left] ^ fps[a]) <= max_bits
            if not home[a]:
                near &= home[left]
            if near.any():
                got = left[near]
                todo.extend(got.tolist())
                members.extend(got.tolist())
                left = left[~near]
        if len(members) > 1:
            ids = fps[members]
            root = ids.min()
            us.append(ids[ids != root])
            vs.append(np.full(len(us[-1]), root))
    return us, vs


def _linker(max_bits: int):
    """Over rows sorted by group: verified star links."""

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def run(f: pd.DataFrame) -> pd.DataFrame:
            keys = f[["i", "key", "pair"]].to_numpy("i8")
            fps, home = f["fp"].to_numpy("i8").view("u8"), f["home"].to_numpy(bool)
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            starts = np.concatenate(([0], cuts))
            sizes = np.diff(np.append(starts, len(f)))
            us, vs = [], []
            for a, k in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                if k > 8 and home[a:a + k].any():
                    x, y = local_links(fps[a:a + k], home[a:a + k], max_bits)
                    us += x
                    vs += y
            small = np.repeat((sizes > 1) & (sizes <= 8), sizes)  # pairs at each distance
            gid = np.repeat(np.arange(len(sizes)), sizes)
            for d in range(1, 8):
                a = np.flatnonzero(small[:-d] & (gid[:-d] == gid[d:])) if len(f) > d else []
                if not len(a):
                    break
                ok = (home[a] | home[a + d]) & (np.bitwise_count(fps[a] ^ fps[a + d])
                                                <= max_bits)
                us.append(fps[a[ok]])
                vs.append(fps[a[ok] + d])
            if not us:
                return pd.DataFrame({"u": np.array([], "i8"), "v": np.array([], "i8")})
            return pd.DataFrame({"u": np.concatenate(us).view("i8"),
                                 "v": np.concatenate(vs).view("i8")})

        for f in frames:
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            if not len(f):
                continue
            last = f.iloc[-1]
            same = ((f["i"] == last["i"]) & (f["key"] == last["key"])
                    & (f["pair"] == last["pair"])).to_numpy()
            held = f[same]
            if not same.all():
                yield run(f[~same])
        if held is not None:
            yield run(held)

    return link


def _visit(i: int, key: Column):
    """The place of a flipped key in partition i."""

    def place(flip: Column) -> Column:
        return F.struct(F.lit(i).alias("i"), key.bitwiseXOR(flip).alias("key"),
                        F.lit(False).alias("home"))

    return place


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints that keep every component
    whole (stars instead of all pairs); ``distinct`` is a table with ``fp``."""
    spark = distinct.sparkSession
    groups, thresholds = plan_partitions(distinct, max_bits)
    places = []
    for i, (bits, t) in enumerate(zip(groups, thresholds)):
        if t < 0:
            continue
        key = F.col("fp").bitwiseAND(F.lit(mask_of(bits)))
        places.append(F.array(F.struct(F.lit(i).alias("i"), key.alias("key"),
                                       F.lit(True).alias("home"))))
        if t:
            masks = F.array(*[F.lit(x) for x in flips(bits, t)])
            places.append(F.transform(masks, _visit(i, key)))
    rows = distinct.select("fp", F.explode(F.concat(*places)).alias("at")) \
        .select("fp", "at.i", "at.key", "at.home")
    crowded = scratch_path(spark, "simhash-crowded")
    rows.groupBy("i", "key").count().filter(F.col("count") > block).select(
        F.col("i").alias("c_i"), F.col("key").alias("c_key"),
        F.ceil(F.col("count") / block).cast("int").alias("blocks")).write.parquet(crowded)
    crowd = spark.read.parquet(crowded)
    rows = rows.join(crowd, (F.col("i") == F.col("c_i")) & (F.col("key") == F.col("c_key")),
                     "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long")
    pair = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (
            F.least(mine, j.cast("long")) * F.col("blocks") + F.greatest(mine, j.cast("long")))))
    rows = rows.select("i", "key", F.explode(pair).alias("pair"), "fp", "home")
    return rows.repartition("i", "key", "pair").sortWithinPartitions("i", "key", "pair") \
        .mapInPandas(_linker(max_bits), "u long, v long").distinct()


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int, block: int
             ) -> tuple[DataFrame, DataFrame]:
    """Tables ``doc_id, t, fp`` (t: hash of the text) and ``fp, root``."""
    spark = docs.sparkSession
    by_doc, by_fp = scratch_path(spark, "simhash-docs"), scratch_path(spark, "simhash-fps")
    fingerprints(docs, doc_id, text, shingle).write.parquet(by_doc)
    rows = spark.read.parquet(by_doc)
    rows.select("fp").distinct().write.parquet(by_fp)
    distinct = spark.read.parquet(by_fp)
    roots = components(links(distinct, max_bits, block)).select(
        F.col("u").alias("fp"), "root")
    return rows, distinct.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                block: int = BLOCK) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    rows, roots = _grouped(docs, doc_id, text, shingle, max_bits, block)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = least.join(roots, "fp")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    names = named.join(names, "root").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"),
                                         "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             block: int = BLOCK) -> DataFrame:
    """One row of each group, columns as they were: the smallest id (a null id
    last), of rows that repeat it the smallest text hash."""
    rows, roots = _grouped(docs, doc_id, text, shingle, max_bits, block)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "t")
    first = rows.groupBy("fp").agg(F.min(order).alias("o")).join(roots, "fp") \
        .groupBy("root").agg(F.min("o").alias("o")) \
        .select(F.col("o.doc_id").alias("d__"), F.col("o.t").alias("t__"))
    whole = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("d"),
                        F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("t"))
    return whole.join(first, F.col("d").eqNullSafe(F.col("d__")) & (F.col("t") == F.col("t__")),
                      "left_semi").dropDuplicates(["d", "t"]).select("row.*")

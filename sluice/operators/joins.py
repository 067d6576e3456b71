"""Left equi-joins on one key and the anti join.

Broadcasting is left to Spark's size check: a side is broadcast only when
its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans with the real shuffle sizes.  Beyond the threshold the join falls
back to a sort-merge join on the key.

Skew.  A plain ``base LEFT JOIN side`` cannot be split by AQE on the side
(right) input: splitting the non-preserved side would emit false
"no match" rows.  So ``left_join_all`` counts the keys of the fan-out sides
once (partial counts, then one row per key) and takes the hot ones, with more
than ``hot_rows`` rows, out of the base a single time:

    cold base  LEFT JOIN side_1 LEFT JOIN side_2 ...        -- plain joins
    hot base  INNER JOIN side_1' INNER JOIN side_2' ...     -- salted

where ``side_i'`` is the side's hot rows plus one NULL row for each hot key it
lacks, and a key with n rows in a side is dealt into ceil(n / ``hot_rows``)
salts of that side, for each of which the hot base row is repeated.  The base
is read twice, however many sides there are, and without a hot key the plan
is the chain of plain left joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_path

HOT_ROWS = 1_000_000


def left_join(left: DataFrame, right: DataFrame, key: str | Sequence[str],
              skew_safe: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left LEFT JOIN right USING (key)``; output = left columns + right's others."""
    return left_join_all(left, [right], key, skew_safe=skew_safe, hot_rows=hot_rows)


def _hot_keys(sides: Sequence[DataFrame], keys: list[str], hot_rows: int
              ) -> DataFrame | None:
    """(keys, side number, salts) of the keys with more than ``hot_rows`` rows in
    a side; None if there are none.

    Written to the shared scratch folder: at most one row per ``hot_rows``
    rows of input, of a size the planner knows.
    """
    if not sides:
        return None
    counts = [s.select(*keys).groupBy(*keys).count().where(F.col("count") > hot_rows)
              .select(*keys, F.lit(i).alias("__side"),
                      F.ceil(F.col("count") / hot_rows).cast("int").alias("__salts"))
              for i, s in enumerate(sides)]
    spark = sides[0].sparkSession
    path = scratch_path(spark, "hot-keys")
    hot = reduce(DataFrame.unionByName, counts)
    for k in keys:  # a NULL key matches nothing
        hot = hot.where(F.col(k).isNotNull())
    hot.write.parquet(path)
    hot = spark.read.parquet(path)
    return None if hot.isEmpty() else hot


def left_join_all(base: DataFrame, sides: Sequence[DataFrame], key: str | Sequence[str],
                  unique: Sequence[bool] | None = None, skew_safe: bool = True,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Chain of left joins of independent sides on the base's key.

    ``unique[i]`` declares that side i has at most one row per key (a lookup
    such as a dimension table or a per-key aggregate): its keys cannot be
    hot and are not counted.  The branches are independent: a key with m
    matches in one side and n in another yields m x n rows, as in the
    reference.  ``skew_safe=False`` skips the count of hot keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    unique = list(unique) if unique is not None else [False] * len(sides)
    # lookups first: they add no rows
    lookups = [s for s, u in zip(sides, unique) if u]
    fan_out = [s for s, u in zip(sides, unique) if not u]
    counts = _hot_keys(fan_out, keys, hot_rows) if skew_safe else None

    def plain(left: DataFrame, some: Sequence[DataFrame]) -> DataFrame:
        return reduce(lambda out, s: out.join(s, on=keys, how="left"), some, left)

    if counts is None:
        return plain(base, lookups + fan_out)
    hot = counts.select(*keys).distinct()
    cold = plain(base.join(hot, on=keys, how="left_anti"), lookups + fan_out)
    out = plain(base.join(hot, on=keys, how="left_semi"), lookups)
    for i, side in enumerate(fan_out):
        salts = hot.join(counts.where(F.col("__side") == i).select(*keys, "__salts"),
                         on=keys, how="left").withColumn(
            "__salts", F.coalesce("__salts", F.lit(1)))
        own = side.join(salts, on=keys, how="inner").withColumn(
            "__salt", F.pmod(F.xxhash64(*side.columns), F.col("__salts")).cast("int"))
        lacking = hot.join(side.select(*keys).distinct(), on=keys, how="left_anti").select(
            *keys, *[F.lit(None).cast(f.dataType).alias(f.name)
                     for f in side.schema.fields if f.name not in keys],
            F.lit(0).alias("__salt"))
        out = out.join(salts, on=keys, how="inner").withColumn(
            "__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
        out = out.join(own.drop("__salts").unionByName(lacking), on=[*keys, "__salt"],
                       how="inner").drop("__salt")
    return cold.unionByName(out.select(*cold.columns))


def anti_join(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key has no match in ``target``.

    Written so the (large) target is never shuffled when the (usually small,
    incremental) source is small:

    1. ``src_keys``: the source's distinct non-NULL keys (combined map-side);
    2. ``hits``: target keys ``LEFT SEMI JOIN src_keys`` -- Spark broadcasts
       ``src_keys`` when its size is under the broadcast threshold, so the
       target is only scanned (key columns, pruned) and filtered in place;
       beyond the threshold it is a sort-merge semi join;
    3. ``source LEFT ANTI JOIN hits`` -- both sides are at most source-sized.

    A NULL key never matches, so such source rows are always returned.
    """
    keys = list(keys)
    not_null = None
    for k in keys:
        cond = F.col(k).isNotNull()
        not_null = cond if not_null is None else not_null & cond
    src_keys = source.select(*keys).where(not_null).distinct()
    hits = target.select(*keys).join(src_keys, on=keys, how="left_semi").distinct()
    return source.join(hits, on=keys, how="left_anti")

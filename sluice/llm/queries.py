"""The registered corpus queries ``opN_<name>`` and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.session import read_table

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Job) -> Job:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


OP9_SQL = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (
  SELECT conv_id, role, text,
         row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length('<|im_start|>') + 1 + length('<|im_end|>') + 1
             + length(replace(replace(role, '\', '\\'), chr(10), '\n'))
             + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')))
           OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                 ROWS UNBOUNDED PRECEDING) AS upto
  FROM src
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(coalesce(sum(upto) FILTER (role = 'assistant' OR k = n), 0) AS BIGINT)
         AS formatted_chars
FROM t GROUP BY conv_id
"""


@register("op9_chat_format", OP9_SQL)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-target examples of all conversations, read back from the output."""
    from sluice.llm import chat_format as cf

    cols = ["conv_id", "turn", "role", "text"]
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select(*cols).unionByName(extra)
    return cf.digest(cf.read_back(cf.format_examples(turns)))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT
           AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, 3 * CAST(source_size AS HUGEINT) AS cap, sum(source_size) OVER () AS total,
         sum(w) OVER () AS total_w FROM s),
f AS (
  SELECT *, coalesce(sum(cap) OVER o, 0) AS caps, coalesce(sum(w) OVER o, 0) AS ws
  FROM r WINDOW o AS (ORDER BY cap / w, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, cap * (total_w - ws) < w * (total - caps) AS clamped FROM f),
t AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN CAST(cap AS DOUBLE)
              ELSE CAST(w * (total - coalesce(sum(CASE WHEN clamped THEN cap END) OVER (), 0))
                        AS DOUBLE)
                   / CAST(total_w - coalesce(sum(CASE WHEN clamped THEN w END) OVER (), 0)
                          AS DOUBLE) END AS target
  FROM g),
u AS (
  SELECT *, CAST(round(target) AS BIGINT) AS want,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END
           AS whole FROM t),
x AS (
  SELECT d.doc_id, d.size, u.source_size, u.target, u.whole,
         u.want - u.whole * u.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, rest - (upto - size))) AS BIGINT) AS taken
FROM x
"""


@register("op10_mixing", OP10_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    from pyspark.sql import functions as F

    from sluice.llm import mixing

    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.take(docs).select("doc_id", "size", "source_size", "target", "taken")


@register("op8_sketch")
def op8_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of every document, of its edited text and its likeness to the next."""
    from sluice.llm import sketch

    return sketch.sketch_report(read_table(spark, sf_dir, "documents"))


@register("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    from sluice.llm import simhash

    return simhash.near_groups(read_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
l AS (SELECT item, ws, least(10, len(ws)) AS n FROM i WHERE len(ws) > 0),
iw AS (
  SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS w
  FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM l)),
dw AS (
  SELECT rid, n, p, array_to_string(ws[p:p + n - 1], ' ') AS w
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM l) WHERE len(ws) >= n)),
h AS (SELECT dw.rid, dw.p, dw.n, iw.item FROM dw JOIN iw USING (n, w)),
c AS (SELECT rid, count(DISTINCT q) AS n_hit
      FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM h) GROUP BY rid),
k AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN k USING (rid)
"""


@register("op3_decontaminate", OP3_SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    from pyspark.sql import functions as F

    from sluice.llm import decontaminate as dc

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dc.hits(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "hits.n_words", dc.n_hit("hits").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits.spans") > 0).alias("contaminated"))


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    from pyspark.sql import functions as F

    from sluice.llm import toxicity as tx

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tx.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = tx.score(docs, model)
    return scored.select("doc_id", tx.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the common blocks that an earlier document holds."""
    from pyspark.sql import functions as F

    from sluice.llm import line_dedup

    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
        .alias("n_lines"))
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long")
        .alias("n_removed"), "text")


@register("op7_licenses")
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed license blocks of all documents."""
    from sluice.llm import licenses

    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


@register("op2_html_extract")
def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from pyspark.sql import functions as F

    from sluice.llm import html_extract as hx

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    got = hx.extract(pages, hx.fit(pages))
    return got.select("page_id", "url", "text",
                      F.char_length("text").cast("long").alias("n_chars"))


@register("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 100 bytes that start earlier."""
    from sluice.llm import suffix_dedup

    return suffix_dedup.dedup(read_table(spark, sf_dir, "documents")).drop("kept")


@register("op11_wavelet")
def op11_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as wavelet matrices and read back."""
    import public_tokenizers

    from sluice.llm import token_shards
    from sluice.session import scratch_path

    path = scratch_path(spark, "token-shards")
    token_shards.write_shards(read_table(spark, sf_dir, "documents"), path,
                              public_tokenizers.path("byte_bpe_50k.json"))
    return token_shards.digest(spark, path)


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         min(doc_id) OVER (PARTITION BY t) AS lo FROM d),
l AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(ws) < 200,
          100 * list_unique(ws) < 50 * len(ws),
          100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
          regexp_matches(t, '[#$%&*|]'),
          coalesce(doc_id > lo, doc_id IS NULL AND lo IS NOT NULL)] AS bad
  FROM w LEFT JOIN l USING (doc_id)),
m AS (
  SELECT part, bad, count(*) AS n, count(*) FILTER (good) AS good,
         count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY part, bad),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
g AS (
  SELECT part, filter_order, step, n, good, toxic,
         bad[ascii(filter_order[step]) - 64] AS here,
         len(list_filter(range(1, step), lambda k: bad[ascii(filter_order[k]) - 64])) AS before,
         len(list_filter(bad, lambda y: y)) AS fails
  FROM m, s)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(sum(n) FILTER (NOT here AND before = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (here AND before = 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (here AND before > 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (here AND fails = 1), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(good) FILTER (here AND before = 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(toxic) FILTER (here AND before = 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(sum(n) FILTER (here AND before = 0))
                     OVER (PARTITION BY part, filter_order[step]), 0) AS BIGINT) AS shapley
FROM g GROUP BY part, filter_order, step
"""


@register("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of five filters in all orders."""
    from sluice.llm import filter_audit

    return filter_audit.audit(read_table(spark, sf_dir, "documents"),
                              read_table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
i AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
q AS (SELECT item, w, count(*) AS times FROM (SELECT item, unnest(ws) AS w FROM i) GROUP BY item, w),
a AS (SELECT count(*) AS nd, CAST(sum(len(ws)) AS BIGINT) AS lt FROM d WHERE len(ws) > 0),
p AS (
  SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(ws) AS w FROM d)
  WHERE w IN (SELECT w FROM q) GROUP BY rid, w),
t AS (
  SELECT w, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE)))
                 AS BIGINT) AS weight
  FROM p, a GROUP BY w, nd),
m AS (SELECT rid, doc_id, 100 - 75 + (75 * len(ws) * nd) // lt AS m FROM d, a WHERE len(ws) > 0),
s AS (
  SELECT q.item, m.rid, m.doc_id,
         CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (w) JOIN t USING (w) JOIN m USING (rid)
  GROUP BY q.item, m.rid, m.doc_id),
r AS (
  SELECT item, doc_id, score,
         row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank
  FROM s WHERE score > 0)
SELECT i.item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM r JOIN i USING (item) WHERE rank <= 10
"""


@register("op12_term_search", OP12_SQL)
def op12_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    from sluice.llm import term_search

    return term_search.search(read_table(spark, sf_dir, "documents"),
                              read_table(spark, sf_dir, "benchmark"))

"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import (
    benchmark_overlap,
    centroid_clusters,
    conversation_trie,
    language_id,
    line_dedup,
    mixture,
    ngram_join,
    piece_encoder,
    quality_classifier,
    quality_rules,
    toxicity,
    url_filters,
    vector_search,
)
from reelrank.llm.common import Query, fold, ship, table
from reelrank.session import stage

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_mixture",
    r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9))::BIGINT AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM s),
p AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price
  FROM w),
t AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), max(price) OVER () * weight) AS target
  FROM p),
n AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS passes
  FROM t),
h AS (
  SELECT source, h, sum(size) AS mass, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
  FROM sized GROUP BY source, h),
c AS (
  SELECT n.source, min(h.h + CASE WHEN 2 * (target - passes * source_size - upto + mass) >= mass
                             THEN 1 ELSE 0 END) AS cut
  FROM n JOIN h ON n.source IS NOT DISTINCT FROM h.source
  WHERE upto > target - passes * source_size
  GROUP BY n.source)
SELECT d.doc_id, d.size, n.source_size, n.target,
       CAST(d.size * (n.passes + CASE WHEN c.cut IS NULL OR d.h < c.cut THEN 1 ELSE 0 END)
            * CASE WHEN n.source_size > 0 THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM sized d JOIN n ON d.source IS NOT DISTINCT FROM n.source
LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source
""",
)
def op1_mixture(spark, sf_dir):
    sized, cut_table = mixture.plan(table(spark, sf_dir, "documents"))
    return mixture.mix(sized, cut_table).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("repeats")).cast("long").alias("taken"),
    )


@query(
    "op7_quality_rules",
    rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
l AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
stops AS (
  SELECT rid, count(*) AS n_stop FROM w
  WHERE lower(word) IN ({", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)}) GROUP BY rid),
g AS (
  SELECT rid, unnest(words[1:len(words) - 4]) AS a,
         generate_subscripts(words[1:len(words) - 4], 1) AS i, words FROM d WHERE len(words) >= 5),
g5 AS (SELECT rid, i, a || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3]
              || ' ' || words[i + 4] AS win FROM g),
r AS (SELECT rid, i FROM g5 QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
c AS (
  SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat FROM (
    SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
m AS (
  SELECT d.doc_id, len(d.words) AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         length(regexp_replace(d.text, '[^!]+', '', 'g')) AS n_shouts,
         coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
         coalesce(c.n_repeat, 0) AS n_repeat_words, coalesce(s.n_stop, 0) AS n_stop
  FROM d LEFT JOIN l USING (rid) LEFT JOIN c USING (rid) LEFT JOIN stops s USING (rid)),
b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 1.5 AND 16.0
         AND n_symbols / n_words <= 0.2 AND n_shouts / n_words <= 0.2
         AND n_dup_lines / n_lines <= 0.5 AND n_stop / n_words >= 0.02 AS kept
FROM b
""",
)
def op7_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def piece_vocabulary() -> piece_encoder.Vocabulary:
    import public_tokenizers

    return piece_encoder.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_piece_encoder")
def op5_piece_encoder(spark, sf_dir):
    """Exact ids and round trip of every text; tested against the sentencepiece library."""
    docs = table(spark, sf_dir, "documents")
    return piece_encoder.encode_texts(docs, piece_vocabulary(), with_ids=False, with_text=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    """Scores of every text; tested by held-out accuracy and a brute-force distance."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op10_ngram_join")
def op10_ngram_join(spark, sf_dir):
    """Components of all documents; tested against all pairs on a small fixture."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_line_dedup")
def op8_line_dedup(spark, sf_dir):
    """Texts without repeated windows of lines; tested against a brute-force version."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    """Languages of every text; tested by held-out accuracy and sums of probabilities."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    models = language_id.learn(docs.where(~held_out))
    found = stage(
        language_id.identify(docs, models).withColumn("held_out", held_out), "languages"
    )
    return language_id.calibrated(found, found.where("NOT held_out")).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


@query("op4_quality_classifier")
def op4_quality_classifier(spark, sf_dir):
    """Scores of every text; tested by held-out accuracy and the quadratic form of the model."""
    docs = table(spark, sf_dir, "documents")
    machine = quality_classifier.learn(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score_texts(docs, machine).select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op2_vector_search")
def op2_vector_search(spark, sf_dir):
    """The 20 nearest vectors of each query; tested by recall against brute force."""
    return vector_search.nearest(table(spark, sf_dir, "embeddings"))


#: The rules of the query.
URL_RULES = (
    url_filters.Rule("net/", url_filters.BLOCK),
    url_filters.Rule("example.net/en/", url_filters.ALLOW),
    url_filters.Rule("example.com/de/", url_filters.BLOCK),
    url_filters.Rule("org/fr/", url_filters.ALLOW),
)


@query("op3_url_filters")
def op3_url_filters(spark, sf_dir):
    """Host, path, rule and verdict of every url; templates tested against a plain version."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity"
    )


def _rounds_sql(rounds: int, k: int) -> str:
    """DuckDB CTEs: assignments and centroids of every round."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, arg_min(n, [CAST(dist AS HUGEINT), n]) AS n, min(dist) AS dist
  FROM (SELECT v.rid, c.n, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS dist
        FROM parts v JOIN c{r} c USING (i) GROUP BY v.rid, c.n) GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.n, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT n, i, CAST(CASE WHEN s % t < 0 THEN s // t - 1 ELSE s // t END AS BIGINT) AS x
    FROM (SELECT a.n, p.i, sum(p.x) AS s, count(*) AS t
          FROM a{r} a JOIN parts p USING (rid) GROUP BY a.n, p.i)) m USING (n, i))""")
    return ",".join(parts)


@query(
    "op13_centroid_clusters",
    f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS xs
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
parts AS MATERIALIZED (
  SELECT rid, unnest(xs) AS x, generate_subscripts(xs, 1) AS i FROM kept),
firsts AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n FROM kept
  ORDER BY n LIMIT 8),
c0 AS MATERIALIZED (SELECT n, i, x FROM firsts JOIN parts USING (rid)),
{_rounds_sql(10, 8)},
digests AS (SELECT n, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY n)
SELECT vec_id, CAST(n AS INT) AS cluster, dist AS distance,
       CAST(sum(dist) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a10 JOIN kept USING (rid) JOIN digests USING (n)
""",
)
def op13_centroid_clusters(spark, sf_dir):
    members, centroids = centroid_clusters.cluster(table(spark, sf_dir, "embeddings"))
    return centroid_clusters.with_inertia(members, centroids).select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
    )


@query(
    "op12_benchmark_overlap",
    r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (
  SELECT DISTINCT item, len(w) AS span, array_to_string(w, ' ') AS win
  FROM (SELECT item, unnest(CASE WHEN len(words) < 10 THEN [words] ELSE list_transform(
               range(1, len(words) - 8), lambda i: words[i:i + 9]) END) AS w
        FROM b WHERE len(words) > 0)),
dw AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
ten AS (
  SELECT rid, i, list(word) OVER (PARTITION BY rid ORDER BY i
                                  ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w FROM dw),
hits AS (
  SELECT DISTINCT rid, i, t.span, item
  FROM (SELECT rid, i, s.span, array_to_string(w[1:s.span], ' ') AS win
        FROM ten, (SELECT DISTINCT span FROM bw) s WHERE len(w) >= s.span) t
  JOIN bw USING (span, win)),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_hit
  FROM (SELECT rid, i, unnest(range(span)) AS k FROM hits) GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
""",
)
def op12_benchmark_overlap(spark, sf_dir):
    found = benchmark_overlap.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return benchmark_overlap.contamination(found).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _crc_steps() -> str:
    """DuckDB CTEs: the table of crc32 by its rule, eight shifts of each byte."""
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    parts = ["t0 AS (SELECT range AS i, range AS v FROM range(256))"]
    parts += [f"t{k + 1} AS (SELECT i, {step} AS v FROM t{k})" for k in range(8)]
    return ",\n".join(parts)


@query(
    "op11_conversation_trie",
    f"""
WITH RECURSIVE {_crc_steps()},
turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(len(role) || ':' || role || text)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 4294967295 AS c FROM sizes
  UNION ALL
  SELECT conv_id, substr(s, 2), xor(c >> 8, v) FROM crc JOIN t8 ON i = xor(c, ascii(s)) & 255
  WHERE s <> ''),
c AS (
  SELECT s.conv_id, s.n, h, least(h, coalesce(b.n, 0)) AS kept, s.conv_id - s.conv_id % 5 AS base
  FROM sizes s
  JOIN (SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE s = '') USING (conv_id)
  LEFT JOIN sizes b ON b.conv_id = s.conv_id - s.conv_id % 5),
built AS (
  SELECT c.conv_id, p AS d, role, text FROM c JOIN turns t ON t.conv_id = base AND p <= h
  UNION ALL
  SELECT conv_id, kept + p - h, role, text FROM c JOIN turns USING (conv_id) WHERE p > h),
paths AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent,
         max(d) OVER (PARTITION BY conv_id) AS length
  FROM (SELECT conv_id, d, strlen(text) AS bytes,
               md5(string_agg(len(role) || ':' || len(text) || ':' || role || text, '')
                   OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM built
        UNION ALL SELECT conv_id, 0, 0, '' FROM c)),
nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * min(bytes) AS saved FROM paths GROUP BY node, d),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent),
own AS (SELECT *, coalesce(n_children, 0) AS n_kids FROM nodes LEFT JOIN kids USING (node)),
below AS (
  SELECT p.node, sum(saved) AS saved_tokens, sum(CASE WHEN n_kids = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM own o JOIN paths p ON p.conv_id = o.conv_id AND p.d <= o.d GROUP BY p.node),
ends AS (
  SELECT node, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM paths
  WHERE d = length GROUP BY node)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, o.n_convs,
       o.n_kids AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own o JOIN below USING (node) LEFT JOIN ends USING (node)
LEFT JOIN nodes up ON up.node = o.parent
""",
)
def op11_conversation_trie(spark, sf_dir):
    turns = conversation_trie.turns_of(table(spark, sf_dir, "conversations"))
    rows = conversation_trie.spliced(
        turns,
        base=F.col("conv") - F.col("conv") % 5,
        head=F.crc32(F.col("conv").cast("string")) % 9,
        longest_head=8,
    )
    return conversation_trie.trie(rows)

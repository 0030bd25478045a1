"""Queries op1..op13 of this subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import (attention_lm, centroid_walk, decontaminate, exact_tree, line_spread, mixing, periodic_runs, quality_ordinal,
               quality_rules, simhash_cover, substring_cover, token_cache, url_filter)
from .common import split_words, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


#: Words of a text in DuckDB: [^\x20\x09-\x0D]+ (RE2 knows these escapes).
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@register("op1_url_filters")
def op1(spark, sf):
    """Verdict of every page url: rule list, else the n-gram model."""
    model = url_filter.fit_url_model(url_filter.labelled_urls(spark))
    return url_filter.filter_urls(table(spark, sf, "pages"), model)


@register("op2_mixing", rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS src,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS seed_key FROM documents
), s AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY CASE WHEN src = '' THEN 1 ELSE 0 END, src) - 1 AS src_rank
  FROM d GROUP BY src
), w AS (
  SELECT *, [5.0, 2.0, 1.0][CAST(src_rank % 3 + 1 AS INTEGER)]::DOUBLE AS w,
         sum(source_size) OVER ()::DOUBLE * 1.5 AS total FROM s
), l AS (
  SELECT *, 2 * source_size AS most,
         (total - coalesce(sum(2 * source_size) OVER f, 0)::DOUBLE)
         / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
  FROM w WINDOW f AS (ORDER BY source_size::DOUBLE / w, src_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (SELECT *, most <= w * level AS is_full FROM l
), t AS (
  SELECT src, src_rank, source_size, most, CASE WHEN is_full THEN most::DOUBLE ELSE w * (
    (total - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ()::DOUBLE)
    / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ()) END AS target FROM c
), seats AS (
  SELECT src, src_rank, target / (2 * k - 1) AS quotient
  FROM t, unnest(generate_series(1, CAST(floor(most / {mixing.BLOCK_WORDS}) + 2 AS BIGINT))) AS g(k)
), won AS (
  SELECT src, count(*) AS blocks FROM (
    SELECT src, row_number() OVER (ORDER BY quotient DESC, src_rank) AS place FROM seats)
  WHERE place <= (SELECT floor(sum(target) / {mixing.BLOCK_WORDS} + 0.5) FROM t) GROUP BY src
), p AS (
  SELECT t.*, least(coalesce(blocks, 0) * {mixing.BLOCK_WORDS}, most) AS words FROM t LEFT JOIN won USING (src)
), o AS (
  SELECT d.*, p.source_size, p.target, p.words,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY seed_key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN p USING (src)
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size
            + greatest(0, least(words % source_size - start, size)) END AS BIGINT) AS taken
FROM o
""")
def op2(spark, sf):
    """Words of every document that the target-weight mix takes."""
    mix = mixing.mix_sources(table(spark, sf, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", mixing.taken_words(F.col("takes")).alias("taken"))


@register("op6_line_dedup", rf"""
WITH l AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
         unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL
), spread AS (
  SELECT line, count(DISTINCT coalesce('+' || source, '')) AS sites, min((doc_id, pos)) AS first
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
), k AS (
  SELECT l.*, coalesce(sites >= {line_spread.MIN_SITES}
                       AND NOT (first[1] = l.doc_id AND first[2] = l.pos), FALSE) AS gone
  FROM l LEFT JOIN spread USING (line)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_md5
FROM k GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
""")
def op6(spark, sf):
    """Lines of every document, those removed as cross-site boilerplate, and the digest of what stays."""
    out = line_spread.dedup_lines(table(spark, sf, "documents"), n_lines="n_lines", removed="removed")
    return out.select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                      F.md5("text").alias("text_md5"))


def _quality_sql() -> str:
    m, prior = quality_rules.METRICS, quality_rules.PRIOR

    def unit(x):
        return f"CAST(pow(2, greatest(length(bin({x})) - 6, 0)) AS BIGINT)"

    def share(n, of):
        return f"CASE WHEN {of} > 0 THEN CAST(floor(1000 * greatest({n} - 2 * sqrt({n}), 0.0::DOUBLE) / {of}) AS BIGINT) ELSE 0 END"
    stack = " UNION ALL ".join(f"SELECT lk, sk, '{x}' AS metric, {x} - {x} % {unit(x)} AS bin FROM q" for x in m)
    limit = f"q90 + {quality_rules.SPREAD} * (q90 - q50) + {unit('q90')}"
    pick = ", ".join(f"max({limit}) FILTER (metric = '{x}') AS limit_{x}" for x in m)
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce('+' || lang, '') AS lk, coalesce('+' || source, '') AS sk,
         {_WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
    SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3))
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS r FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY doc_id
), b AS (
  SELECT w.doc_id, lk, sk, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
         CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_caps
  FROM w LEFT JOIN rep USING (doc_id)
), q AS (
  SELECT *, {share('n_symbols', 'word_chars')} AS symbol_mille, {share('n_dup_lines', 'n_lines')} AS dup_line_mille,
         {share('n_repeat_words', 'n_words')} AS repeat_mille, {share('n_caps', 'word_chars')} AS caps_mille,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b
), x AS ({stack}
), ca AS (SELECT metric, bin, CAST(count(*) AS HUGEINT) AS c_all FROM x GROUP BY ALL
), cl AS (SELECT lk, metric, bin, CAST(count(*) AS HUGEINT) AS c FROM x GROUP BY ALL
), co AS (SELECT lk, sk, metric, bin, CAST(count(*) AS HUGEINT) AS c FROM x GROUP BY ALL
), nl AS (SELECT lk, CAST(count(*) AS HUGEINT) AS n FROM q GROUP BY lk
), no AS (SELECT lk, sk, CAST(count(*) AS HUGEINT) AS n FROM q GROUP BY lk, sk
), t AS (SELECT CAST(count(*) AS HUGEINT) AS n FROM q
), bl AS (
  SELECT nl.lk, ca.metric, ca.bin, t.n * (nl.n + {prior}) AS total, coalesce(c, 0) * t.n + {prior} * c_all AS c
  FROM nl, ca, t LEFT JOIN cl ON cl.lk = nl.lk AND cl.metric = ca.metric AND cl.bin = ca.bin
), bo AS (
  SELECT no.lk, no.sk, bl.metric, bl.bin, total * (no.n + {prior}) AS total, coalesce(co.c, 0) * total + {prior} * bl.c AS c
  FROM no JOIN bl ON bl.lk = no.lk LEFT JOIN co ON co.lk = no.lk AND co.sk = no.sk AND co.metric = bl.metric AND co.bin = bl.bin
), cum AS (SELECT *, sum(c) OVER (PARTITION BY lk, sk, metric ORDER BY bin ROWS UNBOUNDED PRECEDING) AS s FROM bo
), qs AS (SELECT lk, sk, metric, min(bin) FILTER (2 * s >= total) AS q50, min(bin) FILTER (10 * s >= 9 * total) AS q90
          FROM cum GROUP BY lk, sk, metric
), lim AS (SELECT lk, sk, {pick} FROM qs GROUP BY lk, sk)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed{"".join(f" AND {x} <= limit_{x}" for x in m)} AS kept
FROM q JOIN lim USING (lk, sk)"""


@register("op7_quality_rules", _quality_sql())
def op7(spark, sf):
    """Metrics and verdict of every document under the adaptive limits."""
    return quality_rules.judge_quality(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op9_simhash")
def op9(spark, sf):
    """Fingerprint and component of every document."""
    out = simhash_cover.near_duplicates(table(spark, sf, "documents"))
    return out.select("doc_id", simhash_cover.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@register("op10_substring_dedup", rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {substring_cover.WINDOW - 1}], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {substring_cover.WINDOW - 1})) AS i FROM d
        WHERE len(ws) >= {substring_cover.WINDOW})
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + {substring_cover.WINDOW - 1})) AS p
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM w) WHERE doc_id > least
), l AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), k AS (
  SELECT doc_id, ws, coalesce(len(ps), 0) AS n, list_filter(list_transform(ws, lambda x, i:
         CASE WHEN list_contains(ps, i) THEN NULL ELSE x END), lambda x: x IS NOT NULL) AS kept
  FROM d LEFT JOIN l USING (doc_id)
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
""")
def op10(spark, sf):
    """Words of every document, those removed as repeats, and the digest of the rest."""
    out = substring_cover.dedup_substrings(table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _contamination_sql() -> str:
    words = (r"list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    k = decontaminate.WINDOW
    return f"""
WITH it AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item, least(len(ws), {k}) AS n, array_to_string(ws[i:i + least(len(ws), {k}) - 1], ' ') AS g
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - {k} + 1, 1))) AS i FROM it WHERE len(ws) > 0)
), d AS (SELECT doc_id, {words} AS ws FROM documents
), dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (
    SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i
    FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)
), h AS (SELECT doc_id, item, i, dw.n FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n
), c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY doc_id
), m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""


@register("op4_decontaminate", _contamination_sql())
def op4(spark, sf):
    """Words of every document that benchmark windows hit, and the items they come from."""
    out = decontaminate.match_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = decontaminate.covered_words(F.col("spans"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@register("op3_token_counts")
def op3(spark, sf):
    """Bytes and tokens of every document, over a cache that starts empty."""
    import public_tokenizers

    counts = token_cache.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                                      token_cache.fresh_cache(spark))
    return counts.withColumn("over_limit", F.col("n_tokens") > token_cache.TOKEN_LIMIT)


@register("op5_quality_classifier")
def op5(spark, sf):
    """Expected grade, probability of the good grade and verdict of every document."""
    docs = table(spark, sf, "documents")
    grades = quality_ordinal.graded_labels(table(spark, sf, "labels"))
    model = quality_ordinal.fit_ordinal(*quality_ordinal.labelled_features(docs, grades), n_grades=3)
    out = quality_ordinal.score_quality(docs, model, good_grade=2)
    return out.withColumn("kept", F.col("tail_probability") >= 0.5)


@register("op8_lm_scoring")
def op8(spark, sf):
    """Word-unigram base score and attention-model score of every document."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        tokenizer = f.read()
    return attention_lm.score_texts(table(spark, sf, "documents"), tokenizer)


@register("op11_exact_dedup", r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER g = 1 AS kept, sha256(t) AS text_sha256
FROM t WINDOW g AS (PARTITION BY t ORDER BY doc_id NULLS LAST)""")
def op11(spark, sf):
    """The row that stays, group size and digest of every document, dropped ones too."""
    out = exact_tree.exact_groups(table(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("sha")).alias("text_sha256"))


def _clusters_sql() -> str:
    """Every round spelled out: all distances, the smallest with the smallest number, exact floors of the means."""
    c = centroid_walk
    vector = f"list_transform(embedding, lambda x: CAST(floor({c.SCALE} * CAST(x AS DOUBLE)) AS BIGINT))"
    fine = (f"len(embedding) = {c.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) "
            f"OR abs(x) >= {c.LIMIT})) = 0")
    parts = [f"""s AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{c.SEED}' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS r, vec_id, v
  FROM (SELECT vec_id, {vector} AS v FROM embeddings WHERE {fine})
), x AS MATERIALIZED (SELECT r, unnest(v) AS v, generate_subscripts(v, 1) AS d FROM s
), c0 AS MATERIALIZED (SELECT r AS k, d, v AS c FROM x WHERE r < {c.K})"""]
    for i in range(c.ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, k, dist FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dist, k) AS place FROM (
    SELECT r, k, CAST(sum((v - c) * (v - c)) AS BIGINT) AS dist FROM x JOIN c{i} USING (d) GROUP BY r, k)) WHERE place = 1)""")
        if i < c.ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT k, d, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT k, d, CAST((t - ((t % n) + n) % n) // n AS BIGINT) AS m FROM (
      SELECT k, d, sum(v) AS t, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY k, d)) USING (k, d))""")
    last = c.ROUNDS
    return f"""WITH {", ".join(parts)}, h AS (
  SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN s USING (r) JOIN h USING (k)"""


@register("op12_centroid_clusters", _clusters_sql())
def op12(spark, sf):
    """Cluster and squared distance of every usable vector after ten rounds."""
    out = centroid_walk.cluster_vectors(table(spark, sf, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                      centroid_walk.centroid_digest(F.col("centroid")).alias("centroid_sha256"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts of ids with crc32 divisible by 10 become periodic from word a on, with period p."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words, n = split_words(F.col("t")), F.size("words")
    d = docs.select("doc_id", text_of(F.col("text")).alias("t"), F.floor(h / 10).alias("g"), (h % 10 == 0).alias("chosen"))
    d = d.withColumn("words", F.when(F.col("chosen"), words))
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    unit = F.slice("words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    whole = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return d.select("doc_id", F.when(F.col("chosen") & (n > 0), whole).otherwise(F.col("t")).alias("text"))


@register("op13_periodic_runs")
def op13(spark, sf):
    """Periodic runs of every document (with the planted ones), the strongest, and digests of runs and collapsed text."""
    out = periodic_runs.collapse_runs(planted_runs(table(spark, sf, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    return (out.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        periodic_runs.runs_digest(F.col("runs")).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))

"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL oracles.

Every query reads the driver tables (or data Spark derives from them) in
full. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gopher as G
from ..operators import metrics as M
from ..sources.tables import spread, table
from . import sqlfrag as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# =============================================================== 2.3 filters

_GOPHER_STATS_SQL = f"""
WITH t AS (
  SELECT doc_id, text, {S.token_string('text')} AS tok FROM documents
), s AS (
  SELECT doc_id, {S.strip("coalesce(text, '')")} = '' AS is_blank,
         {S.tokens('tok')} AS toks, {S.lines('text')} AS ls FROM t
), st AS (
  SELECT doc_id, is_blank,
         CAST(len(toks) AS BIGINT) AS n_tokens,
         CAST(coalesce(list_sum(list_transform(toks, lambda x: length(x))), 0) AS BIGINT) AS token_chars,
         CAST(len(list_filter(toks, lambda x: regexp_matches(x, '\\p{{L}}'))) AS BIGINT) AS n_alpha_tokens,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(list_filter(ls, lambda x: {S.ellipsis_line('x')})) AS BIGINT) AS n_ellipsis_lines
  FROM s
), r AS (
  SELECT *,
    n_tokens BETWEEN 50 AND 100000 AS p_word_count,
    n_tokens > 0 AND token_chars >= 3 * n_tokens AND token_chars <= 10 * n_tokens AS p_mean_word_length,
    n_lines = 0 OR 10 * n_ellipsis_lines <= 3 * n_lines AS p_ellipsis_lines,
    n_tokens > 0 AND 5 * n_alpha_tokens >= 4 * n_tokens AS p_alpha_ratio
  FROM st
)
"""

_GOPHER_REASON_SQL = """CASE WHEN is_blank THEN 'empty'
  WHEN NOT p_word_count THEN 'word_count'
  WHEN NOT p_mean_word_length THEN 'mean_word_length'
  WHEN NOT p_ellipsis_lines THEN 'ellipsis_lines'
  WHEN NOT p_alpha_ratio THEN 'alpha_ratio' END"""

_STAT_COLS_SQL = ", ".join(G.STAT_COLS)


@register("gopher_filter", _GOPHER_STATS_SQL + f"""
SELECT doc_id, {_GOPHER_REASON_SQL} AS reason, ({_GOPHER_REASON_SQL}) IS NULL AS keep,
       {_STAT_COLS_SQL} FROM r""")
def q_gopher_filter(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    out = G.gopher_filter(docs, keep_stats=True)
    return out.select("doc_id", "reason", "keep", *[F.col(f"gstats.{c}").alias(c) for c in G.STAT_COLS])


def _rule_query(rule: str, stat_cols: list[str]):
    def q(spark, sf):
        docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
        out = G.gopher_rule(docs, rule)
        return out.select("doc_id", *[F.col(f"gstats.{c}").alias(c) for c in stat_cols], "passes")
    return q


_RULES = {
    "gopher_word_count": ("word_count", ["n_tokens"], "p_word_count"),
    "gopher_mean_word_length": ("mean_word_length", ["n_tokens", "token_chars"], "p_mean_word_length"),
    "gopher_ellipsis_lines": ("ellipsis_lines", ["n_lines", "n_ellipsis_lines"], "p_ellipsis_lines"),
    "gopher_alpha_ratio": ("alpha_ratio", ["n_tokens", "n_alpha_tokens"], "p_alpha_ratio"),
    "gopher_non_empty": ("non_empty", [], "NOT is_blank"),
}
for _name, (_rule, _cols, _pred) in _RULES.items():
    _sel = ", ".join(["doc_id", *_cols, f"{_pred} AS passes"])
    register(_name, _GOPHER_STATS_SQL + f"SELECT {_sel} FROM r")(_rule_query(_rule, _cols))


from ..operators import sentences as SE  # noqa: E402
from ..session import materialize  # noqa: E402


def _abbreviations_sql() -> str:
    """CTEs ts(doc_id, ts) and learned(type, with_period, without_period, score, abbreviation)."""
    word, words = S.lit(SE.WORD), S.lit(r"[^\x20\x09-\x0D]+")
    return f"""
WITH ts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {words}) AS ts FROM documents),
w AS (SELECT lower(regexp_extract(t, {word}, 1)) AS type, regexp_extract(t, {word}, 2) = '.' AS k FROM (SELECT unnest(ts) AS t FROM ts)),
c AS (SELECT type, CAST(count(*) FILTER (k) AS BIGINT) AS with_period, CAST(count(*) FILTER (NOT k) AS BIGINT) AS without_period
      FROM w WHERE type <> '' GROUP BY type),
p AS (SELECT least(greatest(sum(with_period) / greatest(sum(with_period + without_period), 1), 1e-9), 1 - 1e-9) AS p FROM c),
l AS (SELECT c.*, p, length(replace(type, '.', '')) AS letters FROM c, p WHERE with_period > 0),
learned AS (SELECT type, with_period, without_period, abbreviation, score FROM (SELECT *, score >= {SE.LEAST_SCORE} AS abbreviation FROM (SELECT *,
  -2 * (with_period * ln(p) + without_period * ln(1 - p) - with_period * ln({SE.NEARLY_ALWAYS}) - without_period * ln(1 - {SE.NEARLY_ALWAYS}::DOUBLE))
  * exp(-letters) * (length(type) - letters + 1) * pow(letters::DOUBLE, -without_period) AS score FROM l)))"""


@register("abbreviations", _abbreviations_sql() + """
SELECT type, with_period, without_period, round(score, 6) + 0.0::DOUBLE AS score, abbreviation FROM learned""")
def q_abbreviations(spark, sf):
    """Word types seen with a period, and which of them are abbreviations by collocation."""
    counts = materialize(SE.type_counts(spread(table(spark, sf, "documents").select("text"))), "types")
    return SE.learn_abbreviations(counts).withColumn("score", F.round("score", 6) + F.lit(0.0))


@register("sentence_counts", _abbreviations_sql() + f""",
e AS (SELECT doc_id, i, len(ts) AS n, t, regexp_matches(t, {S.lit(SE.TERMINAL)}) AS terminal,
             regexp_matches(t, {S.lit(SE.TERMINAL.replace('.!?', '.'))}) AS period,
             regexp_extract(t, {S.lit(SE.WORD)}, 2) = '.' AND lower(regexp_extract(t, {S.lit(SE.WORD)}, 1)) IN
               (SELECT type FROM learned WHERE abbreviation) AS short
      FROM (SELECT doc_id, ts, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM ts))
SELECT doc_id, CAST(len(ts) AS BIGINT) AS n_words, CAST(coalesce(s, 0) AS BIGINT) AS n_abbreviations,
       CAST(coalesce(ends, 0) AS BIGINT) AS n_sentences, CAST(len(ts) + coalesce(periods, 0) AS BIGINT) AS n_tokens
FROM ts LEFT JOIN (SELECT doc_id, count(*) FILTER (short) AS s, count(*) FILTER (period AND NOT short) AS periods,
                          count(*) FILTER ((terminal AND NOT short) OR i = n) AS ends FROM e GROUP BY doc_id) USING (doc_id)""")
def q_sentence_counts(spark, sf):
    """Sentences and tokens of every document, with the abbreviations learned from all of them."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    counts = materialize(SE.type_counts(docs), "types")
    return SE.sentence_counts(docs, SE.learn_abbreviations(counts))


# =============================================================== 2.5 aggregations
@register("text_kept_ratio", _GOPHER_STATS_SQL + f"""
, k AS (SELECT r.doc_id, ({_GOPHER_REASON_SQL}) IS NULL AS keep FROM r)
SELECT d.source AS source, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(CASE WHEN k.keep THEN 1 ELSE 0 END) AS BIGINT) AS n_kept,
       CAST(sum(length(coalesce(d.text, ''))) AS BIGINT) AS total_chars,
       CAST(sum(CASE WHEN NOT k.keep THEN length(coalesce(d.text, '')) ELSE 0 END) AS BIGINT) AS skipped_chars,
       CASE WHEN sum(length(coalesce(d.text, ''))) > 0 THEN
         round(100.0 * (sum(length(coalesce(d.text, ''))) - sum(CASE WHEN NOT k.keep THEN length(coalesce(d.text, '')) ELSE 0 END))
               / sum(length(coalesce(d.text, ''))), 4) ELSE 0.0 END AS kept_pct
FROM documents d JOIN k ON d.doc_id = k.doc_id GROUP BY d.source""")
def q_text_kept_ratio(spark, sf):
    """Minimum slice: Gopher decision per document -> kept share of text by source."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text", "source")
    return M.text_kept_ratio(G.gopher_filter(docs), "keep", by=["source"])


# =============================================================== 2.2 PII masking
from ..operators import pii as PII  # noqa: E402


def _pii_sql(table_name: str, key_cols: str) -> str:
    e_t, e_n = S.mask("text", "email")
    p_t, p_n = S.mask("m1", "phone")
    i_t, i_n = S.mask("m2", "ip")
    return f"""
WITH a AS (SELECT {key_cols}, text, {e_t} AS m1, {e_n} AS n_email FROM {table_name}),
b AS (SELECT *, {p_t} AS m2, {p_n} AS n_phone FROM a),
c AS (SELECT *, {i_t} AS masked, {i_n} AS n_ip FROM b)"""


for _kind, _name in (("email", "mask_emails"), ("phone", "mask_phones"), ("ip", "mask_ips")):
    _t, _n = S.mask("text", _kind)

    def _mk(kind):
        def q(spark, sf):
            docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
            return PII.mask_one(docs, kind).select("doc_id", "masked", "n_masked")
        return q

    register(_name, f"SELECT doc_id, {_t} AS masked, {_n} AS n_masked FROM documents")(_mk(_kind))


@register("mask_pii", _pii_sql("documents", "doc_id") +
          "\nSELECT doc_id, masked, n_email, n_phone, n_ip FROM c")
def q_mask_pii(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return PII.mask_pii(docs).select("doc_id", "masked", "n_email", "n_phone", "n_ip")


@register("mask_pii_conversations", _pii_sql("conversations", "conv_id, turn, role") +
          "\nSELECT conv_id, turn, role, masked, n_email, n_phone, n_ip FROM c")
def q_mask_pii_conversations(spark, sf):
    conv = spread(table(spark, sf, "conversations"))
    return PII.mask_pii(conv).select("conv_id", "turn", "role", "masked", "n_email", "n_phone", "n_ip")


@register("pii_totals", _pii_sql("documents", "doc_id, source") + """
SELECT source, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n_email) AS BIGINT) AS n_email,
       CAST(sum(n_phone) AS BIGINT) AS n_phone, CAST(sum(n_ip) AS BIGINT) AS n_ip,
       CAST(sum(CASE WHEN n_email + n_phone + n_ip > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_docs_with_pii
FROM c GROUP BY source""")
def q_pii_totals(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "source", "text")
    return PII.pii_totals(PII.mask_pii(docs), ["source"])


# =============================================================== 2.2 text projections
from ..functions import text as TX  # noqa: E402


@register("preprocess_for_classifier", f"""
SELECT doc_id,
  {S.strip("replace(text, chr(10), ' ')")} AS lang_input,
  lower({S.strip("replace(text, chr(10), ' ')")}) AS classifier_input
FROM documents""")
def q_preprocess(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return docs.select("doc_id", TX.preprocess_for_classifier("text", lower=False).alias("lang_input"),
                       TX.preprocess_for_classifier("text").alias("classifier_input"))


@register("normalize_text", f"SELECT doc_id, {S.normalize('text')} AS norm FROM documents")
def q_normalize(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return docs.select("doc_id", TX.normalize_text("text").alias("norm"))


NGRAM_N = 5


@register("word_ngrams", f"""
WITH n AS (SELECT doc_id, {S.normalize('text')} AS norm FROM documents),
w AS (SELECT doc_id, norm, string_split(norm, ' ') AS words FROM n),
g AS (
  SELECT doc_id, CASE WHEN norm = '' THEN []::VARCHAR[]
                      WHEN len(words) < {NGRAM_N} THEN [norm]
                      ELSE list_distinct(list_transform(range(0, len(words) - {NGRAM_N} + 1),
                             lambda i: array_to_string(words[i + 1:i + {NGRAM_N}], ' '))) END AS grams
  FROM w)
SELECT doc_id, unnest(grams) AS shingle FROM g""")
def q_word_ngrams(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    n = docs.select("doc_id", TX.normalize_text("text").alias("norm"))
    g = n.select("doc_id", TX.word_ngrams("norm", NGRAM_N).alias("g"))
    return g.select("doc_id", F.explode("g").alias("shingle"))


_MIRROR = "https://mirror.example.org/"


@register("join_url", f"""
SELECT page_id,
  concat_ws('/', rtrim('{_MIRROR}', '/'),
            nullif(trim('crawl-data/', '/'), ''),
            nullif(trim(regexp_extract(url, '^[a-z]+://[^/]+(/[^?]*)?', 1), '/'), '')) AS mirror_url
FROM pages""")
def q_join_url(spark, sf):
    """Column map over a manifest: mirror base + fixed part + the page's path."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    path = F.regexp_extract("url", "^[a-z]+://[^/]+(/[^?]*)?", 1)
    return pages.select("page_id", TX.join_url(F.lit(_MIRROR), "crawl-data/", path).alias("mirror_url"))


@register("preview", """
SELECT doc_id,
  CASE WHEN length(text) > 350 THEN substr(text, 1, 350) || '...' ELSE text END AS preview,
  substr(text, 1, 30) AS head30, CAST(length(text) AS BIGINT) AS n_chars
FROM documents""")
def q_preview(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return docs.select("doc_id", TX.preview("text").alias("preview"),
                       F.substring("text", 1, 30).alias("head30"),
                       F.length("text").cast("bigint").alias("n_chars"))


@register("filter_english", """
SELECT doc_id, source, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE lang = 'en'""")
def q_filter_english(spark, sf):
    """Label form of the English predicate (model form: see operators/classify.py)."""
    docs = spread(table(spark, sf, "documents"))
    return docs.where(F.col("lang") == "en").select("doc_id", "source",
                                                    F.length("text").cast("bigint").alias("n_chars"))


# =============================================================== 2.9 deduplication
from ..operators import dedup_lines as DL  # noqa: E402
from ..operators import minhash as MH  # noqa: E402

_LINES_SQL = """
WITH p AS (
  SELECT doc_id, string_split(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS parts
  FROM documents
), l AS (
  SELECT doc_id, i AS pos,
         CASE WHEN i < len(parts) THEN parts[i] || chr(10) ELSE parts[i] END AS line
  FROM p, unnest(generate_series(1, len(parts))) AS t(i)
), lines AS (SELECT * FROM l WHERE line <> '')"""


@register("line_frequencies", _LINES_SQL + """
SELECT md5(line) AS line_md5, CAST(count(*) AS BIGINT) AS n FROM lines GROUP BY 1""")
def q_line_frequencies(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return DL.line_frequencies(docs)


@register("dedup_lines", _LINES_SQL + """
, freq AS (SELECT md5(line) AS h, count(*) AS c FROM lines GROUP BY 1)
, keep AS (SELECT l.doc_id, l.pos, l.line FROM lines l JOIN freq f ON md5(l.line) = f.h WHERE f.c = 1)
SELECT d.doc_id, coalesce(string_agg(k.line, '' ORDER BY k.pos), '') AS text
FROM documents d LEFT JOIN keep k ON d.doc_id = k.doc_id GROUP BY d.doc_id""")
def q_dedup_lines(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return DL.dedup_lines(docs)


# MinHash parameters of the reference's exact-duplicate test
MH_PARAMS = MH.MinHashParams(num_hashes=100, num_bands=10, ngrams=5, threshold=0.8, mode="md5")


def _shingles_sql(n: int) -> str:
    return f"""
WITH RECURSIVE nrm AS (SELECT doc_id, {S.normalize('text')} AS norm FROM documents),
w AS (SELECT doc_id, norm, string_split(norm, ' ') AS words FROM nrm),
g AS (
  SELECT doc_id, CASE WHEN norm = '' THEN []::VARCHAR[]
                      WHEN len(words) < {n} THEN [norm]
                      ELSE list_distinct(list_transform(range(0, len(words) - {n} + 1),
                             lambda i: array_to_string(words[i + 1:i + {n}], ' '))) END AS grams
  FROM w)"""


def _minhash_sql(p: MH.MinHashParams) -> str:
    h, r = p.num_hashes, p.rows
    return _shingles_sql(p.ngrams) + f""",
sh AS (SELECT doc_id, unnest(grams) AS s FROM g),
sizes AS (SELECT doc_id, CAST(len(grams) AS BIGINT) AS k FROM g),
sig AS (
  SELECT sh.doc_id, r.i, min({S.md5_u32le("CAST(r.i AS VARCHAR) || '-' || sh.s")}) AS mh
  FROM sh, range(0, {h}) r(i) GROUP BY sh.doc_id, r.i
  UNION ALL
  SELECT g.doc_id, r.i, CAST(0 AS BIGINT) FROM g, range(0, {h}) r(i) WHERE len(g.grams) = 0),
bands AS (
  SELECT doc_id, CAST(i // {r} AS INTEGER) AS band, string_agg(CAST(mh AS VARCHAR), ',' ORDER BY i) AS key
  FROM sig GROUP BY doc_id, i // {r}),
cand AS (
  SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM bands a JOIN bands b
    ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id),
inter AS (
  SELECT c.u, c.v, count(*) AS ni FROM cand c JOIN sh x ON x.doc_id = c.u
    JOIN sh y ON y.doc_id = c.v AND x.s = y.s GROUP BY c.u, c.v),
jac AS (
  SELECT c.u, c.v, coalesce(i.ni, 0) AS ni, su.k + sv.k - coalesce(i.ni, 0) AS nu
  FROM cand c LEFT JOIN inter i ON c.u = i.u AND c.v = i.v
  JOIN sizes su ON su.doc_id = c.u JOIN sizes sv ON sv.doc_id = c.v),
edges AS (SELECT u, v FROM jac WHERE (CASE WHEN nu = 0 THEN 1.0 ELSE ni / nu END) >= {p.threshold}),
e2 AS (SELECT u AS a, v AS b FROM edges UNION ALL SELECT v, u FROM edges),
reach(node, comp) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e2.b, reach.comp FROM reach JOIN e2 ON reach.node = e2.a),
clusters AS (SELECT node AS doc_id, min(comp) AS component FROM reach GROUP BY node)
"""


@register("minhash_signature", _minhash_sql(MH_PARAMS) + """
SELECT doc_id, CAST(i AS INTEGER) AS hash_idx, mh AS minhash FROM sig""")
def q_minhash_signature(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    sig = MH.signature_table(docs, MH_PARAMS)
    return sig.select("doc_id", F.posexplode("sig").alias("hash_idx", "minhash"))


@register("lsh_buckets", _minhash_sql(MH_PARAMS) + """
SELECT band, key, CAST(count(*) AS BIGINT) AS n_docs FROM bands GROUP BY band, key HAVING count(*) >= 2""")
def q_lsh_buckets(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    sig = MH.signature_table(docs, MH_PARAMS)
    return MH.lsh_buckets(sig, MH_PARAMS).select(F.col("band").cast("int").alias("band"), "key", "n_docs")


def _clusters(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return MH.duplicate_clusters(docs, MH_PARAMS)


@register("duplicate_clusters", _minhash_sql(MH_PARAMS) + "SELECT doc_id, component FROM clusters")
def q_duplicate_clusters(spark, sf):
    return _clusters(spark, sf)


@register("component_size", _minhash_sql(MH_PARAMS) + """
SELECT component, CAST(count(*) AS BIGINT) AS n_docs FROM clusters GROUP BY component""")
def q_component_size(spark, sf):
    return _clusters(spark, sf).groupBy("component").agg(F.count(F.lit(1)).alias("n_docs"))


@register("dedup_minhash", _minhash_sql(MH_PARAMS) + """
SELECT d.doc_id, d.source FROM documents d JOIN clusters c ON d.doc_id = c.doc_id
WHERE d.doc_id = c.component""")
def q_dedup_minhash(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return MH.dedup_minhash(docs, MH_PARAMS).select("doc_id", "source")


# --------------------------------------------------------------- 2.9 exact similarity join
from ..operators import setjoin as SJ  # noqa: E402
from ..session import materialize  # noqa: E402


def _similar_sql() -> str:
    """CTEs who(doc_id, rep) and pairs(x, y, common, total): all pairs of distinct sets that share a shingle, compared."""
    return _shingles_sql(SJ.NGRAMS) + f""",
k AS (SELECT doc_id, grams, len(grams) AS n, min(doc_id) OVER (PARTITION BY array_to_string(list_sort(grams), chr(10)), len(grams)) AS rep
      FROM g),
who AS (SELECT doc_id, rep FROM k),
one AS (SELECT rep, n, unnest(grams) AS s FROM k WHERE doc_id = rep),
pairs AS (
  SELECT a.rep AS x, b.rep AS y, count(*) AS common, a.n + b.n - count(*) AS total
  FROM one a JOIN one b ON a.s = b.s AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n
  HAVING count(*) >= {SJ.THRESHOLD} * (a.n + b.n - count(*)))"""


@register("exact_jaccard_pairs", _similar_sql() + """
SELECT x, y, CAST(common AS BIGINT) AS common, CAST(total AS BIGINT) AS total, round(common / total, 6) AS jaccard FROM pairs""")
def q_exact_jaccard_pairs(spark, sf):
    """All pairs of distinct shingle sets (5 words) with Jaccard >= 0.8, by their representatives."""
    found, _ = SJ.similar_pairs(spread(table(spark, sf, "documents").select("doc_id", "text")))
    return found.select("x", "y", "common", "total", F.round("jaccard", 6).alias("jaccard"))


@register("exact_jaccard_documents", _similar_sql() + """,
e2 AS (SELECT x AS a, y AS b FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(node, comp) AS (SELECT DISTINCT rep, rep FROM who UNION SELECT e2.b, reach.comp FROM reach JOIN e2 ON reach.node = e2.a),
parts AS (SELECT node, min(comp) AS component FROM reach GROUP BY node),
links AS (SELECT a, count(*) AS n FROM e2 GROUP BY a)
SELECT doc_id, rep, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component
FROM who JOIN parts ON node = rep LEFT JOIN links ON a = rep""")
def q_exact_jaccard_documents(spark, sf):
    """Every document's set, the number of other sets similar to it, and its component."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return SJ.linked_documents(*SJ.similar_pairs(docs))


def _recall(spark, sf, p: MH.MinHashParams):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    bands = MH.band_rows(materialize(MH.signature_table(docs, p), "sig_tbl"), p)
    return SJ.lsh_recall(*SJ.similar_pairs(docs), bands)


@register("lsh_recall_md5", _minhash_sql(MH_PARAMS) + "," + _similar_sql().removeprefix(_shingles_sql(SJ.NGRAMS) + ",") + """,
met AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM bands a JOIN bands b ON a.band = b.band AND a.key = b.key)
SELECT count(*) AS n_pairs, count(m.x) AS n_found FROM pairs p LEFT JOIN met m ON m.x = p.x AND m.y = p.y""")
def q_lsh_recall_md5(spark, sf):
    """Of all similar pairs of distinct sets, those that the md5 bands make candidates."""
    return _recall(spark, sf, MH_PARAMS)


@register("lsh_recall_fast")
def q_lsh_recall_fast(spark, sf):
    """Of all similar pairs of distinct sets, those that the fast bands make candidates."""
    return _recall(spark, sf, CU.FLAGSHIP_PARAMS)


# =============================================================== 2.2/2.4/2.6/2.8 pages
from ..functions import html as H  # noqa: E402
from ..operators import extraction as X  # noqa: E402
from ..operators import urls as U  # noqa: E402

_HOST_SQL = f"lower(regexp_extract(url, {S.lit(X.HOST_RE)}, 1))"
_TITLE_SQL = f"regexp_extract(html, {S.lit(X.TITLE_RE)}, 1)"


def _pages(spark, sf):
    return spread(table(spark, sf, "pages"))


@register("strip_tags", f"SELECT page_id, url, {S.strip_tags('html')} AS text FROM pages")
def q_strip_tags(spark, sf):
    return X.pages_to_text(_pages(spark, sf), builtin=True).select("page_id", "url", "text")


@register("pages_to_text")
def q_pages_to_text(spark, sf):
    """Parser-based extraction (Arrow helper); rows-only check + golden test."""
    return X.pages_to_text(_pages(spark, sf)).select("page_id", "url", "text")


@register("compare_parser_extraction")
def q_compare_parser_extraction(spark, sf):
    """Parser extraction vs regex extraction of the same pages, by URL."""
    p = _pages(spark, sf)
    a = X.pages_to_text(p, out_col="text_a").select("url", "text_a")
    b = X.pages_to_text(p, out_col="text_b", builtin=True).select("url", "text_b")
    return X.compare_extractions(a, b)


_PAIRS_SQL = f"""
WITH a AS (SELECT url, {S.strip(S.strip_tags('html'))} AS ta FROM pages),
b AS (SELECT url, {S.strip(_TITLE_SQL)} AS tb FROM pages),
j AS (SELECT a.url, ta, tb FROM a JOIN b ON a.url = b.url WHERE ta <> '' AND tb <> '')
SELECT url, CAST(length(ta) AS BIGINT) AS len_a, CAST(length(tb) AS BIGINT) AS len_b,
  CASE WHEN length(ta) > 350 THEN substr(ta, 1, 350) || '...' ELSE ta END AS preview_a,
  CASE WHEN length(tb) > 350 THEN substr(tb, 1, 350) || '...' ELSE tb END AS preview_b
FROM j"""


def _pair_sets(spark, sf):
    p = _pages(spark, sf)
    a = X.pages_to_text(p, out_col="text_a", builtin=True).select("url", "text_a")
    b = p.select("url", F.regexp_extract("html", X.TITLE_RE, 1).alias("text_b"))
    return X.compare_extractions(a, b)


@register("filter_non_blank_pair", _PAIRS_SQL)
def q_filter_non_blank_pair(spark, sf):
    """F10 (+J1 shape): body text vs title text per URL, blank pairs dropped."""
    return _pair_sets(spark, sf)


@register("compare_extractions", _PAIRS_SQL)
def q_compare_extractions(spark, sf):
    """Regex extraction vs title of the same pages, by URL."""
    return _pair_sets(spark, sf)


@register("limit_pairs", _PAIRS_SQL + " ORDER BY url LIMIT 3")
def q_limit_pairs(spark, sf):
    return X.limit_pairs(_pair_sets(spark, sf), 3)


@register("last_record_per_uri", f"""
SELECT host, page_id, url FROM (
  SELECT {_HOST_SQL} AS host, page_id, url,
         row_number() OVER (PARTITION BY {_HOST_SQL} ORDER BY page_id DESC) AS rn FROM pages)
WHERE rn = 1""")
def q_last_record_per_uri(spark, sf):
    """The last page (largest page_id) per host wins."""
    p = table(spark, sf, "pages").select("page_id", "url").withColumn("host", X.host(F.col("url")))
    return X.last_record_per_key(p, "host", "page_id", ["url"])


@register("common_uris", f"""
SELECT {_HOST_SQL} AS host FROM pages WHERE regexp_extract(html, {S.lit(X.LANG_RE)}, 1) = 'en'
INTERSECT
SELECT {_HOST_SQL} AS host FROM pages WHERE regexp_extract(html, {S.lit(X.LANG_RE)}, 1) = 'fr'""")
def q_common_uris(spark, sf):
    """Hosts serving both English and French pages."""
    p = table(spark, sf, "pages")
    lang = F.regexp_extract("html", X.LANG_RE, 1)
    hosts = p.select(X.host(F.col("url")).alias("host"), lang.alias("lang"))
    return X.common_keys(hosts.where("lang = 'en'"), hosts.where("lang = 'fr'"), "host")


_HREF_RE = 'href="([^"]*)"'


@register("distinct_sorted_names", f"""
SELECT DISTINCT unnest(regexp_extract_all(html, {S.lit(_HREF_RE)}, 1)) AS name FROM pages ORDER BY name""")
def q_distinct_sorted_names(spark, sf):
    """U4: sorted distinct link targets over all pages."""
    return U.distinct_sorted_matches(table(spark, sf, "pages"), "html", _HREF_RE)


# ---- reference-URL lines derived from the pages (the HTML has no absolute links)
def reference_lines(pages):
    """(shard, line_no, line): a dump-style line per page with two escaped ref
    tags (the page URL and a mirror URL with a trailing full stop) and a URL
    outside the refs that must not be extracted."""
    url = F.col("url")
    mirror = F.concat(F.lit("https://mirror.example.org/"), X.host(url), F.lit("/p"),
                      F.col("page_id").cast("string"))
    line = F.concat(F.lit("* "), F.regexp_extract("html", X.TITLE_RE, 1),
                    F.lit(" &lt;ref&gt;{{cite web |url="), url, F.lit(" |title=x}}&lt;/ref&gt; and "),
                    F.lit("&lt;ref&gt;see "), mirror, F.lit(".&lt;/ref&gt; then http://outside.example.org/a."))
    return pages.select(X.host(url).alias("shard"), F.col("page_id").alias("line_no"), line.alias("line"))


_REF_LINES_SQL = f"""
WITH lines AS (
  SELECT {_HOST_SQL} AS shard, page_id AS line_no,
    '* ' || {_TITLE_SQL} || ' &lt;ref&gt;{{{{cite web |url=' || url || ' |title=x}}}}&lt;/ref&gt; and '
    || '&lt;ref&gt;see ' || 'https://mirror.example.org/' || {_HOST_SQL} || '/p' || CAST(page_id AS VARCHAR)
    || '.&lt;/ref&gt; then http://outside.example.org/a.' AS line
  FROM pages),
u AS (SELECT shard, line_no, {S.reference_urls('line')} AS urls FROM lines),
x AS (SELECT shard, line_no, CAST(p - 1 AS INTEGER) AS url_pos, urls[p] AS url
      FROM u, unnest(generate_series(1, len(urls))) AS t(p))"""


@register("extract_reference_urls", _REF_LINES_SQL + " SELECT shard, line_no, url_pos, url FROM x")
def q_extract_reference_urls(spark, sf):
    lines = reference_lines(table(spark, sf, "pages"))
    return U.extract_reference_urls(lines, keep=["shard", "line_no"])


@register("urls_per_shard", _REF_LINES_SQL + """
SELECT shard, CAST(count(*) AS BIGINT) AS n_urls FROM x GROUP BY ROLLUP (shard)""")
def q_urls_per_shard(spark, sf):
    lines = reference_lines(table(spark, sf, "pages"))
    return U.urls_per_shard(U.extract_reference_urls(lines, keep=["shard", "line_no"]))


@register("first_n_shards", f"""
SELECT DISTINCT {_HOST_SQL} AS shard FROM pages ORDER BY shard LIMIT 10""")
def q_first_n_shards(spark, sf):
    lines = reference_lines(table(spark, sf, "pages"))
    return U.first_n(lines, "shard", 10)


# =============================================================== 2.7 sampling, 2.6 W2/W3, J5, A7-A9
from ..operators import sampling as SM  # noqa: E402


def _seeded_sql(col: str, seed: int) -> str:
    return f"md5('{seed}:' || CAST({col} AS VARCHAR))"


@register("sample_n", f"""
SELECT doc_id, source FROM documents ORDER BY {_seeded_sql('doc_id', 0)}, doc_id LIMIT 100""")
def q_sample_n(spark, sf):
    """L1: 100 documents without replacement, seed 0."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return SM.sample_n(docs, 100, "doc_id", seed=0)


@register("sample_half", f"""
SELECT doc_id, source FROM documents ORDER BY {_seeded_sql('doc_id', 5)}, doc_id LIMIT (SELECT count(*) // 2 FROM documents)""")
def q_sample_half(spark, sf):
    """L1 at large n: half of all documents, without a sort of the corpus or a one-task top-n."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return SM.sample_n(docs, docs.count() // 2, "doc_id", seed=5)


@register("seeded_prefix_sample", f"""
SELECT url FROM pages ORDER BY {_seeded_sql('url', 336)}, url LIMIT 48""")
def q_seeded_prefix_sample(spark, sf):
    """L2: the page URLs as a path manifest, 50 requested -> 48 (multiple of 4)."""
    return SM.seeded_prefix_sample(table(spark, sf, "pages").select("url"), 50, key="url")


@register("assign_chunks", f"""
SELECT CAST(rank AS BIGINT) AS rank, url, CAST((rank - 1) // 4 AS BIGINT) AS chunk FROM (
  SELECT url, row_number() OVER (ORDER BY {_seeded_sql('url', 336)}, url) AS rank FROM pages)
WHERE rank <= 48""")
def q_assign_chunks(spark, sf):
    """Consecutive chunks of 4 in the seeded order."""
    out = SM.assign_chunks(table(spark, sf, "pages").select("url"), 50, key="url")
    return out.select(F.col("rank").cast("bigint").alias("rank"), "url", "chunk")


@register("train_test_split", f"""
SELECT doc_id, CASE WHEN CAST(('0x' || substr({_seeded_sql('doc_id', 42)}, 1, 8))::UBIGINT AS BIGINT) % 5 = 0
  THEN 'test' ELSE 'train' END AS split FROM labels""")
def q_train_test_split(spark, sf):
    """80/20 split of the labelled documents, seed 42."""
    return SM.train_test_split(table(spark, sf, "labels").select("doc_id"), "doc_id")


@register("pending_shards", f"""
SELECT DISTINCT {_HOST_SQL} AS host FROM pages
WHERE {_HOST_SQL} NOT IN (SELECT {_HOST_SQL} FROM pages WHERE regexp_extract(html, {S.lit(X.LANG_RE)}, 1) = 'en')""")
def q_pending_shards(spark, sf):
    """Hosts (shards) without a finished output; 'finished' = has an English page."""
    p = table(spark, sf, "pages").select(X.host(F.col("url")).alias("host"),
                                         F.regexp_extract("html", X.LANG_RE, 1).alias("lang"))
    return SM.pending(p.select("host").distinct(), p.where("lang = 'en'"), "host")


@register("corpus_summary", """
SELECT source, CAST(count(*) AS BIGINT) AS n_files, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes
FROM documents GROUP BY source""")
def q_corpus_summary(spark, sf):
    return M.corpus_summary(table(spark, sf, "documents").select("source", "text"))


@register("document_frequency", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), {S.lit(M.WORD_RE)}) AS toks FROM documents),
g AS (SELECT doc_id, toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]) AS bi FROM t),
terms AS (SELECT doc_id, unnest(list_concat(toks, bi)) AS term FROM g),
pd AS (SELECT doc_id, term, count(*) AS c FROM terms GROUP BY doc_id, term)
SELECT term, CAST(sum(c) AS BIGINT) AS tf, CAST(count(*) AS BIGINT) AS df FROM pd
GROUP BY term ORDER BY tf DESC, term LIMIT 50000""")
def q_document_frequency(spark, sf):
    """Vocabulary statistics, 1-2-grams, top 50,000 by corpus frequency."""
    return M.document_frequency(spread(table(spark, sf, "documents")).select("doc_id", "text"))


@register("classification_report", _GOPHER_STATS_SQL + f"""
, pred AS (SELECT l.quality AS y, CASE WHEN ({_GOPHER_REASON_SQL}) IS NULL THEN 1 ELSE 0 END AS p
           FROM r JOIN labels l ON l.doc_id = r.doc_id),
conf AS (SELECT CAST(y AS VARCHAR) AS y, CAST(p AS VARCHAR) AS p, count(*) AS c FROM pred GROUP BY 1, 2),
cls AS (SELECT y AS cls FROM conf UNION SELECT p FROM conf),
per AS (SELECT cls,
          coalesce((SELECT sum(c) FROM conf WHERE y = cls AND p = cls), 0) AS tp,
          coalesce((SELECT sum(c) FROM conf WHERE y = cls), 0) AS sup,
          coalesce((SELECT sum(c) FROM conf WHERE p = cls), 0) AS npred FROM cls),
m AS (SELECT cls, CASE WHEN npred > 0 THEN tp / npred ELSE 0 END AS pr,
             CASE WHEN sup > 0 THEN tp / sup ELSE 0 END AS rc, sup FROM per),
m2 AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f FROM m)
SELECT cls AS class, round(pr, 6) AS "precision", round(rc, 6) AS recall, round(f, 6) AS f1,
       CAST(sup AS BIGINT) AS support FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(CASE WHEN y = p THEN c ELSE 0 END) / sum(c), 6),
       CAST(sum(c) AS BIGINT) FROM conf
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f), 6), CAST(sum(sup) AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', round(sum(pr * sup) / sum(sup), 6), round(sum(rc * sup) / sum(sup), 6),
       round(sum(f * sup) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM m2""")
def q_classification_report(spark, sf):
    """A8 on a fixed prediction rule: Gopher 'keep' as a predictor of labels.quality."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    pred = G.gopher_filter(docs).select("doc_id", F.col("keep").cast("int").alias("prediction"))
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return M.classification_report(lab.join(pred, "doc_id"))


@register("pick_per_component", _minhash_sql(MH_PARAMS) + f"""
SELECT arg_min(doc_id, {_seeded_sql('doc_id', 7)}) AS doc_id, component FROM clusters GROUP BY component""")
def q_pick_per_component(spark, sf):
    """W2 with keep='random': one seeded choice per near-duplicate cluster."""
    return MH.pick_per_component(_clusters(spark, sf), keep="random", seed=7)


# =============================================================== 2.10 M1 language
from ..operators import classify as C  # noqa: E402
from ..operators import language as LG  # noqa: E402


def _split_docs(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text", "lang")
    return SM.train_test_split(docs, "doc_id")


def _language_model(spark, sf):
    return LG.train_language_id(_split_docs(spark, sf).where("split = 'train'"))


def _grams_sql(src: str, cols: str) -> str:
    strip = S.strip("replace(text, chr(10), ' ')")
    return (f"SELECT {cols}, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS gram "
            f"FROM (SELECT {cols}, ' ' || lower({strip}) || ' ' AS t FROM {src})")


def _language_sql(texts: str) -> str:
    """CTEs ending in judged(id, lang, score) over ``texts``, a query of (id, text)."""
    return f"""
WITH d AS (SELECT doc_id, text, lang, CASE WHEN CAST(('0x' || substr({_seeded_sql('doc_id', 42)}, 1, 8))::UBIGINT AS BIGINT) % 5 = 0
  THEN 'test' ELSE 'train' END AS split FROM documents),
gl AS (SELECT gram, lang, count(*) AS c FROM ({_grams_sql("(SELECT * FROM d WHERE split = 'train')", "lang")}) GROUP BY gram, lang),
langs AS (SELECT lang, ln(nd / sum(nd) OVER ()) AS prior, ln(nl + (SELECT count(DISTINCT gram) FROM gl)) AS logden
          FROM (SELECT lang, count(*) AS nd FROM d WHERE split = 'train' GROUP BY lang) JOIN
               (SELECT lang, sum(c) AS nl FROM gl GROUP BY lang) USING (lang)),
x AS ({texts}),
g AS (SELECT id, gram, count(*) AS cnt FROM ({_grams_sql("x", "id")}) WHERE gram IN (SELECT gram FROM gl) GROUP BY id, gram),
sparse AS (SELECT id, lang, sum(cnt * ln(c + 1)) AS s FROM g JOIN gl USING (gram) GROUP BY id, lang),
nin AS (SELECT id, sum(cnt) AS n FROM g GROUP BY id),
base AS (SELECT x.id, l.lang, prior + CASE WHEN n IS NULL THEN 0 ELSE
           (coalesce(s, 0) - n * logden) / n * least(n, {LG.EVIDENCE}) END AS score
         FROM x CROSS JOIN langs l LEFT JOIN nin ON nin.id = x.id LEFT JOIN sparse p ON p.id = x.id AND p.lang = l.lang),
judged AS (SELECT id, arg_max(lang, score) AS lang, 1 / sum(exp(score - top)) AS score
           FROM (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM base) GROUP BY id)"""


_DOC_LANGUAGE_SQL = _language_sql("SELECT doc_id AS id, text FROM documents")


@register("identify_language", _DOC_LANGUAGE_SQL + """
SELECT id AS doc_id, split, judged.lang AS lang, round(score, 4) AS score FROM judged JOIN d ON d.doc_id = id""")
def q_identify_language(spark, sf):
    """M1: character-trigram model trained on the 80 % split, applied to all documents."""
    pred = LG.identify_language(_language_model(spark, sf), _split_docs(spark, sf), keep=["doc_id", "split"])
    return pred.drop("score_raw")


@register("langid_nb_sql", _DOC_LANGUAGE_SQL + "SELECT id AS doc_id, lang FROM judged")
def q_langid_nb_sql(spark, sf):
    """M1, the label alone."""
    return LG.identify_language(_language_model(spark, sf), _split_docs(spark, sf), keep=["doc_id"]).select("doc_id", "lang")


@register("filter_english_model", _DOC_LANGUAGE_SQL + """
SELECT id AS doc_id, lang, round(score, 4) AS score FROM judged WHERE lang = 'en' AND score >= 0.7""")
def q_filter_english_model(spark, sf):
    """F9 model form: predicted 'en' with unrounded score >= 0.7."""
    pred = LG.identify_language(_language_model(spark, sf), _split_docs(spark, sf), keep=["doc_id"])
    return pred.where(LG.is_english()).select("doc_id", "lang", "score")


@register("filter_by", f"SELECT doc_id FROM documents WHERE length(text) - length(replace(text, 'the', '')) > 0")
def q_filter_by(spark, sf):
    """§2.13: a plain ``str -> bool`` predicate over all documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return X.filter_by(docs, lambda t: "the" in t).select("doc_id")


# =============================================================== 2.1 sources / 2.12 streaming
from ..session import materialize, scratch_path  # noqa: E402
from ..sources import archive_format as AF  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..sources import url_list as UL  # noqa: E402
from ..sources import warc as W  # noqa: E402
from ..streaming import incremental as W_stream  # noqa: E402


def _mixed_responses(spark, sf):
    """(t, u, b): the pages as responses; every 5th has no URI, every 7th is not HTML, every
    11th holds bytes that are no UTF-8, every 13th an embedded record."""
    p = table(spark, sf, "pages")
    k = F.col("page_id")
    ctype = F.when(k % 7 == 0, "image/png").otherwise("text/html; charset=windows-1252")
    inner = F.when(k % 13 == 0, "WARC/1.0\r\nWARC-Type: conversion\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n").otherwise("")
    body = F.concat(F.col("html"), inner).cast("binary")
    body = F.concat(body, F.when(k % 11 == 0, F.unhex(F.lit("E9"))).otherwise(F.unhex(F.lit(""))))
    http = F.concat(F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: "), ctype, F.lit("\r\n\r\n")).cast("binary"), body)
    return p.select(F.lit("response").alias("t"), F.when(k % 5 != 0, F.col("url")).alias("u"), http.alias("b"))


def _warc_of_pages(spark, sf) -> str:
    path = scratch_path(spark, "pages-warc")
    info = table(spark, sf, "pages").limit(1).select(F.lit("warcinfo").alias("t"), F.lit(None).cast("string").alias("u"),
                                                     F.lit("software: trawl\r\n").cast("binary").alias("b"))
    recs = info.unionByName(_mixed_responses(spark, sf))
    W.write_archive(recs, path, F.col("t"), F.col("u"), F.col("b"))
    return path


_RESPONSES_SQL = """
WITH r AS (SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN url END AS uri,
  CASE WHEN page_id % 7 = 0 THEN 'image/png' ELSE 'text/html; charset=windows-1252' END AS content_type,
  html || CASE WHEN page_id % 13 = 0 THEN 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: conversion' || chr(13) || chr(10)
    || 'Content-Length: 3' || chr(13) || chr(10) || chr(13) || chr(10) || 'abc' || chr(13) || chr(10) || chr(13) || chr(10) ELSE '' END AS body
  FROM pages)
SELECT uri, content_type, CAST(strlen(body) + CASE WHEN page_id % 11 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_bytes,
       CASE WHEN page_id % 11 = 0 THEN NULL ELSE body END AS html FROM r"""


def _scanned(recs):
    # a page with an invalid byte is decoded as windows-1252; tests hold its text, SQL its size
    broken = ~F.is_valid_utf8(F.col("payload").cast("string"))
    return recs.select("uri", "content_type", F.octet_length("payload").alias("n_bytes"),
                       F.when(~broken, F.col("html")).alias("html"))


@register("scan_warc", _RESPONSES_SQL + " WHERE uri IS NOT NULL AND content_type LIKE '%text/html%'")
def q_scan_warc(spark, sf):
    """S1 variant B (+P1, F8): pages written as a WARC archive by Spark, scanned back, HTML with a URI only."""
    return _scanned(W.scan_warc(spark, _warc_of_pages(spark, sf), require_html=True)[0])


@register("scan_warc_all", _RESPONSES_SQL)
def q_scan_warc_all(spark, sf):
    """S1 variant A: every response."""
    return _scanned(W.scan_warc(spark, _warc_of_pages(spark, sf), require_html=False)[0])


@register("filter_record_type", """
SELECT 'response' AS warc_type, CAST(count(*) AS BIGINT) AS n_records FROM pages
UNION ALL SELECT 'warcinfo', CAST(1 AS BIGINT)""")
def q_filter_record_type(spark, sf):
    """record counts by type; rejected rows count as 'rejected: <reason>'."""
    rows = W.parse_archive(spark, _warc_of_pages(spark, sf))
    kind = F.coalesce(F.concat(F.lit("rejected: "), F.col("reason")), F.col("warc_type"))
    return rows.groupBy(kind.alias("warc_type")).agg(F.count(F.lit(1)).alias("n_records"))


def _wet_texts(spark, sf):
    """(url, text, chunk): texts of pages and documents in 16 chunks that mix languages."""
    txt = X.pages_to_text(_pages(spark, sf), builtin=True).select("url", "text")
    docs = table(spark, sf, "documents").select(F.concat(F.lit("doc:"), F.col("doc_id")).alias("url"), "text")
    return txt.unionByName(docs).withColumn("chunk", F.concat(F.lit("c"), F.substring(F.md5("url"), 1, 1)))


def _wet_of_pages(spark, sf, partition_by=None) -> str:
    """The texts as WET records, by the text writer."""
    path = scratch_path(spark, "pages-wet")
    W.text_to_wet(_wet_texts(spark, sf), path, partition_by=partition_by)
    return path


_WET_SQL = f"""SELECT url AS id, {S.strip_tags('html')} AS text FROM pages
UNION ALL SELECT 'doc:' || doc_id AS id, text FROM documents"""


@register("scan_wet", f"SELECT id AS uri, text FROM ({_WET_SQL})")
def q_scan_wet(spark, sf):
    """Extracted texts written as a WET archive, scanned back."""
    return W.scan_wet(spark, _wet_of_pages(spark, sf))[0].select("uri", "text")


_KEPT_SHARE_SQL = _language_sql(_WET_SQL) + """
, w AS (SELECT 'c' || substr(md5(x.id), 1, 1) AS chunk, CAST(length(text) AS BIGINT) AS n,
               lang = 'en' AND score >= 0.7 AS keep FROM x JOIN judged USING (id))
SELECT chunk, CAST(sum(n) AS BIGINT) AS total_chars, CAST(sum(CASE WHEN keep THEN 0 ELSE n END) AS BIGINT) AS skipped_chars,
       CASE WHEN sum(n) > 0 THEN round(100.0 * (sum(n) - sum(CASE WHEN keep THEN 0 ELSE n END)) / sum(n), 2)
            ELSE 0.0 END AS kept_pct"""


def _filtered_wet(spark, sf):
    src = scratch_path(spark, "wet")
    AF.write_records(_wet_texts(spark, sf).select(F.lit("conversion").alias("warc_type"), F.col("url").alias("uri"),
                                                  F.col("text").cast("binary").alias("block"), "chunk"), src)
    recs = AF.read_archive(spark, src).where("reason IS NULL").withColumn("chunk", W_stream.chunk_of_file(F.col("file")))
    out = scratch_path(spark, "wet-filtered")
    return W.write_filtered_wet(recs, LG.English(_language_model(spark, sf)), out), out


@register("write_filtered_wet", _KEPT_SHARE_SQL + " FROM w GROUP BY chunk")
def q_write_filtered_wet(spark, sf):
    """S6 + A4: conversion records that the language model calls English are written as archives; kept share per chunk."""
    return _filtered_wet(spark, sf)[0]


@register("filtered_wet_records", _language_sql(_WET_SQL) + """
SELECT 'c' || substr(md5(x.id), 1, 1) AS chunk, x.id AS uri, text FROM x JOIN judged USING (id)
WHERE lang = 'en' AND score >= 0.7""")
def q_filtered_wet_records(spark, sf):
    """The written archives, read back."""
    recs = AF.read_archive(spark, _filtered_wet(spark, sf)[1])
    return recs.select(W_stream.chunk_of_file(F.col("file")).alias("chunk"), "uri", F.col("block").cast("string").alias("text"))


def _archive_of_pages(spark, sf) -> str:
    """The mixed responses as an archive, a gzip member a record."""
    path = scratch_path(spark, "pages-archive")
    recs = _mixed_responses(spark, sf).select(F.col("t").alias("warc_type"), F.col("u").alias("uri"), F.col("b").alias("block"))
    AF.write_records(recs, path)
    return path


_BLOCK_SQL = """
WITH r AS (SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN url END AS uri,
  encode('HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: ' ||
    CASE WHEN page_id % 7 = 0 THEN 'image/png' ELSE 'text/html; charset=windows-1252' END || chr(13) || chr(10) || chr(13) || chr(10) || html
  || CASE WHEN page_id % 13 = 0 THEN 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: conversion' || chr(13) || chr(10)
    || 'Content-Length: 3' || chr(13) || chr(10) || chr(13) || chr(10) || 'abc' || chr(13) || chr(10) || chr(13) || chr(10) ELSE '' END)
  || CASE WHEN page_id % 11 = 0 THEN unhex('E9') ELSE ''::BLOB END AS block, html FROM pages)"""


@register("archive_records", _BLOCK_SQL + """
SELECT 'response' AS warc_type, uri, CAST(octet_length(block) AS BIGINT) AS content_length, sha256(block) AS block_sha256 FROM r""")
def q_archive_records(spark, sf):
    """S1 through ``format("warc")``: pages written as records, read back byte for byte, the type filter in the scan."""
    recs = AF.read_archive(spark, _archive_of_pages(spark, sf)).where("warc_type = 'response'")
    return recs.select("warc_type", "uri", "content_length", F.sha2("block", 256).alias("block_sha256"))


_SAMPLED_PAGES = "SELECT url, html FROM pages ORDER BY " + _seeded_sql("url", 11) + ", url LIMIT (SELECT count(*) // 10 FROM pages)"


@register("sampled_archive_masks", f"""
WITH s AS (SELECT url, {S.strip_tags('html')} AS text FROM ({_SAMPLED_PAGES})),
""" + _pii_sql("s", "url").replace("WITH a AS", "a AS", 1) + " SELECT url AS uri, masked, n_email, n_phone, n_ip FROM c")
def q_sampled_archive_masks(spark, sf):
    """One in ten records of an archive drawn from its index, only those members read, text extracted, personal data masked."""
    path = scratch_path(spark, "sampled-archive")
    pages = table(spark, sf, "pages").select(F.lit("response").alias("warc_type"), F.col("url").alias("uri"), F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"), "html").cast("binary").alias("block"))
    AF.write_records(pages, path)
    index = materialize(AF.index_records(spark, path), "record-index")
    chosen = SM.sample_n(index, index.count() // 10, "uri", seed=11)
    texts = AF.read_at(chosen).select("uri", H.strip_tags(AF.payload_text()).alias("text"))
    return PII.mask_pii(texts).select("uri", "masked", "n_email", "n_phone", "n_ip")


@register("scan_path_manifest", """
SELECT url AS wet_path, row_number() OVER (ORDER BY page_id) AS line_no FROM pages""")
def q_scan_path_manifest(spark, sf):
    """Page URLs written as a headerless gzip manifest in page order, in as many parts as the sort has partitions, read
    back with line numbers through all parts."""
    path = scratch_path(spark, "manifest")
    (table(spark, sf, "pages").orderBy("page_id").select("url")
     .write.option("compression", "gzip").text(path))
    return FS.manifest_lines(spark, path).select("wet_path", "line_no")


#: Bytes that a file of the text corpus holds at most, about (and at least 16^2 files).
_FILE_BYTES = 1 << 20


@register("scan_text_corpus", f"""
WITH k AS (SELECT greatest(2, CAST(ceil(ln(greatest(sum(strlen(text)), 1) / {_FILE_BYTES}) / ln(16)) AS INTEGER)) AS digits FROM documents)
SELECT substr(md5(CAST(doc_id AS VARCHAR)), 1, digits) AS part, string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS text
FROM documents, k GROUP BY 1""")
def q_scan_text_corpus(spark, sf):
    """S3: documents written as text files by the executors, scanned back a row per file, decoded strictly. The number of
    files follows the bytes of text, so a row stays small."""
    path = scratch_path(spark, "text-corpus")
    docs = table(spark, sf, "documents")
    total, digits = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, 2
    while total > _FILE_BYTES * 16 ** digits:
        digits += 1
    part = F.substring(F.md5(F.col("doc_id").cast("string")), 1, digits)
    (docs.select(part.alias("part"), "doc_id", "text").repartition("part")
     .sortWithinPartitions("part", "doc_id").select("part", "text").write.partitionBy("part").text(path))
    return FS.scan_text_corpus(spark, path + "/*", strict=True).select(
        F.regexp_extract("path", r"part=([^/]+)/", 1).alias("part"), "text")


@register("document_store", _LINES_SQL + """
, freq AS (SELECT md5(line) AS h, count(*) AS c FROM lines GROUP BY 1)
, keep AS (SELECT l.doc_id, l.pos, l.line FROM lines l JOIN freq f ON md5(l.line) = f.h WHERE f.c = 1)
SELECT d.doc_id, md5(d.text) AS text_md5, coalesce(string_agg(k.line, '' ORDER BY k.pos), '') AS deduplicated
FROM documents d LEFT JOIN keep k ON d.doc_id = k.doc_id GROUP BY d.doc_id, d.text""")
def q_document_store(spark, sf):
    """S7 as a bucketed table, read back; line dedup over it, with texts met by id where they lie."""
    name = "documents_" + scratch_path(spark, "store").rsplit("-", 1)[1]
    store = FS.write_document_store(table(spark, sf, "documents").select("doc_id", "text"), name)
    clean = DL.dedup_lines(store).withColumnRenamed("text", "deduplicated")
    out = materialize(store.select("doc_id", F.md5("text").alias("text_md5")).join(clean, "doc_id"), "store-out")
    spark.sql(f"DROP TABLE {name}")
    return out


@register("write_documents", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS text FROM documents")
def q_write_documents(spark, sf):
    """Surviving documents written with emptied ones as '', read back."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = scratch_path(spark, "documents")
    FS.write_documents(docs.where("doc_id % 3 <> 0"), path, every=docs)
    return spark.read.parquet(path)


@register("scan_dump_lines")
def q_scan_dump_lines(spark, sf):
    """S5 + P11: reference lines written as bz2 text, read back, URLs extracted."""
    path = scratch_path(spark, "dump-bz2")
    reference_lines(table(spark, sf, "pages")).select("line").write.option(
        "compression", "bzip2").text(path)
    return U.extract_reference_urls(FS.scan_dump_lines(spark, path), keep=["file"]).select("url")


@register("incremental_language_filter", _language_sql(_WET_SQL) + """
SELECT x.id AS uri, text FROM x JOIN judged USING (id) WHERE lang = 'en' AND score >= 0.7""")
def q_incremental_language_filter(spark, sf):
    """New WET chunks, English conversion records (language model) appended
    to parquet; the checkpoint makes reruns process only new files."""
    src = _wet_of_pages(spark, sf, partition_by="chunk")
    out, ck = scratch_path(spark, "r1-out"), scratch_path(spark, "r1-ckpt")
    W_stream.incremental_language_filter(spark, src + "/*", out, ck, LG.English(_language_model(spark, sf)))
    return spark.read.parquet(out).select("uri", "text")


@register("incremental_kept_ratio", _KEPT_SHARE_SQL + ", 0 AS batch_id FROM w GROUP BY chunk")
def q_incremental_kept_ratio(spark, sf):
    """R2: kept share per micro-batch and chunk, written idempotently per batch."""
    src = _wet_of_pages(spark, sf, partition_by="chunk")
    out, ck = scratch_path(spark, "r2-out"), scratch_path(spark, "r2-ckpt")
    W_stream.incremental_kept_ratio(spark, src + "/*", out, ck, LG.English(_language_model(spark, sf)))
    return spark.read.parquet(out)


# =============================================================== 2.10 classifiers (Spark ML)
def _labelled(spark, sf):
    """All documents with their labels where they have some; a fifth of the labelled ones held out."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return SM.train_test_split(docs.join(table(spark, sf, "labels"), "doc_id", "left"), "doc_id")


def _toxic(spark, sf):
    d = _labelled(spark, sf)
    model = C.train_binary_text(d.where("split = 'train'"), "toxic")
    return C.classify_binary(model, d, C.TOXIC_LABELS, keep=["doc_id", "split", "toxic"])


@register("classify_toxic")
def q_classify_toxic(spark, sf):
    """M3: toxic / non-toxic with probability for every document, trained on labels.toxic (80 %)."""
    return _toxic(spark, sf)


@register("classify_nsfw")
def q_classify_nsfw(spark, sf):
    """M2: nsfw / non-nsfw; no NSFW labels exist, so M3's decisions under the NSFW label names."""
    return C.relabel(_toxic(spark, sf), dict(zip(C.TOXIC_LABELS, C.NSFW_LABELS, strict=True))).drop("toxic")


def _quality(spark, sf):
    d = _labelled(spark, sf).withColumnRenamed("quality", "label")
    model = C.train_quality_classifier(d.where("split = 'train'"), balanced=True)
    return C.classify_quality(model, d, keep=["doc_id", "split", F.col("label").alias("y")])


@register("classify_quality")
def q_classify_quality(spark, sf):
    """M4 + M5: the look of the text and TF-IDF + logistic regression on labels.quality; wiki / cc with
    probability for every document."""
    return _quality(spark, sf)


@register("evaluate_quality_classifier")
def q_evaluate_quality_classifier(spark, sf):
    """M6 (+A8): report on the 20 % held out."""
    pred = _quality(spark, sf).where("split = 'test' AND y IS NOT NULL")
    return M.classification_report(pred, label="y", prediction="prediction")


# =============================================================== 2.11 tokens
from ..operators import tokens as K  # noqa: E402


@register("tokenize_corpus")
def q_tokenize_corpus(spark, sf):
    """K1: byte-level BPE ids per document (end-of-text appended)."""
    return K.tokenize_corpus(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "tokens")


_WORD_IDS_SQL = f"""
WITH w AS (SELECT doc_id, ws, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents)
), v AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS id FROM w GROUP BY word
), t AS (
  SELECT doc_id, pos, CAST(CASE WHEN id < {K.OTHER_WORD} THEN id ELSE {K.OTHER_WORD} END AS INTEGER) AS tok FROM w JOIN v USING (word)
  UNION ALL SELECT doc_id, 1000000000, {K.END_OF_TEXT} FROM documents
), f AS (SELECT tok, row_number() OVER (ORDER BY doc_id, pos) - 1 AS p FROM t)"""
_PACKED_SQL = _WORD_IDS_SQL + f"""
, x AS (SELECT CAST(p // {K.CONTEXT_LENGTH} AS BIGINT) AS "window", list(tok ORDER BY p) AS x, max(p) AS last FROM f
        GROUP BY 1 HAVING count(*) = {K.CONTEXT_LENGTH})"""


def _word_ids(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return materialize(K.word_token_ids(docs, K.word_vocabulary(docs)), "word-ids")


@register("word_token_ids", _WORD_IDS_SQL + """
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens, list(tok ORDER BY pos) AS tokens FROM t GROUP BY doc_id""")
def q_word_token_ids(spark, sf):
    """K1 over words: ids by corpus frequency, end-of-text appended."""
    return _word_ids(spark, sf).select("doc_id", "n_tokens", "tokens")


@register("pack_windows", _PACKED_SQL + """
SELECT "window", x, list_append(x[2:], f.tok) AS y FROM x JOIN f ON f.p = x.last + 1""")
def q_pack_windows(spark, sf):
    """K2: the concatenated token stream cut into (x, y) windows of 512."""
    return K.pack_windows(_word_ids(spark, sf))


@register("write_token_windows", _PACKED_SQL + """
SELECT "window", x AS tokens FROM x JOIN f ON f.p = x.last + 1""")
def q_write_token_windows(spark, sf):
    """Complete windows written for the trainer and read back."""
    path = scratch_path(spark, "token-windows")
    K.write_token_windows(_word_ids(spark, sf), path)
    return spark.read.parquet(path)


@register("sample_windows", _WORD_IDS_SQL + f"""
, s AS (SELECT i, CAST(floor(CAST(('0x' || substr({_seeded_sql('i', 0)}, 1, 12))::UBIGINT AS DOUBLE) / 281474976710656.0
                             * ((SELECT count(*) FROM f) - {K.CONTEXT_LENGTH})) AS BIGINT) AS s
        FROM generate_series(0, 127) AS g(i))
SELECT i, s, list(tok ORDER BY p) FILTER (p < s + {K.CONTEXT_LENGTH}) AS x, list(tok ORDER BY p) FILTER (p > s) AS y
FROM s JOIN f ON p BETWEEN s AND s + {K.CONTEXT_LENGTH} GROUP BY i, s""")
def q_sample_windows(spark, sf):
    """K3: 128 seeded random (x, y) windows."""
    return K.sample_windows(_word_ids(spark, sf), 128, seed=0)


@register("token_budget", _WORD_IDS_SQL + """
SELECT CAST(524288 AS BIGINT) AS tokens_per_step, CAST(8589934592 AS BIGINT) AS tokens_needed,
       CAST(count(*) AS BIGINT) AS available_tokens, 8589934592.0::DOUBLE / count(*) AS epochs_needed FROM t""")
def q_token_budget(spark, sf):
    """K4: the default run's token budget against the corpus."""
    return K.token_budget(_word_ids(spark, sf))


@register("global_rank_documents", f"""
SELECT doc_id, source, row_number() OVER (ORDER BY {_seeded_sql('doc_id', 11)}, doc_id) AS rank FROM documents""")
def q_global_rank_documents(spark, sf):
    """W3's ranking over all documents in a seeded order."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return SM.global_rank(docs, [SM.seeded_key("doc_id", 11), F.col("doc_id")])


@register("write_url_list")
def q_write_url_list(spark, sf):
    """Extracted URLs written as one gzip list in (shard, line, position) order by the executors, read back
    with the count that the tasks reported."""
    lines = reference_lines(table(spark, sf, "pages"))
    path = scratch_path(spark, "url-list")
    shards = lines.groupBy("shard").agg(F.count(F.lit(1)).alias("lines"))
    n, _ = UL.refresh_url_list(spark, shards, lambda: U.extract_reference_urls(lines, keep=["shard", "line_no"]), path)
    return UL.read_url_list(spark, path).withColumn("n_written", F.lit(n).cast("bigint"))


@register("running_kept_ratio", _KEPT_SHARE_SQL + ", TRUE AS complete FROM w GROUP BY chunk")
def q_running_kept_ratio(spark, sf):
    """R2 over batches: kept share per chunk as keyed state of a stream, and whether all files of the chunk have come."""
    src = scratch_path(spark, "r2-wet")
    W.text_to_wet(_wet_texts(spark, sf).coalesce(32), src, partition_by="chunk")
    names = spark.read.format("binaryFile").load(src + "/*").select(W_stream.chunk_of_file(F.col("path")).alias("chunk"))
    manifest = materialize(names.groupBy("chunk").agg(F.count(F.lit(1)).alias("n_files")), "manifest")
    shares, out, one, two = (scratch_path(spark, f"r2-{x}") for x in ("shares", "totals", "ck1", "ck2"))
    W_stream.incremental_file_shares(spark, src + "/*", shares, one, LG.English(_language_model(spark, sf)), max_files=200)
    W_stream.running_kept_ratio(spark, shares, manifest, out, two, max_files=8)
    return W_stream.latest_totals(spark, out).select("chunk", "total_chars", "skipped_chars", "kept_pct", "complete")


# =============================================================== flagship
from . import curate as CU  # noqa: E402

_LINE_DEDUP_SQL = ORACLES["dedup_lines"]


def _curate_sql(p: MH.MinHashParams) -> str:
    lines = _LINE_DEDUP_SQL.replace("FROM documents", "FROM masked")
    clusters = _minhash_sql(p).replace("FROM documents", "FROM filled")
    return f"""
WITH judged AS ({_GOPHER_STATS_SQL} SELECT doc_id, {_GOPHER_REASON_SQL} AS reason FROM r),
base AS (SELECT doc_id, text, CASE WHEN coalesce(lang = 'en', FALSE) THEN reason ELSE 'non_en' END AS outcome
         FROM documents JOIN judged USING (doc_id)),
passing AS (SELECT doc_id, text FROM base WHERE outcome IS NULL),
masked AS ({_pii_sql("passing", "doc_id")} SELECT doc_id, masked AS text FROM c),
clean AS ({lines}),
filled AS (SELECT * FROM clean WHERE text <> ''),
clus AS ({clusters} SELECT doc_id, component FROM clusters),
done AS (SELECT b.doc_id, coalesce(b.outcome, CASE WHEN c.text = '' THEN 'emptied' WHEN k.component <> k.doc_id
           THEN 'near_duplicate' ELSE 'kept' END) AS outcome, CASE WHEN k.component = k.doc_id THEN length(c.text) ELSE 0 END AS n
         FROM base b LEFT JOIN clean c USING (doc_id) LEFT JOIN clus k USING (doc_id))
SELECT outcome, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS kept_chars FROM done GROUP BY outcome"""


@register("curate_summary", _curate_sql(MH_PARAMS))
def q_curate_summary(spark, sf):
    """The flagship chain with md5 MinHash: documents and characters per outcome."""
    return CU.curate_summary(spark, sf, MH_PARAMS)


@register("curate_summary_fast")
def q_curate_summary_fast(spark, sf):
    """The flagship chain with fast MinHash."""
    return CU.curate_summary(spark, sf)


@register("dedup_minhash_fast")
def q_dedup_minhash_fast(spark, sf):
    """D2 with the fast hash family (tests hold its clusters to exact Jaccard)."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return MH.dedup_minhash(docs, CU.FLAGSHIP_PARAMS).select("doc_id", "source")


# ---- oracles for the round trips: what Spark wrote from `pages` must read back
ORACLES["scan_dump_lines"] = _REF_LINES_SQL + " SELECT url FROM x"
ORACLES["write_url_list"] = _REF_LINES_SQL + """
SELECT url, (SELECT CAST(count(*) AS BIGINT) FROM x) AS n_written FROM x"""

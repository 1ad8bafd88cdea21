"""The operators of this subpackage as queries over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression, counts, decontaminate, divergence, licenses, mixing, nearcopies, quality, sharding, token_files, topk, toxicity, warc
from ._shared import table
from .license_rules import WINDOW, read_rules


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.curriculum(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", F.col("positions")[0].alias("position"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    # floor() of what is not finite is a number, so those rows are told apart before
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    e = table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull() & finite).select("vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("double")).alias("v"))
    return topk.top_k(e, F.col("vec_id") % 20 == 0)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op13_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compress(table(spark, sf_dir, "embeddings")).withColumnRenamed("group_error", "label_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_near_duplicates, op3_decontamination, op4_mixing, op5_top_k, op6_warc, op7_toxicity, op8_quality, op9_token_counts, op10_token_files, op11_divergence, op12_licenses, op13_compression)
}

TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
RULES_SQL = ", ".join(f"({r.number}, '{r.label}', {r.rank}, {r.confidence}::DOUBLE, {r.base}, '{r.keyword}', '{r.pattern}')" for r in read_rules())


def _nearest_sql(book: str) -> str:
    """Every part with the nearest entry of a codebook, by distance, then index."""
    return f"SELECT x.row, x.p, any_value(x.s) AS s, min(list_sum([(x.s[i] - c.c[i]) * (x.s[i] - c.c[i]) FOR i IN range(1, len(x.s) + 1)]) * 64 + c.k) AS best FROM x JOIN {book} c USING (p) GROUP BY x.row, x.p"


def _means_sql(found: str, book: str) -> str:
    """A codebook with every entry that has parts replaced by their floored mean."""
    return f"""SELECT b.p, b.k, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (SELECT p, k, list(((total - (((total % n) + n) % n)) // n)::BIGINT ORDER BY i) AS c FROM (
SELECT p, best % 64 AS k, i, sum(s[i]) AS total, count(*) AS n FROM (SELECT p, best, s, unnest(range(1, len(s) + 1)) AS i FROM {found}) GROUP BY ALL) GROUP BY p, k) m ON b.p = m.p AND b.k = m.k"""


WORDS_SQL = r"[w FOR w IN string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> '']"

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": f"""
WITH d AS (SELECT doc_id, coalesce({WORDS_SQL}, []) AS ws FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(ws, s + 1, s + 13) AS w FROM (SELECT item_id, ws, unnest(range(greatest(len(ws) - 12, 1))) AS s FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT len(w) AS n FROM win),
pos AS (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS s FROM d, lens WHERE len(ws) >= n),
hit AS (SELECT pos.doc_id, pos.s, pos.n, win.item_id FROM pos JOIN win ON list_slice(pos.ws, pos.s + 1, pos.s + pos.n) = win.w),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_top_k": """
WITH e AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS top,
array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1) FOR i IN range(32)], '') AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
CASE WHEN page_id <> top THEN top END AS refers_to FROM d""",
    "op11_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS MATERIALIZED (SELECT row, lang, source, unnest({TERMS_SQL}) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
x AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS MATERIALIZED (SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER w + 2 * count(*) OVER w)::HUGEINT AS p FROM x WINDOW w AS (PARTITION BY lang, source)),
l AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER w + 2 * count(*) OVER w)::HUGEINT AS q FROM (SELECT lang, term, sum(n) AS n FROM s GROUP BY ALL) WINDOW w AS (PARTITION BY lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM s JOIN l USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
UNION ALL SELECT lang, source, 'term', item, value FROM term),
k AS (SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT * FROM k WHERE part = 'pair' OR rank <= 10""",
    "op12_licenses": f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce({WORDS_SQL}, []) AS ws FROM documents),
rules(number, label, rank, confidence, base, keyword, pattern) AS (VALUES {RULES_SQL}),
a AS MATERIALIZED (SELECT row, i, ws[i + 1] AS w, array_to_string(list_slice(ws, i + 1, i + {WINDOW}), ' ') || ' ' AS after FROM (SELECT row, ws, unnest(range(len(ws))) AS i FROM d) WHERE ws[i + 1] IN (SELECT keyword FROM rules)),
m AS (SELECT row, i AS start, number, label, rank, confidence, base, regexp_extract(after, pattern, 0) AS t FROM a JOIN rules ON w = keyword),
f AS MATERIALIZED (SELECT *, len(t) - len(replace(t, ' ', '')) AS size FROM m WHERE t <> ''),
k AS (SELECT * FROM f WHERE base OR NOT EXISTS (SELECT 1 FROM f e WHERE e.row = f.row AND e.start <= f.start AND e.start + e.size >= f.start + f.size AND (e.rank < f.rank OR (e.rank = f.rank AND (e.size > f.size OR (e.size = f.size AND e.number < f.number)))))),
g AS (SELECT row, count(*) FILTER (base) AS n, min(start) FILTER (base) AS a, max(start) FILTER (base) AS z, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS bl, string_agg(DISTINCT label, ',' ORDER BY label) AS al, max(confidence) AS score FROM k GROUP BY row)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word, coalesce(bl, '') AS base_labels, coalesce(al, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score FROM d LEFT JOIN g USING (row)""",
    "op13_compression": f"""
WITH e AS (SELECT row_number() OVER () AS row, vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (SELECT row, vec_id, label, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS s FROM (SELECT *, unnest(range(16)) AS p FROM e)),
c0 AS MATERIALIZED (SELECT p, k, s AS c FROM (SELECT p, s, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k FROM x) WHERE k < 64),
a0 AS MATERIALIZED ({_nearest_sql("c0")}), c1 AS MATERIALIZED ({_means_sql("a0", "c0")}),
a1 AS MATERIALIZED ({_nearest_sql("c1")}), c2 AS MATERIALIZED ({_means_sql("a1", "c1")}),
a2 AS MATERIALIZED ({_nearest_sql("c2")}),
coded AS (SELECT row, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e JOIN coded USING (row), h""",
}

"""The queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import bpe, exact_dedup, hard_negatives, html_text, importance, order_minhash, packing, quality, simhash, substring_dedup, token_counts, toxicity, url_rules
from tidegate.llm.common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


@query()
def op1_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op6_toxicity(spark, sf_dir):
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_bpe(spark, sf_dir):
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


#: The listed rules of the URL query: host, path, verdict.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _rules_sql() -> tuple[str, str]:
    order = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in order]
    rule = " ".join(f"{w} THEN '{h}{p}'" for w, (h, p, _) in zip(fits, order, strict=True))
    verdict = " ".join(f"{w} THEN '{v}'" for w, (_, _, v) in zip(fits, order, strict=True))
    return f"CASE {rule} END", f"CASE {verdict} ELSE 'allow' END"


@query(
    f"""
    WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (
        SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut)
    SELECT page_id, host, path, {_rules_sql()[0]} AS rule, {_rules_sql()[1]} AS verdict FROM parts
    """
)
def op2_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


@query(
    """
    WITH plain AS (
        SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
        FROM documents),
    ranked AS (
        SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
            first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id
        FROM plain)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
    """
)
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.marked(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op8_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op4_order_minhash(spark, sf_dir):
    return order_minhash.with_neighbours(table(spark, sf_dir, "documents"))


@query()
def op7_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def _features_sql(words: str) -> str:
    return f"list_concat({words}, list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


def _hex_digit_sql(text: str, at: str) -> str:
    return f"(instr('0123456789ABCDEF', upper(substr({text}, {at}, 1))) - 1)"


@query(
    f"""
    WITH bytewise AS (
        SELECT list(list_reduce(list_prepend(b, range(0, 8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
        FROM range(256) AS r(b)),
    words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    wanted AS (
        SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    source_features AS (SELECT doc_id, unnest({_features_sql('w')}) AS f FROM words),
    target_features AS (SELECT unnest({_features_sql('w')}) AS f FROM wanted),
    each AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM source_features UNION SELECT f FROM target_features)),
    coded AS (
        SELECT f, list_transform(range(0, len(h) // 2), lambda i: {_hex_digit_sql('h', '2 * i + 1')} * 16 + {_hex_digit_sql('h', '2 * i + 2')}) AS bytes FROM each),
    placed AS (
        SELECT f, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM coded, bytewise),
    s AS (SELECT bucket, count(*) AS s FROM source_features JOIN placed USING (f) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM target_features JOIN placed USING (f) GROUP BY bucket),
    sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS big_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS big_t),
    gains AS (
        SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (big_s + 10000) / ((s + 1)::DOUBLE * (big_t + 10000))))::BIGINT AS gain
        FROM s LEFT JOIN t USING (bucket), sums),
    weights AS (
        SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
        FROM source_features JOIN placed USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
    hashed AS (
        SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
            list_reduce(list_transform(range(0, 9), lambda i: CASE WHEN i = 0 THEN 0 ELSE {_hex_digit_sql("sha256('7:' || doc_id)", 'i')} END), lambda a, x: a * 16 + x) AS h
        FROM words LEFT JOIN weights USING (doc_id)),
    scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM hashed),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS k
        FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_words, n_features, weight, score, CASE WHEN place <= k THEN place END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)
    """
)
def op11_importance(spark, sf_dir):
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.withColumn("doc_id", drawn.doc_id.cast("long"))


@query(
    """
    WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS start, w FROM words WHERE len(w) >= 20),
    hashed AS (SELECT doc_id, start, sha256(array_to_string(w[start : start + 19], ' ')) AS h FROM windows),
    repeats AS (
        SELECT doc_id, start
        FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY h ORDER BY doc_id, start) AS place FROM hashed) WHERE place > 1),
    gone AS (SELECT DISTINCT doc_id, start + i AS place_at FROM repeats, range(0, 20) AS r(i)),
    places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place_at, unnest(w) AS word FROM words),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY place_at) AS kept, count(*) AS n_kept
        FROM places ANTI JOIN gone USING (doc_id, place_at) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
    """
)
def op12_substring_dedup(spark, sf_dir):
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


@query(
    """
    WITH rows AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
            list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
        FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND (a.vec_id <> b.vec_id OR a.label <> b.label)),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
    """
)
def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)

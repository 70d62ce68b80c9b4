"""Verdicts on URLs by a list of canonical URLs: blocked Bloom filter, then an exact hash join.

A rule is a host and a path start. Its canonical URL is host and path written together. A URL
can only fit rules whose canonical URL is one of its own keys: a suffix of its host cut at a
dot, with a start of its path that is as long as some rule's path. Every key is looked up in a
blocked Bloom filter of the listed URLs (16 or more bits a rule, 8 MB at most); only possible
hits go on to the join with the rules, which removes the false ones. URLs without a possible
hit pass straight through with the verdict for unlisted URLs.

Spark picks the kind of hash join by the size of the list; in a shuffled one a key that fits a
third of all URLs is split by adaptive execution. The hits of a URL meet again by a row number
that is unique per row, so no group is hot. The longest rule wins: host and path together,
then the longer host.

NULL URLs and those without ``://`` have an empty host and path and fit no rule. Host: after
the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``,
``#`` or the end. Repeated rows and NULL ids are judged like others; empty tables (of URLs or
rules) are fine, rules with NULL host, path or verdict are ignored, and of equal rules with different verdicts block counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import bloom
from tidegate.llm.common import ascii_lower

UNLISTED = "allow"


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return pages.withColumns({"host": ascii_lower(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)), "path": F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)})


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url: str = "url", unlisted: str = UNLISTED) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every row; ``rules`` has ``host, path, verdict``."""
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    listed = listed.withColumn("key", F.concat("host", "path"))
    # Two numbers about the list: how many rules, and the lengths that their paths have (bounded by the longest path).
    size, lengths = listed.agg(F.count(F.lit(1)), F.sort_array(F.collect_set(F.length("path")))).first()
    words = bloom.filter_words(size)
    held = bloom.dense(listed.select(*[c.alias(n) for n, c in bloom.place(F.xxhash64("key"), words).items()]), words)
    held = F.lit(bytearray(bloom.packed(held.first()["filter"])))

    urls = with_host_and_path(pages.select(F.col(id_col), F.col(url).alias("__url")), "__url").drop("__url")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>"), lambda n: F.struct(n.alias("n"), F.substring(F.col("path"), F.lit(1), n).alias("path"))), lambda s: F.length(s.path) == s.n)
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda s: F.struct(h.alias("host"), s.path.alias("path")))))

    def hit(pair):
        return bloom.packed_may_hold(held, **bloom.place(F.xxhash64(F.concat(pair.host, pair.path)), words))

    probed = urls.withColumn("hits", F.when(F.col("host") == "", F.array().cast("array<struct<host:string,path:string>>")).otherwise(F.filter(pairs, hit)))
    none = probed.where("size(hits) = 0").select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(unlisted).alias("verdict"))

    hits = probed.where("size(hits) > 0").withColumn("__row", F.monotonically_increasing_id()).select("__row", id_col, "host", "path", F.explode("hits").alias("hit"))
    exact = listed.select(F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("key").alias("__key"), F.col("verdict").alias("__verdict"))
    met = hits.join(exact, (F.col("hit.host") == F.col("__host")) & (F.col("hit.path") == F.col("__path")), "left")
    best = F.max(F.when(F.col("__key").isNotNull(), F.struct(F.length("__key").alias("n"), F.length("__host").alias("host"), F.col("__key").alias("rule"), F.col("__verdict").alias("verdict"))))
    found = met.groupBy("__row", id_col, "host", "path").agg(best.alias("best"))
    return none.unionByName(found.select(id_col, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(unlisted)).alias("verdict")))

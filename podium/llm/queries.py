"""The thin queries ``opN_<name>`` over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm import (decontaminate, exact_dedup, fingerprint, html_extract, near_dedup, packing, pii, quality, secret_scan, spelling,
                        toxicity, url_filter, vector_codes)
from podium.llm.shared import table

#: The contract's rules (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: A sample blocklist of sites, each with its subdomains: names of unwanted kinds under the reserved example domains.
URL_BLOCKLIST = [(f"{name}.example.{top}", "") for name in ("casino-win", "free-bets", "cheap-pills", "adult-x", "ads-track")
                 for top in ("com", "net", "org")]

#: The surrogates' key; a real run takes its own from a secret store.
PII_KEY = "podium"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=4)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), key=PII_KEY)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near",
                      F.array_join("near_items", ",").alias("near_items"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, URL_BLOCKLIST)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return out.withColumn("codebooks_sha256", F.lit(hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_html_extract": op3_html_extract,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_pii": op6_pii,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_url_filter": op9_url_filter,
    "op10_packing": op10_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_fingerprint": op12_fingerprint,
    "op13_vector_codes": op13_vector_codes,
}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP_SQL = f"""
WITH t AS (SELECT doc_id, {_LOW} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""

_WORDS = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Exact windows by joining all windows; proximity by counting, for every offset, which of an item's words stand within 2 of
#: their places (pairs without enough words in a stretch of offsets are left out before).
DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, w[s:s + least(13, len(w)) - 1] AS win
       FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS r(s) WHERE len(w) > 0),
dw AS (SELECT doc_id, s, n, w[s:s + n - 1] AS win FROM d, (SELECT DISTINCT n FROM iw) AS l, unnest(range(1, len(w) - n + 2)) AS r(s)),
m AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, s, n FROM m) AS x, unnest(range(s, s + n)) AS r(p) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) AS x GROUP BY doc_id),
t AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS p FROM d),
q AS (SELECT item_id, len(w) AS n, least(13, len(w)) AS k, CASE WHEN len(w) >= 13 THEN 12 ELSE len(w) END AS least_in_place,
             unnest(w) AS t, unnest(range(len(w))) AS i FROM b),
j AS MATERIALIZED (SELECT doc_id, item_id, n, k, least_in_place, i, p - i AS g FROM t JOIN q USING (t)),
e AS (SELECT DISTINCT doc_id, item_id FROM (
      SELECT doc_id, item_id, CAST(floor((g + o) / 64) AS BIGINT) AS stretch FROM j, (VALUES (0), (4)) AS v(o)
      GROUP BY doc_id, item_id, stretch HAVING count(DISTINCT i) >= any_value(least_in_place)) AS x),
a AS (SELECT DISTINCT doc_id, item_id, n, k, least_in_place, i, g + o AS base FROM j SEMI JOIN e USING (doc_id, item_id), unnest(range(-2, 3)) AS v(o)),
near AS (SELECT DISTINCT doc_id, item_id FROM (
      SELECT doc_id, item_id, base, s FROM a, unnest(range(greatest(0, i - k + 1), least(i, n - k) + 1)) AS v(s)
      GROUP BY doc_id, item_id, base, s HAVING count(*) >= any_value(least_in_place)) AS x ANTI JOIN m USING (doc_id, item_id)),
ni AS (SELECT doc_id, count(*) AS n_near, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS near_items
       FROM near GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0) AS n_near, coalesce(near_items, '') AS near_items
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id) LEFT JOIN ni USING (doc_id)
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_LISTED = ", ".join(f"'{h}'" for h, _ in URL_BLOCKLIST)

URL_FILTER_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
           FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM u),
rules(rhost, rpath, rverdict) AS (VALUES {_RULES}),
f AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS rverdict
      FROM s JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
l AS (SELECT DISTINCT page_id FROM s, unnest([{_LISTED}]) AS x(listed) WHERE host = listed OR ends_with(host, '.' || listed))
SELECT page_id, host, path, rule, coalesce(rverdict, CASE WHEN l.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM s LEFT JOIN f USING (page_id) LEFT JOIN l USING (page_id)
"""

_ROUND = """,
c{k} AS (SELECT vec_id, r, p, arg_min(e, (d, e)) AS e, min(d) AS d
         FROM (SELECT v.vec_id, v.r, v.p, b.e, sum((v.x - b.x) * (v.x - b.x)) AS d FROM v JOIN b{k} AS b USING (p, j) GROUP BY ALL) AS x GROUP BY ALL)"""
_UPDATE = """,
b{next} AS (SELECT p, e, j, coalesce(m, x) AS x FROM b{k} LEFT JOIN
       (SELECT p, e, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM c{k} JOIN v USING (r, p) GROUP BY ALL) AS y USING (p, e, j))"""

#: Six rounds of exact assignment and update, written out; sums stay far below 2^53, so the floor of the quotient is exact.
VECTOR_CODES_SQL = """
WITH k AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r FROM embeddings
           WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len(embedding) > 0),
v AS MATERIALIZED (SELECT vec_id, r, i // (len(embedding) // 8) AS p, i % (len(embedding) // 8) AS j,
             CAST(floor(4096 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x FROM k, unnest(range(len(embedding))) AS u(i)),
b0 AS (SELECT p, CAST(r - 1 AS INTEGER) AS e, j, x FROM v WHERE r <= 16)""" + "".join(
    _ROUND.format(k=k) + _UPDATE.format(k=k, next=k + 1) for k in range(6)) + _ROUND.format(k=6) + """,
s AS (SELECT vec_id, r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM c6 GROUP BY ALL),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM s JOIN k USING (r) GROUP BY label)
SELECT s.vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM b6) AS codebooks_sha256
FROM s JOIN k USING (r) JOIN l ON k.label IS NOT DISTINCT FROM l.label
"""

ORACLE: dict[str, str] = {
    "op4_exact_dedup": EXACT_DEDUP_SQL,
    "op8_decontaminate": DECONTAMINATE_SQL,
    "op9_url_filter": URL_FILTER_SQL,
    "op13_vector_codes": VECTOR_CODES_SQL,
}

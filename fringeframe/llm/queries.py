"""Registered queries of this subpackage, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom_lm import score_documents
from .bpe import bpe_round_trip, tokenizer_file
from .decontaminate import find_benchmark_passages
from .host_reputation import UrlRule, judge_hosts
from .pu_quality import score_quality
from .repetition import judge_repetition
from .shard_shuffle import shuffle_into_shards
from .simhash import simhash_groups
from .toxic_neighbours import score_toxicity
from .window_dedup import remove_repeated_windows

#: The production rules for urls.
URL_RULES = (UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/"))

#: DuckDB: the words of a text.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(folds: int, held: int):
    """(held out, may be learned from): by crc32 of doc_id as text."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    out = F.coalesce(rest == held, F.lit(False))
    return out, ~out


def op1_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_repetition(docs, carry=["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words")


OP1_SQL = rf"""
WITH w AS (SELECT doc_id, {WORDS_SQL} AS ws, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
win AS (
  SELECT k, doc_id, i, count(*) OVER (PARTITION BY k, doc_id, seq) AS n FROM (
    SELECT 3 AS k, doc_id, unnest(range(1, len(ws) - 1)) AS i, array_to_string(ws[i:i+2], ' ') AS seq FROM w
    UNION ALL SELECT 10, doc_id, unnest(range(1, len(ws) - 8)) AS i, array_to_string(ws[i:i+9], ' ') FROM w
    UNION ALL SELECT 61, doc_id, unnest(range(1, len(ws) - 59)) AS i, array_to_string(ws[i:i+60], ' ') FROM w)),
cov AS (
  SELECT k, doc_id, count(DISTINCT p) AS n FROM (
    SELECT k, doc_id, unnest(range(i, i + k)) AS p FROM win WHERE n > 1) GROUP BY 1, 2),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
b AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN ws]), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
    coalesce(c3.n, 0)::BIGINT AS n_repeat_words, coalesce(c10.n, 0)::BIGINT AS n_covered_words, c61.n IS NOT NULL AS long_repeat
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN cov c3 ON c3.k = 3 AND c3.doc_id = w.doc_id
  LEFT JOIN cov c10 ON c10.k = 10 AND c10.doc_id = w.doc_id LEFT JOIN cov c61 ON c61.k = 61 AND c61.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_covered_words <= 45 * n_words AND NOT long_repeat AS kept, n_covered_words
FROM b
"""


def op2_hypergeometric_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shuffle_into_shards(table(spark, sf_dir, "documents"), shards=8)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return placed.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return judge_hosts(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "host_good", "host_labelled")


def op7_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_round_trip(docs, tokenizer_file(spark), carry=["doc_id"], digests=True)


#: Prior strength of the hosts' beta-binomials, clamped to [1, 1000] as in judge_hosts.
_STRENGTH_SQL = """SELECT coalesce(CASE WHEN g < 2 OR m <= 0 OR m >= 1 THEN 1000 WHEN room <= 0 OR (s - m*(1-m)*(g-1)) / room <= 0 THEN 1000
  ELSE greatest(1, least(1000, room / (s - m*(1-m)*(g-1)) - 1)) END, 1000)::DOUBLE
  FROM (SELECT g, s, m, m*(1-m) * (nt - nn/nt - (g-1)) AS room FROM (
    SELECT count(*) AS g, sum(n)::DOUBLE AS nt, sum(n::DOUBLE*n) AS nn, sum(n*pow(good::DOUBLE/n - (SELECT m FROM whole), 2)) AS s, (SELECT m FROM whole) AS m
    FROM {0} WHERE n > 0))"""


def _strength_sql(groups: str) -> str:
    return _STRENGTH_SQL.format(groups)



OP4_SQL = rf"""
WITH p AS (SELECT page_id, coalesce(instr(url, '://') > 0, false) AS has, regexp_extract(url, '(?s)^.*?://([^?#]*)', 1) AS before FROM pages),
q AS (SELECT page_id, CASE WHEN has THEN translate(regexp_extract(before, '(?s)^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN has THEN regexp_extract(before, '(?s)^[^/]*(.*)$', 1) ELSE '' END AS path FROM p),
votes AS (SELECT doc_id AS page_id, sum(quality) AS good, count(quality) AS n FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
hosts0 AS (SELECT host, string_split(host, '.') AS l, coalesce(sum(good), 0)::BIGINT AS good, coalesce(sum(n), 0)::BIGINT AS n FROM q LEFT JOIN votes USING (page_id) GROUP BY 1),
hosts1 AS (SELECT *, CASE WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ('ac','co','com','edu','gov','net','org') THEN 2 ELSE 1 END AS k FROM hosts0),
hosts AS (SELECT host, good, n, array_to_string(l[-k:], '.') AS suffix, array_to_string(l[-(k+1):], '.') AS domain FROM hosts1),
domains AS (SELECT domain, suffix, sum(good)::BIGINT AS good, sum(n)::BIGINT AS n FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(good)::BIGINT AS good, sum(n)::BIGINT AS n FROM domains GROUP BY 1),
whole AS (SELECT (coalesce(sum(good), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2) AS m FROM suffixes),
k1(k) AS ({_strength_sql('suffixes')}),
k2(k) AS ({_strength_sql('domains')}),
k3(k) AS ({_strength_sql('hosts')}),
sr AS (SELECT suffix, (good + (SELECT k FROM k1) * (SELECT m FROM whole)) / (n + (SELECT k FROM k1)) AS r FROM suffixes),
dr AS (SELECT domain, (good + (SELECT k FROM k2) * sr.r) / (n + (SELECT k FROM k2)) AS r FROM domains JOIN sr USING (suffix)),
hr AS (SELECT host, good, n, (good + (SELECT k FROM k3) * dr.r) / (n + (SELECT k FROM k3)) AS r FROM hosts JOIN dr USING (domain)),
hu AS (SELECT *, r + 1.645 * sqrt(r * (1 - r) / (n + (SELECT k FROM k3) + 1)) AS upper FROM hr),
rules(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
urls AS (SELECT DISTINCT host, path FROM q),
fit AS (SELECT host, path, arg_max(verdict, length(rh || rp)) AS verdict, arg_max(rh || rp, length(rh || rp)) AS rule FROM urls, rules
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1, 2)
SELECT q.page_id, q.host, q.path, fit.rule, coalesce(fit.verdict, CASE WHEN hu.upper < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, hu.good AS host_good, hu.n AS host_labelled
FROM q LEFT JOIN hu USING (host) LEFT JOIN fit ON fit.host = q.host AND fit.path = q.path
"""

def op6_simhash_vantage_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), radius=2)


def op8_sketched_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_windows(docs, width=20, carry=["doc_id"], digests=True)


OP8_SQL = rf"""
WITH w AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, array_to_string(ws[i:i+19], ' ') AS seq FROM w),
again AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM again) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE [x FOR x, i IN ws IF NOT list_contains(ps, i)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""

def op9_log_frequency_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out, learn = learnable(5, 1)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return score_documents(docs, ~F.col("held_out"), carry=["doc_id", "held_out"])


def op10_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op3_neighbour_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out, learn = learnable(3, 1)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    scored = score_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), learn, carry=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", "predicted", F.col("neighbours.doc_id").alias("evidence"))


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out, learn = learnable(5, 0)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return score_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), learn, carry=["doc_id", "held_out"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_repetition": op1_suffix_repetition,
    "op2_hypergeometric_shuffle": op2_hypergeometric_shuffle,
    "op3_neighbour_toxicity": op3_neighbour_toxicity,
    "op4_host_reputation": op4_host_reputation,
    "op5_pu_quality": op5_pu_quality,
    "op6_simhash_vantage_tree": op6_simhash_vantage_tree,
    "op7_speculative_bpe": op7_speculative_bpe,
    "op8_sketched_window_dedup": op8_sketched_window_dedup,
    "op9_log_frequency_lm": op9_log_frequency_lm,
    "op10_qgram_decontamination": op10_qgram_decontamination,
}

ORACLE_SQL: dict[str, str] = {"op1_suffix_repetition": OP1_SQL, "op4_host_reputation": OP4_SQL, "op8_sketched_window_dedup": OP8_SQL}

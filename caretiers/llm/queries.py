"""One query per operator, over whole tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    importance,
    line_dedup,
    ngram_join,
    packing,
    page_text,
    periodic_runs,
    personal_data,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
    token_counts,
)
from .common import scratch, ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents")).drop("base_spans")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "word_no", "n_chars", F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret"
    )


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


@query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100).select(
        "doc_id", "n_shingles", "component_id"
    )


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.remove_later_lines(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_lines", "n_removed", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *quality_rules.BASE,
        "base_failed",
        "kept",
        "distance",
    )


def repeat_some(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten with a periodic tail, whose place and period its id decides; a
    document without an id stays as it is."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return periodic_runs.collapse(table(spark, sf_dir, "documents"), prepare=repeat_some).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(F.concat_ws("", F.transform(listed, lambda line: F.concat(line, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), scratch(spark, "slot-map"), shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


@query
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return importance.resample(documents, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


WORDS = r"[^\x20\x09-\x0D]+"

ORACLE["op5_substring_dedup"] = f"""
WITH numbered AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS body
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM numbered WHERE len(w) >= 35)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY body) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT r, i + k AS i FROM repeated, (SELECT unnest(range(0, 35)) AS k)
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM numbered
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS body
  FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM numbered LEFT JOIN kept USING (r)
"""

ORACLE["op8_ngram_jaccard"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 90 * (p.n + q.n - k)
), reached AS (
  SELECT doc_id AS a, doc_id AS c FROM sizes UNION SELECT l.b, r.c FROM reached r JOIN links l ON l.a = r.a
), least AS (SELECT a, min(c) AS c FROM reached GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = doc_id
"""

ORACLE["op9_line_dedup"] = f"""
WITH texts AS (
  SELECT DISTINCT doc_id, coalesce(doc_id, 9223372036854775807) AS o, md5(coalesce(text, '')) AS m, coalesce(text, '') AS text
  FROM documents
), numbered AS (SELECT row_number() OVER (ORDER BY o, m) AS d, * FROM texts
), pieces AS (
  SELECT d, k, line, len(regexp_extract_all(line, '{WORDS}')) AS n
  FROM (SELECT d, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM numbered)
), lines AS (
  SELECT d, list(line ORDER BY k) AS l, list(n ORDER BY k) AS c FROM pieces WHERE n > 0 GROUP BY d
), runs AS (
  SELECT d, i, j, array_to_string(l[i:j], chr(10)) AS body
  FROM (SELECT d, l, c, i, unnest(range(i, least(i + 10, len(l) + 1))) AS j
        FROM (SELECT d, l, c, unnest(range(1, len(l) + 1)) AS i FROM lines))
  WHERE list_sum(c[i:j]) >= 10
), later AS (
  SELECT d, i, j FROM (SELECT d, i, j, row_number() OVER (PARTITION BY body ORDER BY d, i) AS rn FROM runs) WHERE rn > 1
), gone AS (
  SELECT DISTINCT d, unnest(range(i, j + 1)) AS s FROM later
), placed AS (
  SELECT d, k, line, n, CASE WHEN n > 0 THEN sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY d ORDER BY k) END AS s FROM pieces
), cut AS (
  SELECT p.d, count(*) FILTER (n > 0) AS n_lines, count(g.s) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (g.s IS NULL), '') AS body
  FROM placed p LEFT JOIN gone g ON g.d = p.d AND g.s = p.s GROUP BY p.d
)
SELECT x.doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed,
       CASE WHEN n_removed > 0 THEN CAST(length(body) AS BIGINT) ELSE x.n_chars END AS n_chars,
       sha256(body) AS text_sha256
FROM documents x JOIN numbered y ON y.o = coalesce(x.doc_id, 9223372036854775807) AND y.m = md5(coalesce(x.text, '')) JOIN cut USING (d)
"""

# CRC-32 in SQL: what each byte adds by its distance from the end, and the CRCs of zero bytes.
CRC_TABLES = """
single AS MATERIALIZED (
  SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS v
  FROM (SELECT unnest(range(256)) AS b)
), added AS (
  SELECT 1 AS d, b, v FROM single
  UNION ALL SELECT d + 1, a.b, xor(a.v >> 8, s.v) FROM added a JOIN single s ON s.b = a.v & 255 WHERE d < (SELECT max(n) FROM lengths)
), zeros AS (
  SELECT 0::BIGINT AS n, 4294967295::BIGINT AS z
  UNION ALL SELECT n + 1, xor(z >> 8, v) FROM zeros JOIN single ON b = z & 255 WHERE n < (SELECT max(n) FROM lengths)
), crcs AS (
  SELECT s, xor(bit_xor(v), any_value(xor(z, 4294967295))) AS crc
  FROM (SELECT s, strlen(s) AS n, hex(encode(s)) AS x, unnest(range(1, strlen(s) + 1)) AS i FROM strings) t
  JOIN added ON d = n - i + 1 AND b = ('0x' || substr(x, CAST(2 * i - 1 AS BIGINT), 2))::INT JOIN zeros USING (n) GROUP BY s
)"""
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op11_periodic_runs"] = f"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents
), strings AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM texts WHERE doc_id IS NOT NULL
), lengths AS (SELECT max(strlen(s)) AS n FROM strings
), {CRC_TABLES}, placed AS MATERIALIZED (
  SELECT r, doc_id, w, len(w) AS n, crc % 10 = 0 AND len(w) > 0 AS tail, (crc // 10) % greatest(len(w), 1) AS a, crc // 10 AS g
  FROM texts LEFT JOIN crcs ON s = CAST(doc_id AS VARCHAR)
), words AS MATERIALIZED (
  SELECT r, n, i, w[CASE WHEN tail AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM placed)
), pairs AS MATERIALIZED (
  SELECT x.r, x.i, y.i - x.i AS d FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), enough AS (
  SELECT r, d FROM pairs GROUP BY r, d HAVING count(*) >= greatest(24 - d, 2 * d)
), islands AS (
  SELECT r, d, i, i - row_number() OVER (PARTITION BY r, d ORDER BY i) AS g FROM pairs JOIN enough USING (r, d)
), stretches AS (
  SELECT r, d, min(i) AS start, count(*) + d AS length FROM islands GROUP BY r, d, g HAVING count(*) + d >= greatest(24, 3 * d)
), runs AS MATERIALIZED (
  SELECT r, start, length, min(d) AS period FROM stretches GROUP BY r, start, length
), listed AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY r
), best AS (
  SELECT r, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) = 1
), gone AS (
  SELECT DISTINCT r, i FROM (SELECT r, unnest(range(start + period, start + length)) AS i FROM runs)
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS body FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""

ORACLE["op13_importance"] = rf"""
WITH RECURSIVE sides AS (
  SELECT true AS wanted, CAST(NULL AS BIGINT) AS doc_id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents
), texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, wanted, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM sides
), grams AS MATERIALIZED (
  SELECT r, wanted, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, unnest([1, 2, 3]) AS n FROM texts) WHERE len(w) >= n)
), strings AS MATERIALIZED (SELECT DISTINCT s FROM grams
), lengths AS (SELECT max(strlen(s)) AS n FROM strings
), {CRC_TABLES}, dealt AS MATERIALIZED (
  SELECT r, wanted, crc % 10000 AS b FROM grams JOIN crcs USING (s)
), counted AS (
  SELECT b, count(*) FILTER (NOT wanted) AS s, count(*) FILTER (wanted) AS t FROM dealt GROUP BY b
), whole AS (
  SELECT count(*) FILTER (NOT wanted) AS s_all, count(*) FILTER (wanted) AS t_all FROM dealt
), gains AS (
  SELECT b, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM counted, whole
), weights AS (
  SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM dealt JOIN gains USING (b) WHERE NOT wanted GROUP BY r
), scored AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (r) WHERE NOT wanted
), ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM scored WHERE n_words >= 20
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN k <= (SELECT 5 * count(*) // 100 FROM ranked) THEN CAST(k AS BIGINT) END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""

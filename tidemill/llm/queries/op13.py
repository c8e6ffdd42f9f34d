from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table
from tidemill.llm.periodic_runs import periodic_runs


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """Every tenth text by the checksum of its id goes on from some word with a stretch of its own."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string"))
    g, n = F.floor(h / 10), F.size(words).cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), (n - a).cast("int"))
    whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), tail)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(whole, " ")).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, every tenth with a planted one; digests of them and of what is left."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text")
    )
    found = periodic_runs(docs)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.reduce(
        "runs",
        none,
        lambda b, r: F.when(
            b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r
        ).otherwise(b),
    )
    lines = F.transform(
        "runs",
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# DuckDB has no crc32, so its table of 256 entries is made first. A run that is long enough has 16 words
# in common with itself a period further, so runs are islands of positions i with the same 16 words at
# i + period.
SQL = r"""
WITH RECURSIVE shifted(b, v, k) AS (
    SELECT b, b, 0 FROM range(256) t(b)
    UNION ALL
    SELECT b, xor(v >> 1, (v & 1) * 3988292384), k + 1 FROM shifted WHERE k < 8
), crc AS (
    SELECT list(v ORDER BY b) AS entries FROM shifted WHERE k = 8
), split AS (
    SELECT doc_id, row_number() OVER () AS row,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own,
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)) AS digits
    FROM documents
), hashed AS (
    SELECT doc_id, row, own, CAST(len(own) AS BIGINT) AS n,
           xor(list_reduce(list_prepend(4294967295::BIGINT, digits),
                           lambda c, d: xor(c >> 8, entries[(xor(c, d) & 255) + 1])), 4294967295::BIGINT) AS h
    FROM split, crc
), placed AS (
    SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM hashed
), sized AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed
), texts AS (
    SELECT doc_id, row, n,
           CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(n), lambda i: own[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                ELSE own END AS words
    FROM sized
), places AS (
    SELECT row, n, words, unnest(range(n)) AS i FROM texts
), grams AS (
    SELECT row, i, words[i + 1 : i + 16] AS gram FROM places WHERE i + 16 <= n
), pairs AS (
    SELECT x.row, x.i, y.i - x.i AS p FROM grams x JOIN grams y ON x.row = y.row AND x.gram = y.gram AND x.i < y.i
), islands AS (
    SELECT row, p, i, i - row_number() OVER (PARTITION BY row, p ORDER BY i) AS island FROM pairs
), stretches AS (
    SELECT row, p, min(i) AS s, max(i) + p + 16 AS e FROM islands GROUP BY row, p, island
), runs AS (
    SELECT row, s, e, min(p) AS p FROM stretches WHERE e - s >= greatest(24, 3 * p) GROUP BY row, s, e
), summed AS (
    SELECT row, count(*) AS n_runs,
           arg_min({'s': s, 'l': e - s, 'p': p}, {'x': -((e - s) / p), 's': s, 'p': p}) AS best,
           string_agg(s || ',' || (e - s) || ',' || p || chr(10), '' ORDER BY s, p) AS lines
    FROM runs GROUP BY row
), dropped AS (
    SELECT DISTINCT row, unnest(range(s + p, e)) AS i FROM runs
), kept AS (
    SELECT c.row, string_agg(c.words[c.i + 1], ' ' ORDER BY c.i) AS collapsed
    FROM places c LEFT JOIN dropped d ON d.row = c.row AND d.i = c.i
    WHERE d.i IS NULL GROUP BY c.row
)
SELECT t.doc_id, coalesce(r.n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
       1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts t LEFT JOIN summed r ON r.row = t.row LEFT JOIN kept k ON k.row = t.row
"""

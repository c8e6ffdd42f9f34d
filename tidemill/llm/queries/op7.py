from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace, table
from tidemill.llm.mixing import ITERATIONS, Tempered, mix, with_topic
from tidemill.llm.quality import n_words

# Rare sources, languages and topics gain weight, the less the finer the dimension.
TARGETS = {"source": Tempered(0.7), "lang": Tempered(0.8), "topic": Tempered(0.9)}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their sampling probability, and the sample. The SQL fixes the sweeps."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", "lang", n_words().alias("tokens"))
    work = Workspace(spark)
    docs = work.keep(with_topic(spark, docs, sf_dir), "documents")
    mixed = mix(docs, TARGETS, F.col("tokens"), work, iterations=ITERATIONS)
    return mixed.select("doc_id", F.round("probability", 6).alias("probability"), "sampled")


def _sql() -> str:
    parts = [
        r"""docs AS (
    SELECT d.doc_id,
           coalesce('=' || d.source, 'null') AS source,
           coalesce('=' || d.lang, 'null') AS lang,
           coalesce('=' || CAST(t.topic AS VARCHAR), 'null') AS topic,
           coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS tokens
    FROM documents d
    LEFT JOIN (SELECT vec_id, min(label) AS topic FROM embeddings GROUP BY vec_id) t
      ON t.vec_id = d.doc_id
)""",
        """cells AS MATERIALIZED (
    SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM docs GROUP BY ALL
)""",
    ]
    for d, target in TARGETS.items():
        parts.append(
            f"""share_{d} AS MATERIALIZED (
    SELECT label, share / sum(share) OVER () AS share FROM (
        SELECT {d} AS label,
               CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {target.exponent}) ELSE 0 END AS share
        FROM cells GROUP BY {d})
)"""
        )
        parts.append(
            f"factor_{d}_0 AS MATERIALIZED (SELECT label, 1.0::DOUBLE AS factor FROM share_{d})"
        )
    step = dict.fromkeys(TARGETS, 0)
    for _ in range(ITERATIONS):
        for d in TARGETS:
            others = [o for o in TARGETS if o != d]
            joins = " ".join(f"JOIN factor_{o}_{step[o]} f_{o} ON f_{o}.label = c.{o}" for o in others)
            weight = " * ".join(["c.tokens", *(f"f_{o}.factor" for o in others)])
            step[d] += 1
            parts.append(
                f"""factor_{d}_{step[d]} AS MATERIALIZED (
    SELECT s.label, CASE WHEN w.weight > 0 THEN
           s.share * (SELECT sum(tokens) FROM cells) / w.weight ELSE 1.0 END AS factor
    FROM share_{d} s JOIN (SELECT c.{d} AS label, sum({weight}) AS weight FROM cells c {joins}
                           GROUP BY c.{d}) w ON w.label = s.label
)"""
            )
    joins = " ".join(f"JOIN factor_{d}_{step[d]} f_{d} ON f_{d}.label = c.{d}" for d in TARGETS)
    ratio = " * ".join(f"f_{d}.factor" for d in TARGETS)
    parts.append(
        f"ratios AS MATERIALIZED (SELECT c.source, c.lang, c.topic, {ratio} AS ratio FROM cells c {joins})"
    )
    return f"""WITH {", ".join(parts)}
SELECT d.doc_id, round(r.ratio / (SELECT max(ratio) FROM ratios), 6) AS probability,
       CAST(('0x' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0
           < r.ratio / (SELECT max(ratio) FROM ratios) AS sampled
FROM docs d JOIN ratios r ON r.source = d.source AND r.lang = d.lang AND r.topic = d.topic
"""


SQL = _sql()

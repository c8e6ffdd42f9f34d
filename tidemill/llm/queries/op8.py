from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import Workspace, table
from tidemill.llm.url_filter import ALLOW, BLOCK, Rule, filter_urls

RULES = [
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL. The verdicts of the rules are the labels the trees are trained from."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, RULES, Workspace(spark)).select(
        "page_id", "host", "path", "rule", "verdict", "block_probability"
    )

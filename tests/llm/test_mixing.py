import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm.mixing import Tempered, mix

SCHEMA = "doc_id long, source string, lang string, tokens long, probability string, factor int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)


def corpus():
    random = np.random.default_rng(6)
    sources, langs = ["a", "b", "c", None], ["en", "de"]
    return [
        (n, sources[min(3, n % 7)], langs[n % 3 == 0], int(random.integers(1, 50)))
        for n in range(2000)
    ]


def weights(df, column):
    sums = df.groupBy(column).agg(F.sum(F.col("tokens") * F.col("probability")).alias("w")).collect()
    total = sum(r.w for r in sums)
    return {r[column]: r.w / total for r in sums}


def test_expected_tokens_meet_given_targets(spark, work):
    sources = spark.createDataFrame([("a", 4.0), ("b", 3.0), ("c", 2.0), (None, 1.0)], "value string, share double")
    langs = spark.createDataFrame([("en", 0.5), ("de", 0.5)], "value string, share double")
    mixed = mix(docs_of(spark, corpus()), {"source": sources, "lang": langs}, F.col("tokens"), work).cache()
    got = weights(mixed, "source")
    assert all(abs(got[k] - v) < 1e-3 for k, v in {"a": 0.4, "b": 0.3, "c": 0.2, None: 0.1}.items())
    assert abs(weights(mixed, "lang")["en"] - 0.5) < 1e-3
    row = mixed.agg(F.max("probability"), F.avg("probability"), F.avg(F.col("sampled").cast("int"))).first()
    assert abs(row[0] - 1) < 1e-9 and abs(row[1] - row[2]) < 0.04


def test_tempered_targets_lift_what_is_rare(spark, work):
    mixed = mix(docs_of(spark, corpus()), {"source": Tempered(0.0)}, F.col("tokens"), work)
    assert all(abs(w - 0.25) < 1e-6 for w in weights(mixed, "source").values())
    same = mix(docs_of(spark, corpus()), {"source": Tempered(1.0)}, F.col("tokens"), work)
    assert same.where("probability < 1 - 1e-9 OR NOT sampled").count() == 0


def test_odd_rows(spark, work):
    rows = [(1, "a", "en", 0), (None, None, None, 5), (2, "a", "en", 5), (2, "a", "en", 5), (3, "x", "en", 9)]
    given = spark.createDataFrame([("a", 1.0), (None, 1.0)], "value string, share double")
    found = mix(docs_of(spark, rows), {"source": given}, F.col("tokens"), work).collect()
    assert len(found) == 5
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].probability == 0 and not by_id[3].sampled
    assert len({r.sampled for r in found if r.doc_id == 2}) == 1
    assert by_id[1].probability == by_id[2].probability
    assert mix(docs_of(spark, []), {"source": given}, F.col("tokens"), work).collect() == []


def test_a_cell_without_tokens_lowers_no_probability(spark, work):
    targets = {"source": Tempered(0.5), "lang": Tempered(0.5)}
    rows = [*corpus(), (9001, "rare", "en", 1), (9002, "a", "zz", 1)]
    want = mix(docs_of(spark, rows), targets, F.col("tokens"), work).collect()
    want = {r.doc_id: r.probability for r in want}
    found = mix(docs_of(spark, [*rows, (9003, "rare", "zz", 0)]), targets, F.col("tokens"), work)
    found = {r.doc_id: r.probability for r in found.collect()}
    assert found.pop(9003) == 1 and found.keys() == want.keys()
    assert all(abs(found[k] - p) < 1e-9 for k, p in want.items())
    assert max(want.values()) == 1


def test_raking_goes_on_until_the_targets_are_met(spark, work):
    rows = [(0, "a", "en", 1000), (1, "a", "de", 1), (2, "b", "en", 1), (3, "b", "de", 1000)]
    shares = "value string, share double"
    sources = spark.createDataFrame([("a", 0.6), ("b", 0.4)], shares)
    langs = spark.createDataFrame([("en", 0.5), ("de", 0.5)], shares)
    targets = {"source": sources, "lang": langs}
    mixed = mix(docs_of(spark, rows), targets, F.col("tokens"), work).cache()
    assert abs(weights(mixed, "source")["a"] - 0.6) < 1e-4
    assert abs(weights(mixed, "lang")["en"] - 0.5) < 1e-4
    with pytest.warns(UserWarning, match="after 8 sweeps"):
        mix(docs_of(spark, rows), targets, F.col("tokens"), work, iterations=8)


def test_targets_that_contradict_each_other_end_with_a_warning(spark, work):
    rows = [(0, "a", "en", 10), (1, "b", "de", 10)]
    sources = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "value string, share double")
    targets = {"source": sources, "lang": Tempered(0.0)}
    with pytest.warns(UserWarning, match="a target is missed"):
        assert mix(docs_of(spark, rows), targets, F.col("tokens"), work).count() == 2

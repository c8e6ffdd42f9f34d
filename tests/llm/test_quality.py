import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemill.llm.quality import fit, judge, rules, with_votes

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, votes string, kept string"


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def judged(spark, work, texts):
    rows = [(n, t, "v", "k") for n, t in enumerate(texts)]
    return judge(with_votes(spark.createDataFrame(rows, SCHEMA)), work)


def test_measures_against_brute_force(spark, work):
    random.seed(4)
    texts = [None, "", " \n\t\x0b ", "a b c d e a b c d e a", "x " * 40, "x\n\n \nx\ny\n x", "é|#\x0bü"]
    texts += [" ".join(random.choices("ab", k=random.randint(0, 30))) for _ in range(150)]
    texts += ["\n".join(random.choices(["a b", "#", "", "c\td"], k=8)) for _ in range(50)]
    texts += ["w%d " % 7 * 20000]
    df, _ = judged(spark, work, texts)
    found = {r.doc_id: r for r in df.select("doc_id", "measures", "base_failed").collect()}
    for n, text in enumerate(texts):
        want = measures(text)
        assert tuple(found[n].measures)[:5] == want
        assert found[n].base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def prose(seed, words=80):
    random.seed(seed)
    out = ["".join(random.choices("abcdefghij", k=random.randint(3, 7))) for _ in range(words)]
    return " ".join(w + "." if i % 12 == 11 else w for i, w in enumerate(out))


def test_the_model_tells_junk_from_prose(spark, work):
    good = [prose(n) for n in range(80)]
    shouted = [" ".join(w + "&&&" for w in prose(n).split()) for n in range(200, 210)]
    tables = [" | ".join(prose(n).split()) for n in range(300, 310)]
    df, model = judged(spark, work, good + shouted + tables)
    kept = {r.doc_id for r in df.where("kept").collect()}
    assert kept == set(range(80))
    accuracy = model.accuracy()
    assert set(accuracy) == {r.name for r in rules()}
    assert all(0.5 < a <= 1 for a in accuracy.values())


def test_repeated_rows_are_judged_alike(spark, work):
    df, _ = judged(spark, work, [prose(1)] * 3 + [prose(2), None])
    rows = df.where("doc_id < 3").select("posterior", "kept").distinct().collect()
    assert len(rows) == 1


def test_empty_table(spark, work):
    df, model = judged(spark, work, [])
    assert df.collect() == [] and model.prior == 0.5
    assert df.columns[-5:] == ["measures", "votes", "base_failed", "posterior", "kept"]


def em(votes, tolerance):
    """The label model document by document; posterior of each, and the number of steps."""
    good, before, steps = [0.1 if -1 in v else 0.9 for v in votes], None, 0
    while True:
        steps += 1
        now = [(sum(good) + 1) / (len(votes) + 2)]
        chances = []
        for n in range(len(votes[0])):
            for weights in (good, [1 - g for g in good]):
                count = {v: 1 + sum(w for w, x in zip(weights, votes) if x[n] == v) for v in (1, -1)}
                chances.append({v: c / (count[1] + count[-1]) for v, c in count.items()})
                now += chances[-1].values()
        odds = [math.log(now[0] / (1 - now[0]))] * len(votes)
        for d, v in enumerate(votes):
            for n, x in enumerate(v):
                if x:
                    odds[d] += math.log(chances[2 * n][x] / chances[2 * n + 1][x])
        if before and max(abs(a - b) for a, b in zip(before, now)) <= tolerance:
            return [1 / (1 + math.exp(-o)) for o in odds], steps
        good, before = [1 / (1 + math.exp(-o)) for o in odds], now


def test_label_model_against_brute_force(spark, work):
    chance = random.Random(12)
    votes = []
    for _ in range(400):
        right = 1 if chance.random() < 0.7 else -1
        votes.append([0 if chance.random() < 0.3 else right * (1 if chance.random() < 0.85 else -1) for _ in range(4)])
    df = spark.createDataFrame([(v,) for v in votes], "votes array<int>")
    patterns = work.keep(df.groupBy("votes").agg(F.count(F.lit(1)).alias("documents")), "patterns")
    model = fit(patterns, list("abcd"))
    want, steps = em(votes, 1e-4)
    assert steps > 15
    found = {tuple(r.votes): r.p for r in patterns.select("votes", model.posterior(F.col("votes")).alias("p")).collect()}
    assert all(abs(found[tuple(v)] - w) < 1e-9 for v, w in zip(votes, want))


def test_a_model_that_still_moves_is_named(spark, work):
    df = spark.createDataFrame([([1, -1], 5), ([1, 1], 9), ([-1, -1], 4)], "votes array<int>, documents long")
    with pytest.warns(UserWarning, match="after 2 steps"):
        fit(work.keep(df, "patterns"), ["a", "b"], most_steps=2)


def test_labelled_documents(spark, work):
    """Past the base rule no document labelled good goes, and most of those labelled bad do."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    df, _ = judge(with_votes(docs).drop("text"), work)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    counted = df.where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count()
    found = {(r.quality, r.kept): r["count"] for r in counted.collect()}
    assert (1, False) not in found and found[0, False] > 0.9 * (found[0, False] + found.get((0, True), 0))


def test_the_estimation_runs_one_job_however_many_steps(spark, work):
    """A job for each step left the driver plans and generated code of each: pipeline, driver's memory."""
    rows = [([1, -1, 0], 50), ([1, 1, 1], 90), ([-1, -1, 1], 40), ([0, 1, -1], 30), ([1, -1, 0], 7)]
    patterns = work.keep(spark.createDataFrame(rows, "votes array<int>, documents long"), "patterns")
    context = spark.sparkContext
    context.setJobGroup("estimation", "estimation")
    try:
        fit(patterns, list("abc"))
        jobs = context.statusTracker().getJobIdsForGroup("estimation")
    finally:
        context.setJobGroup("other", "other")
    assert 1 <= len(jobs) <= 3

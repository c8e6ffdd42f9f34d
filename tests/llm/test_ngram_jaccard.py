import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace, importable
from tidemill.llm.components import connected
from tidemill.llm.ngram_jaccard import ngram_sets, similar_components

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, node string, n string"


def grams(text, n):
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent):
    sets = [(i, grams(t, n)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    groups = {}
    for a in range(len(rows)):
        groups.setdefault(root(a), []).append(rows[a][0])
    least = {r: min((i for i in m if i is not None), default=None) for r, m in groups.items()}
    return sorted(
        (((i, len(s), least[root(a)]) for a, (i, s) in enumerate(sets))), key=repr
    )


def found(spark, work, rows, n=3, percent=90):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = similar_components(docs, work, words=n, percent=percent)
    return sorted((tuple(r) for r in out.select("_id", "n_shingles", "component_id").collect()), key=repr)


def text(words=120):
    return ["".join(random.choices("abcdefgh", k=5)) for _ in range(words)]


def edited(words, changes):
    words = list(words)
    for place in random.sample(range(len(words)), changes):
        words[place] = "".join(random.choices("xyz", k=6))
    return words


def corpus(seed, copies):
    """Chains of edits, a crowded group around one text, exact copies, shared passages."""
    random.seed(seed)
    texts = [text(random.randint(3, 150)) for _ in range(60)]
    passage = text(60)
    texts += [t[:40] + passage + t[40:80] for t in texts[:50]]
    base = text(150)
    texts += [edited(base, random.randint(1, 6)) for _ in range(copies)] + [base] * 3
    chain = text(140)
    for _ in range(12):
        chain = edited(chain, 2)
        texts.append(chain)
    texts += [edited(t, 1) for t in texts[:20] if len(t) > 5]
    return [(n, " ".join(t)) for n, t in enumerate(texts)]


@pytest.mark.parametrize("seed, n, percent", [(1, 3, 90), (2, 5, 80), (3, 2, 75)])
def test_components_against_all_pairs(spark, work, seed, n, percent):
    rows = corpus(seed, 90)
    assert found(spark, work, rows, n, percent) == brute(rows, n, percent)


def test_odd_texts(spark, work):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "A\tB"), (8, "a b c")]
    rows += [(None, "x y z w"), (9, "x y z w"), (None, "only this one"), (9, "x y z w"), (None, None)]
    rows += [(n, "É a b") for n in (20, 21)] + [(22, "é a b"), (23, "w " * 50000)]
    assert found(spark, work, rows) == brute(rows, 3, 90)


def test_empty_table_and_low_similarity(spark, work):
    assert found(spark, work, []) == []
    with pytest.raises(ValueError):
        found(spark, work, [(1, "a")], percent=50)


def test_one_first_document_for_each_component(spark, work):
    rows = [(n, t) for n, t in corpus(4, 40)] + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = similar_components(docs, work)
    firsts = out.where("first").groupBy("component_id").count().collect()
    assert {r["count"] for r in firsts} == {1}
    assert len(firsts) == out.select("component_id").distinct().count()


def test_sets_differ_where_words_do():
    texts = ["ab c d", "a bc d", "a b c d", "d c b a", "ab c d "]
    sets = [tuple(s) for s in ngram_sets(pa.array(texts), 3)]
    assert sets[0] == sets[4] and len(set(sets)) == 4


def test_components_of_a_long_path(spark, work):
    nodes = spark.range(400).select(F.col("id").alias("node"), (F.col("id") + 7).alias("label"))
    links = nodes.where("node % 100 <> 99").select(
        F.col("node").alias("a"), (F.col("node") + 1).alias("b")
    )
    labels = connected(nodes, links, work).collect()
    assert {r.node: r.label for r in labels} == {n: n // 100 * 100 + 7 for n in range(400)}


def test_pieces_of_fewer_words_than_an_ngram(spark, work):
    texts = [" ".join("abcde"[:k]) for k in range(6)]
    for text in texts:
        (got,) = ngram_sets(pa.array([text]), 5)
        assert len(got) == len(grams(text, 5))
    rows = [(2 * k + copy, text) for k, text in enumerate(texts) for copy in range(2)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    out = similar_components(docs, work, words=5)
    got = [tuple(r) for r in out.select("_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=repr) == brute(rows, 5, 90)


class Recorded(Workspace):
    """Keeps the tables of a run, by name."""

    def __init__(self, spark):
        super().__init__(spark)
        self.tables = {}

    def keep(self, df, name):
        self.tables[name] = super().keep(df, name)
        return self.tables[name]

    def forget(self, name):
        pass


def test_sets_of_another_size_have_another_pivot(spark):
    random.seed(11)
    importable(spark)
    whole = text(200)
    texts = [whole] * 3 + [edited(whole, 1) for _ in range(40)]
    texts += [whole[:100]] * 2 + [edited(whole[:100], 1) for _ in range(40)]
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    work = Recorded(spark)
    assert found(spark, work, rows, 5, 80) == brute(rows, 5, 80)
    # The short texts lack the same half of the whole one; compared with that, all pairs of them met.
    assert work.tables["stars"].count() >= 80
    assert work.tables["differences"].where("NOT linked").count() == 0
    assert work.tables["overlaps"].count() == 0


def test_sets_with_much_alone_meet_in_few_places(spark):
    random.seed(12)
    importable(spark)
    whole = text(150)
    common = edited(whole, 6)
    # All far from the whole text in the same places, and from each other in places of their own.
    texts = [whole] * 3 + [edited(common, 5) for _ in range(60)]
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    work = Recorded(spark)
    assert found(spark, work, rows, 5, 80) == brute(rows, 5, 80)
    far = work.tables["differences"].where("NOT linked").count()
    assert far >= 50 and work.tables["overlaps"].count() <= 2 * far


@pytest.mark.parametrize("n, percent", [(5, 80), (3, 90)])
def test_crowds_of_all_sizes_against_all_pairs(spark, work, n, percent):
    random.seed(100 * n + percent)
    whole = text(120)
    variants = [edited(whole, k) for k in (2, 4, 6, 9)]
    texts = [whole] * 2
    for _ in range(240):
        base = random.choice([whole, *variants])
        length = random.choice([120, 118, 100, 90, 75, 60])
        texts.append(edited(base[:length], random.choice([0, 1, 1, 2, 3, 4])))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert found(spark, work, rows, n, percent) == brute(rows, n, percent)

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import phrase_index as module
from tidemill.llm.phrase_index import build_index, covered, directory, find_passages, pack, unpack

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def windows_of(words, window):
    size = min(window, len(words))
    return [words[i : i + size] for i in range(len(words) - size + 1)] if size else []


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        words, hit, held = words_of(text), set(), set()
        for item_id, item in items:
            for gram in windows_of(words_of(item), window):
                for i in range(len(words) - len(gram) + 1):
                    if words[i : i + len(gram)] == gram:
                        hit |= set(range(i, i + len(gram)))
                        held |= {item_id} - {None}
        out.append((str(doc_id), len(words), len(hit), sorted(map(str, held))))
    return sorted(out)


def texts(random, n, vocabulary, longest):
    signs = [" ", "  ", ". ", "-", "\n", "'"]
    out = []
    for _ in range(n):
        picked = random.choice(vocabulary, random.integers(0, longest))
        out.append("".join(w + signs[random.integers(0, 6)] for w in picked))
    return out


VOCABULARY = ["a", "B", "c9", "Élan", "été", "x", "Yy", "数"]


def search(spark, work, docs, items, **options):
    schema = "doc_id int, text string, term string, segment string"
    table = spark.createDataFrame([(*d, "clash", "clash") for d in docs], schema)
    wanted = spark.createDataFrame(items, "item_id string, text string")
    index = build_index(table.repartition(3), work)
    return index, find_passages(index, wanted, work, **options)


def rows_of(index, found):
    return sorted((str(r[0]), r[1], r[2], r[3]) for r in covered(index, found).collect())


@pytest.mark.parametrize("window", [3, 10])
def test_against_brute_force(spark, work, monkeypatch, window):
    monkeypatch.setattr(module, "SEGMENT_BYTES", 500)
    monkeypatch.setattr(module, "CHUNK", 7)
    random = np.random.default_rng(window)
    docs = list(enumerate(texts(random, 60, VOCABULARY[: window], 60)))
    for n in range(0, 20, 2):  # passages of documents in items
        docs[n] = (n, docs[n][1] + " it was the best of times it was the worst of times " * (1 + n % 3))
    docs += [(None, None), (None, "a b"), (3, ""), (3, docs[0][1]), (3, docs[0][1])]
    items = [(f"i{n}", t) for n, t in enumerate(texts(random, 12, VOCABULARY[: window], 14))]
    items += [("same", "It was the best of times. It was the worst of times!")] * 2
    items += [("again", items[-1][1]), (None, "the worst of times"), ("none", None), ("blank", " ?")]
    index, found = search(spark, work, docs, items, window=window)
    assert rows_of(index, found) == brute(docs, items, window)
    assert index.select("segment").distinct().count() > 3


def test_items_in_several_blocks(spark, work, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BYTES", 60)
    random = np.random.default_rng(1)
    docs = list(enumerate(texts(random, 30, VOCABULARY[:3], 40)))
    items = [(str(n), t) for n, t in enumerate(texts(random, 12, VOCABULARY[:3], 12))]
    assert rows_of(*search(spark, work, docs, items, window=4)) == brute(docs, items, 4)


def test_matches_name_their_place(spark, work):
    passage = " ".join(f"w{n}" for n in range(15))
    docs = [(1, f"one two {passage} three {passage}")]
    _, found = search(spark, work, docs, [("x", f"start {passage}")])
    places = found.select("doc_id", "item_id", "first", "last", "exact").collect()
    assert sorted(map(tuple, places)) == [(1, "x", 2, 16, True), (1, "x", 18, 32, True)]


def test_proximity_against_brute_force(spark, work):
    random = np.random.default_rng(4)
    vocabulary = [f"v{n}" for n in range(12)]
    docs = list(enumerate(texts(random, 50, vocabulary, 50)))
    items = [(str(n), " ".join(random.permutation(vocabulary)[:3])) for n in range(25)]
    index, found = search(spark, work, docs, items, slop=2)
    expected = set()
    for doc_id, text in docs:
        words = words_of(text)
        for item_id, item in items:
            gram = words_of(item)
            moved = [[i - o for i, w in enumerate(words) if w == g] for o, g in enumerate(gram)]
            for at in set(sum(moved, [])):
                near = [min((m for m in ms if m >= at), default=99) - at for ms in moved]
                if max(near) <= 2 and min(near) == 0:
                    expected.add((doc_id, item_id, max(near) == 0))
    got = {(r.doc_id, r.item_id, r.exact) for r in found.collect()}
    assert got == expected and {e for *_, e in got} == {True, False}
    plain = find_passages(index, spark.createDataFrame(items, "item_id string, text string"), work)
    assert {(r.doc_id, r.item_id, r.exact) for r in plain.collect()} == {g for g in got if g[2]}


def test_proximity_stays_in_a_document(spark, work):
    table = spark.createDataFrame([(1, "p q"), (2, "r s")], "doc_id int, text string").coalesce(1)
    index = build_index(table, work)
    wanted = spark.createDataFrame([("i", "q r")], "item_id string, text string")
    assert find_passages(index, wanted, work, slop=3).collect() == []


def test_empty_tables(spark, work):
    index, found = search(spark, work, [], [("i", "a b")])
    assert found.collect() == [] and covered(index, found).collect() == []
    index, found = search(spark, work, [(1, "a b")], [])
    assert rows_of(index, found) == [("1", 2, 0, [])]
    assert directory(index).select("doc_id", "n_words").collect() == [(1, 2)]


def test_positions_are_packed_and_read_back():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, (1 << 28) - 1, 1 << 28, 1 << 34])
    data, sizes = pack(numbers)
    assert sizes.tolist() == [1, 1, 1, 2, 2, 3, 4, 5, 5]
    assert unpack(data).tolist() == numbers.tolist()
    assert unpack(np.zeros(0, np.uint8)).tolist() == []


def test_a_text_longer_than_a_segment(spark, work, monkeypatch):
    monkeypatch.setattr(module, "SEGMENT_BYTES", 1000)
    passage = " ".join(f"p{n}" for n in range(12))
    long = " ".join(f"w{n % 900}" for n in range(5000))
    docs = [(1, "short"), (2, f"{long} {passage} {long}"), (3, passage)]
    index, found = search(spark, work, docs, [("i", passage)])
    assert [(r[0], r[2]) for r in rows_of(index, found)] == [("1", 0), ("2", 12), ("3", 12)]
    lists = index.where(F.col("term") == "w0").select("n").collect()
    assert sum(r.n for r in lists) == 12

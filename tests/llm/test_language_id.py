import random
import zlib

import numpy as np

from tidemill.llm.language_id import WINDOW, ByteCnn, cut_windows, identify, train
from tidemill.llm.queries import op10

SYLLABLES = {"aa": ["the", "ing", "ou", "er"], "bb": ["ción", "ña", "el", "os"], "cc": ["sch", "ü", "ung", "ei"]}
SCHEMA = "doc_id long, text string, lang string, score string"


def prose(lang, seed, words=60):
    random.seed(f"{lang}{seed}")
    return " ".join("".join(random.choices(SYLLABLES[lang], k=3)) for _ in range(words))


def labelled(spark, n=60):
    rows = [(i, prose(lang, i), lang, "x") for lang in SYLLABLES for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy_and_odd_texts(spark, work):
    network = train(labelled(spark), work)
    assert network.languages == ["aa", "bb", "cc"]
    rows = [(i, prose(lang, 1000 + i), lang, "x") for lang in SYLLABLES for i in range(30)]
    rows += [(900, None, None, "x"), (901, "", "aa", "x"), (902, "12 !? \n", "aa", "x")]
    rows += [(903, prose("bb", 5, 20000), "bb", "x")] * 2
    found = identify(spark.createDataFrame(rows, SCHEMA), network).collect()
    right = [r.lang == r.lang_pred for r in found if r.doc_id < 900 or r.doc_id == 903]
    assert len(right) == 92 and np.mean(right) > 0.97
    assert {(r.lang_pred, r.score) for r in found if 900 <= r.doc_id <= 902} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_to_learn_from(spark, work):
    docs = spark.createDataFrame([(1, "text", None, "x"), (2, None, "aa", "x")], SCHEMA)
    network = train(docs, work)
    assert network is None
    assert {r.lang_pred for r in identify(docs, network).collect()} == {"und"}
    assert identify(docs.limit(0), network).collect() == []


def test_windows_cover_every_byte():
    data = np.arange(2 * WINDOW + 10, dtype=np.int64).astype(np.uint8) + 1
    offsets = np.array([0, 0, 3, 3 + WINDOW, len(data)])
    windows, rows, sizes = cut_windows(data, offsets)
    assert rows.tolist() == [1, 2, 3, 3] and sizes.tolist() == [3, WINDOW, WINDOW, 7]
    joined = np.concatenate([w[:s] for w, s in zip(windows, sizes)])
    assert (joined == data).all()


def test_pair_tables_give_the_same_as_single_ones():
    network = ByteCnn(["x", "y"])
    windows = np.random.default_rng(3).integers(0, 256, (5, WINDOW)).astype(np.uint8)
    pooled, _ = network._pooled(windows)
    scores = np.maximum(pooled, 0) @ network.dense + network.bias
    want = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert np.allclose(network.predict(windows, network.pair_tables()), want, atol=1e-5)


def test_query_splits_by_checksum(spark, work, tmp_path):
    labelled(spark, 20).select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    for row in op10.query(spark, str(tmp_path)).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)


def test_languages_of_many_copies_are_learned(spark, work):
    langs = [f"l{n}" for n in range(8)]
    few = spark.createDataFrame([(i, prose("aa", i), lang, "x") for i, lang in enumerate(langs)], SCHEMA)
    assert train(few.crossJoin(spark.range(5000).select()), work).languages == langs

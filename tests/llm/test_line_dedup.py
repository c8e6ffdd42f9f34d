import random

import pytest

from tidemill.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string, n_lines string, pos int"


def brute(rows, min_words):
    """Every run of lines, however long, against every earlier one, in order of id."""
    rows = sorted(rows, key=lambda r: r[0])
    seen, gone = {}, set()
    split = [(i, t.split("\n")) for i, t in rows]
    longest = max((len(lines) for _, lines in split), default=0)
    for size in range(1, longest + 1):
        for d, (_, lines) in enumerate(split):
            for s in range(len(lines) - size + 1):
                run = tuple(lines[s : s + size])
                if sum(len(x.split()) for x in run) < min_words:
                    continue
                origin = seen.setdefault(run, (d, s))
                if origin[0] != d or s >= origin[1] + size:
                    gone |= {(d, s + k) for k in range(size)}
    return {
        i: "\n".join(x for k, x in enumerate(lines) if (d, k) not in gone)
        for d, (i, lines) in enumerate(split)
    }


def dedup(spark, work, rows, min_words):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return dedup_lines(docs, work, min_words=min_words).collect()


@pytest.mark.parametrize("seed", range(4))
def test_random_documents_against_all_runs(spark, work, seed):
    random.seed(seed)
    pool = ["a b", "c", "", "d e f", "g h i j", "k", "l m", "n o p q r s"]
    rows = [(n, "\n".join(random.choices(pool, k=random.randint(1, 14)))) for n in range(25)]
    rows += [(100 + n, rows[n][1]) for n in range(3)]
    found = dedup(spark, work, rows, 7)
    assert {r.doc_id: r.text for r in found} == brute(rows, 7)


def test_a_long_run_keeps_its_first_copy(spark, work):
    run = "\n".join(f"line {n}" for n in range(300))
    rows = [(1, "head\n" + run), (2, run + "\ntail"), (3, "line 5\nother")]
    found = {r.doc_id: r for r in dedup(spark, work, rows, 50)}
    assert found[1].text == rows[0][1] and found[1].n_deleted == 0
    assert found[2].text == "tail" and found[2].n_deleted == 300
    assert found[3].text == rows[2][1]


def test_a_line_repeated_over_and_over(spark, work):
    found = dedup(spark, work, [(1, "\n".join(["x y"] * 40))], 10)[0]
    assert found.text == "\n".join(["x y"] * 5)


def test_nulls_repeated_rows_and_clashing_names(spark, work):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "a b c"), (3, "a b c")]
    found = dedup(spark, work, rows, 2)
    assert [r.text for r in found if r.doc_id == 1] == [None]
    assert [r.text for r in found if r.doc_id == 2] == [""]
    assert [r.text for r in found if r.doc_id is None] == ["a b c"]
    assert [r.text for r in found if r.doc_id == 3] == ["", ""]
    assert found[0].asDict().keys() == {"doc_id", "text", "pos", "n_lines", "n_deleted"}


def test_empty_table(spark, work):
    assert dedup(spark, work, [], 50) == []

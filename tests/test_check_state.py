"""Checks that are kept up to date batch by batch, against the same checks over all rows."""

import random

import pytest

from tidemill.contracts import Checks
from tidemill.operators.quality import orphans, run_checks
from tidemill.plans.check_state import (
    check_report,
    keys_table,
    open_orphans,
    open_table,
    update_checks,
)
from tidemill.sources.snapshots import Store

CHECKS = {
    "lines": Checks(
        not_null=("id", "note"),
        unique=("id", "note"),
        relationships=(("item", "items", "id"), ("item", "others", "id"), ("note", "items", "name")),
    ),
    "items": Checks(not_null=("name",), unique=("id",)),
    "others": Checks(unique=("id",)),
}
SCHEMAS = {
    "lines": "id long, item int, note string",
    "items": "id long, name string",
    "others": "id long",
}


def values(report):
    rows = report.select("check_name", "relation", "column", "violations").collect()
    return sorted(tuple(r) for r in rows)


def frames(spark, rows):
    return {t: spark.createDataFrame(r, SCHEMAS[t]) for t, r in rows.items()}


@pytest.mark.parametrize("seed", [5])
def test_equals_the_checks_over_all_rows_after_every_batch(spark, tmp_path, seed):
    random.seed(seed)

    def some(*choices):
        return random.choice([None, *choices])

    store, everything = Store(spark, str(tmp_path)), {}
    for batch in range(3):
        news = {
            "lines": [
                (some(*range(60)), some(*range(-9, 9), 200), some(*"abcdef")) for _ in range(40)
            ],
            "items": [(some(*range(-9, 9)), some(*"abcd")) for _ in range(3)],
            "others": [(some(*range(-9, 9)),) for _ in range(6)],
        }
        if batch == 1:
            del news["lines"]  # parents alone
        for table, rows in news.items():
            everything.setdefault(table, []).extend(rows)
        snapshot = update_checks(store, frames(spark, news), CHECKS, f"b{batch}", width=5)
        whole = frames(spark, everything)
        assert values(check_report(spark, snapshot)) == values(run_checks(whole, CHECKS))
        got = open_orphans(spark, snapshot, "lines", "item", "items", "id").collect()
        want = orphans(whole["lines"], "item", whole["items"], "id").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_a_batch_reads_and_writes_only_the_ranges_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = {"lines": [(n, n, "a") for n in range(100)], "items": [(n, "a") for n in range(90)]}
    before = update_checks(store, frames(spark, first), CHECKS, "one", width=10)
    keys, lost = keys_table("lines", "id"), open_table("lines", "item", "items", "id")
    assert set(before.tables[lost].folders) == {"9"}
    second = {"lines": [(7, 95, "b"), (101, 3, "b")]}
    after = update_checks(store, frames(spark, second), CHECKS, "two", width=10)
    was, now = before.tables[keys].folders, after.tables[keys].folders
    assert {r for r in now if was.get(r) != now[r]} == {"0", "10"}
    third = update_checks(store, frames(spark, {"items": [(n, "b") for n in range(90, 96)]}), CHECKS, "three", width=10)
    rows = open_orphans(spark, third, "lines", "item", "items", "id").collect()
    assert sorted(map(tuple, rows)) == [(96, 1), (97, 1), (98, 1), (99, 1)]


def test_a_batch_counts_once_and_a_missing_parent_has_no_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    news = frames(spark, {"lines": [(1, 5, "a"), (1, 5, None), (None, None, "a")]})
    once = update_checks(store, news, CHECKS, "one")
    assert update_checks(store, news, CHECKS, "one").number == once.number
    got = {(r[0], r[1], r[2]): r[3] for r in values(check_report(spark, store.current()))}
    assert got[("unique", "lines", "id")] == 1 and got[("not_null", "lines", "note")] == 1
    assert got[("relationships", "lines", "item")] == 2 and ("unique", "items", "id") not in got
    empty = update_checks(store, frames(spark, {"lines": [], "items": []}), CHECKS, "two")
    again = {(r[0], r[1], r[2]): r[3] for r in values(check_report(spark, empty))}
    assert again == {**got, ("not_null", "items", "name"): 0, ("unique", "items", "id"): 0}


def test_kinds_that_cannot_be_compared_are_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    checks = {"lines": Checks(relationships=(("note", "others", "id"),))}
    news = frames(spark, {"lines": [(1, 5, "a")], "others": [(1,)]})
    with pytest.raises(TypeError, match="string refers to bigint"):
        update_checks(store, news, checks, "one")

from tidemill.contracts import CHECKS, Checks
from tidemill.operators.quality import not_null, orphans, relationships, run_checks, unique, violated


def frame(spark):
    rows = [(1, "a", 10), (1, None, 10), (2, None, 99), (None, "b", None), (None, "b", 99)]
    return spark.createDataFrame(rows, "k int, v string, fk int")


def test_null_counts_in_one_pass(spark):
    report = not_null(frame(spark), "t", ["k", "v"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    got = {(r.check_name, r.relation, r.column): r.violations for r in report.collect()}
    assert got == {("not_null", "t", "k"): 2, ("not_null", "t", "v"): 2}


def test_unique_ignores_nulls_and_counts_values(spark):
    assert unique(frame(spark), "t", "k").first().violations == 1
    assert unique(frame(spark), "t", "v").first().violations == 1
    assert unique(spark.range(0), "t", "id").first().violations == 0


def test_relationships_ignore_nulls_and_count_rows(spark):
    parent = spark.createDataFrame([(10,), (11,), (None,)], "id int")
    assert relationships(frame(spark), "t", "fk", parent, "id").first().violations == 2
    assert [tuple(r) for r in orphans(frame(spark), "fk", parent, "id").collect()] == [(99, 2)]
    assert relationships(parent, "p", "id", parent, "id").first().violations == 0
    assert relationships(frame(spark), "t", "fk", parent.limit(0), "id").first().violations == 4


def test_report_has_a_row_per_check(spark):
    parent = spark.createDataFrame([(10,)], "id int")
    checks = {
        "child": Checks(("k", "v"), ("k",), (("fk", "parent", "id"),)),
        "parent": Checks(unique=("id",)),
        "absent": Checks(not_null=("x",)),
    }
    report = run_checks({"child": frame(spark), "parent": parent}, checks)
    got = {(r.check_name, r.relation, r.column): r.violations for r in report.collect()}
    assert got == {
        ("not_null", "child", "k"): 2,
        ("not_null", "child", "v"): 2,
        ("unique", "child", "k"): 1,
        ("relationships", "child", "fk"): 2,
        ("unique", "parent", "id"): 0,
    }
    assert violated(report).count() == 4


def test_declared_checks_are_complete():
    declared = CHECKS.values()
    assert sum(len(c.not_null) for c in declared) == 42
    assert sum(len(c.unique) for c in declared) == 12
    assert sum(len(c.relationships) for c in declared) == 8

"""The quality gate."""

import pytest
from pyspark.sql import functions as F

from weirstone.operators.quality import Check, Result, gate, passed, validate, validate_stored


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def found(results, name):
    (result,) = [r for r in results if r.check == name]
    return result


def test_clean_table(spark):
    df = spark.createDataFrame([(1, 10), (2, 20)], "id int, v int")
    assert passed(validate("t", df, Check(("id",), {"positive": F.col("v") > 0})))


def test_unreadable_and_empty(spark, lake):
    (missing,) = validate_stored(spark, lake, "t", lake.root + "/nowhere", Check(("id",)))
    assert (missing.check, missing.passed) == ("readable", False)
    assert validate("t", ids(spark), Check(("id",))) == [Result("t", "non_empty", False, "0 records")]


def test_null_and_duplicate_keys(spark):
    nulls = found(validate("t", ids(spark, 1, None), Check(("id",))), "pk_not_null_id")
    assert (nulls.passed, nulls.detail) == (False, "1/2 nulls")
    twice = found(validate("t", ids(spark, 1, 1, 2), Check(("id",))), "no_duplicates")
    assert (twice.passed, twice.detail) == (False, "1 duplicates")
    # NULL is a key value like any other: two of them are one duplicate
    assert found(validate("t", ids(spark, None, None), Check(("id",))), "no_duplicates").detail == "1 duplicates"
    unchecked = validate("t", ids(spark, 1, 1), Check(("id",), unique=False))
    assert passed(unchecked) and [r.check for r in unchecked] == ["pk_not_null_id"]


def test_composite_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert not found(validate("t", df, Check(("a", "b"))), "no_duplicates").passed


@pytest.mark.parametrize("bad, ok, detail", [(5, True, "5/100 (5.0%)"), (6, False, "6/100 (6.0%)")])
def test_threshold(spark, bad, ok, detail):
    df = spark.range(100).select("id", F.when(F.col("id") < bad, -1).otherwise(1).alias("v"))
    rule = found(validate("t", df, Check(("id",), {"positive": F.col("v") > 0})), "positive")
    assert (rule.passed, rule.detail) == (ok, detail)


def test_undecided_rule_is_a_violation(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v int")
    assert not found(validate("t", df, Check(("id",), {"positive": F.col("v") > 0})), "positive").passed


def test_rules_that_cannot_run(spark):
    df = spark.createDataFrame([(1, "x"), (2, "3")], "id int, v string")
    rules = {
        "missing": F.col("nope") > 0,
        "raises": F.raise_error(F.lit("boom")).cast("int") > 0,
        "fine": F.col("id") > 0,
    }
    results = validate("t", df, Check(("id",), rules))
    assert found(results, "missing").detail == "-1/2 (100.0%)"
    assert found(results, "raises").detail == "-1/2 (100.0%)"
    assert found(results, "fine").passed and not passed(results)


def test_only_the_rule_itself_can_be_broken(spark, monkeypatch):
    """A failure of the cluster or of a file is no finding about a rule and is raised."""
    from weirstone.operators import quality

    real, calls = quality._measure, []

    def lost(df, check, rules):
        calls.append(len(rules))
        if rules:
            raise RuntimeError("Job aborted due to stage failure: executor lost")
        return real(df, check, rules)

    monkeypatch.setattr(quality, "_measure", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        validate("t", ids(spark, 1), Check(("id",), {"fine": F.col("id") > 0}))
    assert calls == [1]


def test_rule_that_fails_on_a_row(spark):
    df = spark.createDataFrame([(1, "x"), (2, "3")], "id int, v string")
    rules = {"cast": F.expr("cast(v as int)") > 0, "divided": F.expr("10 / (id - 1)") > 0, "fine": F.col("id") > 0}
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        results = validate("t", df, Check(("id",), rules))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert [found(results, name).detail for name in ("cast", "divided")] == ["-1/2 (100.0%)"] * 2
    assert found(results, "fine").passed


def test_row_filter_and_nested_key(spark):
    df = spark.createDataFrame([("c", 1), ("d", None)], "op string, id int")
    assert passed(validate("t", df, Check(("id",), row_filter=F.col("op") != "d")))
    nested = spark.createDataFrame([("c", (1,)), ("c", (None,))], "op string, after struct<id:int>")
    results = validate("t", nested, Check(("after.id",), unique=False))
    assert not found(results, "pk_not_null_after.id").passed


def test_gate_writes_the_log(spark, lake):
    ids(spark, 1, 2).write.parquet(lake.path("silver", "olist_orders"))
    ids(spark, 1, 1).write.parquet(lake.path("silver", "olist_sellers"))
    assert gate(spark, lake, "silver", {"olist_orders": Check(("id",))})
    assert not gate(spark, lake, "silver", {"olist_sellers": Check(("id",))})
    log = lake.load(spark, lake.quality_log_path)
    failed = [(r.layer, r.table_name, r.check_name) for r in log.where("not passed").collect()]
    assert failed == [("silver", "olist_sellers", "no_duplicates")]
    assert log.count() == 4


def test_log_failure_does_not_break_the_gate(spark, lake, monkeypatch):
    ids(spark, 1).write.parquet(lake.path("silver", "olist_orders"))

    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr("weirstone.operators.quality.append_log", broken)
    assert gate(spark, lake, "silver", {"olist_orders": Check(("id",))})


def test_one_job_per_table(spark):
    """All checks of a table come from one aggregation: one scan in the plan."""
    df = spark.range(10).select("id", (F.col("id") * 2).alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-pass", "one-pass")
    try:
        validate("t", df, Check(("id",), {f"r{i}": F.col("v") >= i for i in range(5)}))
        queries = len(tracker.getJobIdsForGroup("one-pass"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert queries <= 4  # stages of a single adaptive query, not one job per check

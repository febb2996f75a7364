"""Runs that build what has changed, and gates that read what has arrived."""

import random

import pytest
from pyspark.sql import functions as F

from weirstone.operators.profile import Profile
from weirstone.operators.quality import Check, Result, gate, validate
from weirstone.plans import resume as module
from weirstone.plans.pipeline import GateFailed
from weirstone.plans.silver import Build


def doubled(source):
    return source.select((F.col("v") % 3).alias("w"), F.current_timestamp().alias("processed_at"))


def counted(doubled_rows, other):
    return doubled_rows.join(other, doubled_rows.w == other.v).groupBy("w").count()


@pytest.fixture()
def small(monkeypatch, spark, lake):
    """Two layers of one table each over two bronze tables, and gates that pass or fail on demand."""
    verdicts = {"bronze": True, "silver": True, "gold": True}
    asked = []

    def gate(_spark, _lake, layer, *_):
        asked.append(layer)
        return verdicts[layer]

    builds = {
        "silver": {"olist_orders": Build(doubled, (("bronze", "olist_orders"),))},
        "gold": {"fact_orders": Build(counted, (("silver", "olist_orders"), ("bronze", "olist_sellers")))},
    }
    monkeypatch.setattr(module, "BUILDS", builds)
    monkeypatch.setattr(
        module, "LAYERS", {"bronze": ("olist_orders", "olist_sellers"), "silver": ("olist_orders",), "gold": ("fact_orders",)}
    )
    monkeypatch.setattr(module, "waves", lambda layer: iter([list(builds[layer])]))
    monkeypatch.setattr(module, "gate", gate)
    put(spark, lake, "olist_orders", range(9))
    put(spark, lake, "olist_sellers", range(2))
    return verdicts, asked


def put(spark, lake, table, values):
    spark.createDataFrame([(v,) for v in values], "v int").write.mode("overwrite").parquet(lake.path("bronze", table))


def run(spark, lake, **how):
    done = module.resume(spark, lake, **how)
    return sorted(done.built), done.gates


SILVER, GOLD = ("silver", "olist_orders"), ("gold", "fact_orders")


def test_only_what_changed_is_built(spark, lake, small):
    _, asked = small
    assert run(spark, lake)[0] == [GOLD, SILVER] and asked == ["bronze", "silver", "gold"]
    before = sorted(lake.read(spark, *GOLD).inputFiles())
    assert run(spark, lake) == ([], {"bronze": True, "silver": True, "gold": True}) and len(asked) == 3
    assert sorted(lake.read(spark, *GOLD).inputFiles()) == before
    # the same rows in other files and another order
    put(spark, lake, "olist_orders", reversed(range(9)))
    assert run(spark, lake)[0] == [] and len(asked) == 3
    # other rows that come out the same: nothing beyond silver is built
    put(spark, lake, "olist_orders", [v + 3 for v in range(9)])
    assert run(spark, lake)[0] == [SILVER] and asked[3:] == ["bronze"]
    # a row more
    put(spark, lake, "olist_orders", range(10))
    assert run(spark, lake)[0] == [GOLD, SILVER]
    # only gold reads this one
    put(spark, lake, "olist_sellers", [1])
    assert run(spark, lake)[0] == [GOLD]
    assert [tuple(r) for r in lake.read(spark, *GOLD).collect()] == [(1, 3)]
    # a table that somebody else has overwritten is built again
    spark.range(1).write.mode("overwrite").parquet(lake.path(*SILVER))
    assert run(spark, lake)[0] == [SILVER]


def test_a_run_goes_on_after_a_failed_gate(spark, lake, small):
    verdicts, asked = small
    verdicts["silver"] = False
    with pytest.raises(GateFailed, match="silver"):
        module.resume(spark, lake)
    assert asked == ["bronze", "silver"]
    with pytest.raises(GateFailed):  # asked again, nothing built again
        module.resume(spark, lake)
    verdicts["silver"] = True
    assert run(spark, lake)[0] == [GOLD]
    assert asked == ["bronze", "silver", "silver", "silver", "gold"]


def test_a_changed_builder_builds_again(spark, lake, small, monkeypatch):
    run(spark, lake)

    def other(source):
        return source.select((F.col("v") % 2).alias("w"))

    monkeypatch.setitem(module.BUILDS["silver"], "olist_orders", Build(other, (("bronze", "olist_orders"),)))
    assert run(spark, lake)[0] == [GOLD, SILVER]


# Profiles


def test_profile_gives_the_verdict_on_the_whole_table(spark, tmp_path):
    dice = random.Random(4)
    rows = [(dice.choice([None, *range(40)]), dice.choice([None, 1, 2]), dice.randrange(100)) for _ in range(300)]
    check = Check(("a", "b"), {"small": F.col("v") < 97, "missing": F.col("nope") > 0}, row_filter=F.col("v") > 1)
    profile = Profile(str(tmp_path / "p"), "t", check)
    schema = "a int, b int, v int"
    for number, end in enumerate((100, 100, 150, 300)):
        start = (0, 100, 100, 150)[number]
        part = spark.createDataFrame(rows[start:end], schema)
        found = profile.absorb(part, number)
        assert profile.absorb(part, number) == found  # the newest part again
        assert found == validate("t", spark.createDataFrame(rows[:end], schema), check)
    assert profile.verdict(spark) == found


def test_profile_tells_nulls_apart(spark, tmp_path):
    profile = Profile(str(tmp_path / "p"), "t", Check(("a", "b")))
    schema = "a int, b int"
    assert profile.absorb(spark.createDataFrame([], schema), 0) == [Result("t", "non_empty", False, "0 records")]
    found = profile.absorb(spark.createDataFrame([(1, None), (None, 1), (None, None)], schema), 1)
    assert found[-1] == Result("t", "no_duplicates", True, "0 duplicates")
    assert profile.absorb(spark.createDataFrame([(None, 1)], schema), 2)[-1].detail == "1 duplicates"


def test_a_gate_reads_only_tables_that_changed(spark, lake, small, monkeypatch):
    """Of a gate that has failed, tables keep their verdict while their content and their checks are the same."""
    asked, bound = [], {"v": 100}

    def counting(_spark, _lake, layer, checks, parallel, verdicts):
        asked.append((layer, sorted(checks)))
        return gate(_spark, _lake, layer, checks, parallel, verdicts)

    def checks():
        return {"olist_orders": Check(rules={"small": F.col("v") < bound["v"]}), "olist_sellers": Check(rules={"none": F.col("v") < 0})}

    def outcome():
        asked.clear()
        return module.resume(spark, lake, enforce_gates=False).gates["bronze"], [tables for layer, tables in asked if layer == "bronze"]

    monkeypatch.setattr(module, "gate", counting)
    monkeypatch.setattr(module, "CHECKS", {"bronze": checks, "silver": dict, "gold": dict})
    assert outcome() == (False, [["olist_orders", "olist_sellers"]])
    assert outcome() == (False, [])
    put(spark, lake, "olist_orders", range(10))
    assert outcome() == (False, [["olist_orders"]])
    bound["v"] = 5  # the check is another one
    assert outcome() == (False, [["olist_orders"]])
    put(spark, lake, "olist_sellers", [-1])
    assert outcome() == (False, [["olist_sellers"]])  # orders keep theirs, which has failed
    bound["v"] = 100
    assert outcome() == (True, [["olist_orders"]])


def test_a_table_that_cannot_be_read_gets_no_verdict_to_keep(spark, lake):
    verdicts = {}
    put(spark, lake, "olist_orders", range(3))
    assert gate(spark, lake, "bronze", {"olist_orders": Check(), "olist_sellers": Check()}, 2, verdicts) is False
    assert verdicts == {"olist_orders": True}

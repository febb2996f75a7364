"""Lenient parsing against hand-written expectations and against a chain of explicit patterns."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from weirstone.functions import cleaning as clean
from weirstone.functions import money
from weirstone.functions import parsing as parse


def apply(spark, values, *conversions):
    """One column of text through conversions; rows come back in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    out = df.select("i", *[f(F.col("raw")).alias(f"c{n}") for n, f in enumerate(conversions)])
    return [tuple(row[1:]) for row in sorted(out.collect())]


TEN = datetime(2024, 1, 1, 10)


def test_epoch_or_timestamp(spark):
    got = apply(
        spark,
        ["1704103200000", "2024-01-01 10:00:00", None, "garbage", "1704103200999", "2024", "9" * 25, "-5", ""],
        parse.epoch_or_timestamp,
    )
    two_seconds = datetime(1970, 1, 1, 0, 0, 2)
    assert [g[0] for g in got] == [TEN, TEN, None, None, TEN, two_seconds, None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_any_timestamp_equals_the_chain_of_patterns(spark, ansi):
    """Every layout, valid and broken, must parse as a coalesce over the explicit patterns would."""
    days = ["2024-01-01", "2024-02-29", "2023-02-29", "2024-13-01", "2024-1-5", "1969-12-31"]
    times = ["10:00:00", "10:00:00.123", "10:00:00.123456", "25:00:00", "9:5:7", "10:00", "23:59:60"]
    zones = ["", "Z", "+07", "-03:30", "+0700", " UTC", "+7"]
    texts = [f"{d}{sep}{t}{z}" for d in days for sep in ("T", " ") for t in times for z in zones]
    texts += [*days, "1704103200000", " 1704103200000 ", "0", "abc", "", " ", "2024", "2024-05", "T10:00"]

    def chain(column):
        text = F.trim(column)
        patterns = ["yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]
        return F.coalesce(
            F.when(text.rlike("^[0-9]+$"), F.timestamp_seconds(F.floor(text.try_cast("bigint") / 1000))),
            *[F.try_to_timestamp(text, F.lit(p)) for p in patterns],
            F.try_to_timestamp(text),
        )

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = apply(spark, [t for t in texts if t != "T10:00"], parse.any_timestamp, chain)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    different = [(t, g) for t, g in zip([t for t in texts if t != "T10:00"], got) if g[0] != g[1]]
    assert different == []
    assert sum(g[0] is not None for g in got) > 100


def test_any_date(spark):
    cases = {
        "1/15/2020": date(2020, 1, 15),
        "12/5/1999": date(1999, 12, 5),
        "13/40/2020": None,
        "2021-03-02": date(2021, 3, 2),
        '"2021-03-02"': date(2021, 3, 2),
        "'2021-03-02'": date(2021, 3, 2),
        "2021-3-2": None,
        "2021-02-30": None,
        "2021-03-02 23:59:59": date(2021, 3, 2),
        "2021-03-02 25:00:00": None,
        "18262": date(2020, 1, 1),
        "0": date(1970, 1, 1),
        "1000000": date(4707, 11, 29),
        "1577836800": date(2020, 1, 1),
        "1577836800000": date(2020, 1, 1),
        "  2021-03-02  ": date(2021, 3, 2),
        "soon": None,
        "": None,
        None: None,
    }
    got = apply(spark, list(cases), parse.any_date)
    assert dict(zip(cases, (g[0] for g in got))) == cases


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_casts(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = apply(
            spark,
            ["3", " 3 ", "3.7", "-3.7", "abc", "", None, "99999999999", "9007199254740993", "true", "1.5"],
            parse.whole,
            parse.whole32,
            parse.real,
            parse.flag,
        )
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [g[0] for g in got] == [3, 3, 3, -3, None, None, None, 99999999999, 9007199254740993, None, 1]
    assert [g[1] for g in got] == [3, 3, 3, -3, None, None, None, None, None, None, 1]
    assert [g[2] for g in got][:5] == [3.0, 3.0, 3.7, -3.7, None]
    assert [g[3] for g in got][9] is True and got[4][3] is None


def test_cleaning_expressions(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 3, 5, "x", "SP"), (2, 100.0, 0, None, "  ", "XX"), (3, None, None, 3, None, None), (4, 10.0, None, 1, "", "AM")],
        "i int, v double, n int, s int, t string, st string",
    )
    v, n, s, t, st = (F.col(c) for c in ("v", "n", "s", "t", "st"))
    rows = (
        df.select(
            "i",
            clean.installment(v, n),
            clean.ratio(v, n, 2),
            clean.score_label(s, "UNKNOWN"),
            clean.score_label(s, "NEGATIVE"),
            clean.has_text(t, F.lit(None).cast("string")),
            clean.region_of(st),
            clean.indicator(s >= 4),
            clean.product_of(n, n, s),
        )
        .orderBy("i")
        .collect()
    )
    assert [tuple(r)[1:] for r in rows] == [
        (33.33, 33.33, "POSITIVE", "POSITIVE", True, "SUDESTE", 1, 45),
        (100.0, None, "UNKNOWN", "NEGATIVE", False, "OUTROS", 0, None),
        (None, None, "NEUTRAL", "NEUTRAL", False, "OUTROS", 0, None),
        (10.0, None, "NEGATIVE", "NEGATIVE", False, "NORTE", 0, None),
    ]


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (999, 1000, 9999, 10000, 49999, 50000, None)], "v long")
    got = [r[0] for r in df.select(clean.banded(F.col("v"), clean.SIZE_CLASSES)).collect()]
    assert got == ["SMALL", "MEDIUM", "MEDIUM", "LARGE", "LARGE", "EXTRA_LARGE", "UNKNOWN"]


def test_large_volume_does_not_wrap(spark):
    df = spark.createDataFrame([(5000, 5000, 5000)], "a int, b int, c int")
    assert df.select(clean.product_of(F.col("a"), F.col("b"), F.col("c"))).first()[0] == 125_000_000_000


def test_money_is_exact_in_any_order(spark):
    amounts = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9] * 200
    df = spark.createDataFrame([(a,) for a in amounts], "v double")
    for width in (1, 3, 7):
        got = df.repartition(width).agg(money.total(F.col("v")).alias("t"), money.mean(F.col("v"), 2).alias("m")).first()
        assert got.t == 122.0
        assert got.m == 0.12
    ties = spark.createDataFrame([(1.00,), (1.01,)], "v double")
    assert ties.agg(money.mean(F.col("v"), 2)).first()[0] == 1.01
    assert ties.where("v > 5").agg(money.mean(F.col("v"), 2)).first()[0] is None

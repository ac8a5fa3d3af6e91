from pyspark.sql import functions as F

from frames import frame, values
from kinfold.functions import missing as m
from kinfold.functions.recode import banded, equals_any, flag, flag_known, grouped, one_hot, swap


def column(spark, expression, *data, schema="i int, x int, y int"):
    df = frame(spark, schema, *[(n, *row) for n, row in enumerate(data)])
    return values(df.select("i", expression.alias("out")), "out", "i")


def test_missing_is_above_every_number(spark):
    assert column(spark, m.above("x", 60), (60, 0), (61, 0), (None, 0)) == [False, True, True]
    assert column(spark, m.at_least("x", 60), (59, 0), (60, 0), (None, 0)) == [False, True, True]
    # Below needs no helper: a missing value is not below anything.
    assert column(spark, m.is_true(F.col("x") < 60), (59, 0), (None, 0)) == [True, False]


def test_missing_differs_from_a_value_and_equals_missing(spark):
    assert column(spark, m.differs("x", 1), (1, 0), (2, 0), (None, 0)) == [False, True, True]
    assert column(spark, m.same("x", "y"), (1, 1), (1, 2), (None, None), (None, 1)) == [True, False, True, False]


def test_row_total_and_row_max_skip_missing(spark):
    assert column(spark, m.row_total("x", "y"), (1, 2), (None, 2), (None, None)) == [3.0, 2.0, 0.0]
    assert column(spark, m.row_max("x", "y"), (1, 2), (None, 2), (None, None)) == [2, 2, None]


def test_group_total_of_missing_is_zero_but_maximum_is_missing(spark):
    df = frame(spark, "g int, x int", (1, None), (1, None), (2, 3), (2, None))
    out = df.groupBy("g").agg(m.group_total("x").alias("t"), F.max("x").alias("m"))
    assert sorted(map(tuple, out.collect())) == [(1, 0, None), (2, 3, 3)]


def test_arithmetic_and_division(spark):
    assert column(spark, F.col("x") + F.col("y"), (1, None), (1, 2)) == [None, 3]
    assert column(spark, m.ratio("x", "y"), (1, 0), (1, 2), (None, 2), (1, None)) == [None, 0.5, None, None]


def test_last_rule_wins_also_with_missing(spark):
    rule = m.last_match([(F.col("x") == 1, F.lit(0)), (F.col("y") == 2, F.lit(None).cast("int"))], otherwise=F.lit(9))
    assert column(spark, rule, (1, 0), (1, 2), (0, 2), (0, 0), (None, None)) == [0, None, None, 9, 9]


def test_sentinels(spark):
    assert column(spark, m.codes_as_missing("x", 97, 98), (97, 0), (5, 0), (None, 0)) == [None, 5, None]
    df = frame(spark, "i int, s string", (0, ""), (1, "##N/A##"), (2, "a"), (3, None))
    assert values(df.select("i", m.blank_as_missing("s", "##N/A##").alias("s")), "s", "i") == [None, None, "a", None]


def test_fill_zero_and_any_missing(spark):
    assert column(spark, m.fill_zero("x"), (None, 0), (4, 0)) == [0, 4]
    assert column(spark, m.any_missing("x", "y"), (1, None), (1, 2)) == [True, False]


def test_recodes(spark):
    assert column(spark, swap("x", {2: 0}), (2, 0), (1, 0), (None, 0)) == [0, 1, None]
    assert column(spark, grouped("x", {1: [1, 2], 2: [3]}, (9, 5)), (2, 0), (3, 0), (4, 0), (7, 0), (None, 0)) \
        == [1, 2, None, 9, None]
    assert column(spark, banded("x", [("a", 1, 2), ("b", 5, None)]), (1, 0), (3, 0), (50, 0), (None, 0)) \
        == ["a", None, "b", None]
    assert column(spark, flag(F.col("x") == 1), (1, 0), (2, 0), (None, 0)) == [1, 0, 0]
    assert column(spark, flag_known(F.col("x") > 1, "x"), (1, 0), (2, 0), (None, 0)) == [0, 1, None]
    assert column(spark, equals_any("x", ["y"]), (1, 1), (1, 2), (None, None)) == [1, None, 1]
    df = frame(spark, "q int", (1,), (2,), (None,))
    assert sorted(map(tuple, df.select(*one_hot("q", [1, 2], "q")).collect()), key=str) == [(0, 1), (1, 0), (None, None)]

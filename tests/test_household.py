import pytest

from frames import frame, values
from kinfold.functions import dates, household as hf, money


def column(spark, schema, expression, *data):
    df = frame(spark, "i int, " + schema, *[(n, *row) for n, row in enumerate(data)])
    return values(df.select("i", expression.alias("out")), "out", "i")


def test_ages(spark):
    assert column(spark, "a int", hf.adult("a"), (18,), (17,), (None,)) == [1, 0, None]
    assert column(spark, "a int", hf.child("a"), (0,), (17,), (18,), (None,)) == [1, 1, 0, None]
    # An unknown age counts as elderly.
    assert column(spark, "a int", hf.elderly("a"), (60,), (61,), (None,)) == [0, 1, 1]


def test_equivalence_scale(spark):
    scale = hf.equivalence_scale("m", "a", "c", hf.SCALE_NEW)
    # A lone adult, a lone child, a couple with two children, two children without an adult.
    assert column(spark, "m int, a int, c int", scale, (1, 1, 0), (1, 0, 1), (4, 2, 2), (2, 0, 2)) \
        == pytest.approx([1.0, None, 2.1, 1.1])
    old = hf.equivalence_scale("m", "a", "c", hf.SCALE_OLD)
    assert column(spark, "m int, a int, c int", old, (4, 2, 2)) == pytest.approx([2.7])


def test_child_groups(spark):
    assert column(spark, "n int", hf.child_group("n"), (0,), (1,), (2,), (3,), (4,), (5,), (None,)) \
        == [None, 1, 1, 2, 2, 3, None]


def test_food_score(spark):
    assert column(spark, "a int, b int", hf.staples("a", "b"), (2, 4), (None, 4), (3, None), (None, None)) \
        == [3.0, 4.0, 3.0, None]
    names = list(hf.FOOD_WEIGHTS)
    score = hf.food_score(**{n: n for n in names})
    schema = ", ".join(f"{n} int" for n in names)
    assert column(spark, schema, score, (1,) * 8, (7,) * 8, (None,) + (1,) * 7) == [16.0, 112.0, None]
    assert column(spark, "s double", hf.food_band("s"), (21.0,), (21.5,), (35.0,), (35.5,), (None,)) == [0, 1, 1, 2, None]


def test_coping_index(spark):
    index = hf.coping_index(less_expensive="a", portion="b", reduce_meals="c", child="d", borrow="e")
    assert column(spark, "a int, b int, c int, d int, e int", index, (1, 1, 1, 1, 1), (1, None, 0, 0, 0)) == [8.0, None]
    df = frame(spark, "x double", (0.0,), (4.5,), (5.0,), (10.5,), (11.0,), (None,))
    found = {r["x"]: (r["food_secure"], r["mod_insecure"], r["sev_insecure"])
             for r in df.withColumns(hf.coping_flags("x")).collect()}
    assert found == {0.0: (1, 0, 0), 4.5: (0, 0, 0), 5.0: (0, 1, 0), 10.5: (0, 0, 0), 11.0: (0, 0, 1),
                     None: (None, None, None)}


def test_distances(spark):
    schema = "d double, u int, p int"
    usual = hf.to_metres("d", "u", "p")
    assert column(spark, schema, usual, (3.0, 1, 2), (3.0, 2, 2), (2.0, 3, 2), (3.0, None, 1), (0.0, None, 2),
                  (3.0, None, 2), (3.0, 2, 1)) == [3.0, 3000.0, 3218.688, 0.0, 0.0, None, 3000.0]
    # A present service with a unit but no distance: the unit rule comes later and wins.
    assert column(spark, schema, usual, (None, 2, 1)) == [None]
    assert column(spark, schema, hf.to_metres("d", "u", units=(1, 2), zero_unit=True), (3.0, 0, 1), (3.0, 3, 1),
                  (3.0, 2, 1)) == [0.0, None, 3000.0]
    assert column(spark, schema, hf.to_metres("d", "u", "p", units=(2, 3)), (3.0, 1, 2), (3.0, 1, 1)) == [None, 0.0]


def test_most_frequent_option(spark):
    out = hf.most_frequent(["a", "b", "c"], ["na", "nb", "nc"])
    schema = "a int, b int, c int, na int, nb int, nc int"
    # Clear winner, tie (last wins), nothing known (last), one known.
    assert column(spark, schema, out, (1, 2, 3, 9, 5, 1), (1, 2, 3, 9, 9, 1), (1, 2, 3, None, None, None),
                  (1, 2, 3, None, 4, None)) == [1, 2, 3, 2]


def test_parents(spark):
    educ = hf.parent_education("p", "own", "oldest")
    assert column(spark, "p int, own int, oldest int", educ, (4, 2, 5), (None, 2, 5), (98, 2, None), (4, None, 5)) \
        == [2, 5, 2, None]
    job = hf.parent_job("p", "job", "head")
    assert column(spark, "p int, job int, head int", job, (4, 2, 5), (99, 2, 5), (4, None, 5), (None, 2, None)) \
        == [2, 5, 6, 6]


def test_ratios_and_durations(spark):
    assert column(spark, "x int, n int", hf.per_adult("x", "n"), (3, 2), (3, 0), (3, None), (None, 2)) == [1.5, 3.0, None, None]
    assert column(spark, "d int, u int", hf.to_minutes("d", "u"), (5, 1), (2, 2), (5, None)) == [5.0, 120.0, None]
    assert column(spark, "a int, b int", hf.better_off("a", "b"), (2, 1), (1, 1), (None, 1)) == [1, 0, None]


def test_target(spark):
    target = hf.left_school("c11", "c12", "c15", "c11b", "c13b", "c15b")
    schema = "c11 int, c12 int, c15 int, c11b int, c13b int, c15b int"
    assert column(spark, schema, target,
                  (1, 4, 2016, 2, 2, 3), (1, 4, None, 2, 2, 3), (1, 4, 2014, 2, 2, 3), (1, 4, 2016, 2, 2, None),
                  (1, 4, 2016, 1, None, None), (1, 4, 2016, 2, 1, 3), (2, 4, 2016, 2, 2, 3), (1, 9, 2016, 1, 1, 3),
                  (1, None, 2016, 1, 1, 3)) == [1, 1, None, None, 0, 0, None, None, None]


def test_dates(spark):
    na = dates.NO_DATE
    visit = dates.visit_date("g", "v1", "v2")
    assert column(spark, "g int, v1 string, v2 string", visit, (1, "a", "b"), (2, "a", "b"), (None, "a", "b"),
                  (1, "", "b"), (2, "a", na), (1, "", na), (2, "a", "")) == ["a", "b", "b", "b", "a", "", ""]
    first = dates.interview_or_first_visit("d", "v1")
    assert column(spark, "d string, v1 string", first, ("x", "a"), (na, "a"), (None, "a")) == ["x", "a", None]
    assert column(spark, "d string", dates.month_key("d"), ("2016-11-03",), (None,)) == ["2016-11", None]


def test_month_numbers(spark):
    data = [("2016-05-03",), ("2016-12",), ("0999-01-01",), ("2016-13-01",), ("",), ("##N/A##",), (None,)]
    back = dates.month_text(dates.month_number("d"))
    assert column(spark, "d string", back, *data) == ["2016-05", "2016-12", "0999-01", None, None, None, None]


def test_money(spark):
    assert column(spark, "x double", money.monthly("x", "week"), (3.0,)) == [12.0]
    assert column(spark, "x double", money.monthly("x", "year"), (24.0,)) == [2.0]
    assert column(spark, "x double", money.inflator("x"), (money.BASE_INDEX,), (0.0,)) == [1.0, None]
    df = frame(spark, "e double, inflator double, s double", (10.0, 2.0, 4.0), (10.0, 2.0, 0.0))
    assert [r[0] for r in df.select(*money.per_unit(["e"], {"aes1": "s"})).collect()] == [5.0, None]

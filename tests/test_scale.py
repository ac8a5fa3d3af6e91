"""Range-wise totals against direct computation, and plans that survive hot keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinfold.operators.cumulative import average_rank, running_totals
from kinfold.operators.dedup import first_per_key
from kinfold.operators.groups import attach
from kinfold.operators.merge import merge
from kinfold.operators.quantiles import weighted_cuts, weighted_quantile_group
from kinfold.operators.wealth import asset_index, principal_component


@pytest.fixture(scope="module")
def scores():
    random = np.random.default_rng(7)
    # One group holds most rows, all of them in a narrow range of values.
    hot = pd.DataFrame({"g": "hot", "x": random.normal(5, 0.001, 3000).round(6)})
    rest = pd.DataFrame({"g": random.choice(list("abc"), 1000), "x": random.integers(-50, 50, 1000).astype(float)})
    data = pd.concat([hot, rest], ignore_index=True)
    data["w"] = random.integers(1, 5, len(data)).astype(float)
    return data.groupby(["g", "x"], as_index=False)["w"].sum()


@pytest.mark.parametrize("ranges", [2, 16, 200])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, scores, descending, ranges):
    out = running_totals(spark.createDataFrame(scores), ["g"], "x", ["w"], descending=descending, ranges=ranges).toPandas()
    expected = scores.sort_values("x", ascending=not descending)
    expected["cum"] = expected.groupby("g")["w"].cumsum()
    both = out.merge(expected[["g", "x", "cum"]], on=["g", "x"])
    assert len(both) == len(scores) == len(out)
    assert (both["cum_w"] == both["cum"]).all()
    assert (both["all_w"] == both["g"].map(scores.groupby("g")["w"].sum())).all()


def test_running_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, x double, w double")
    assert running_totals(empty, ["g"], "x", ["w"]).count() == 0


def test_average_rank(spark):
    random = np.random.default_rng(3)
    data = pd.DataFrame({"m": random.choice(list("pq"), 500), "v": random.integers(0, 40, 500).astype(float)})
    data["i"] = range(500)
    with_gaps = [(r.m, None if r.i % 50 == 0 else r.v, r.i) for r in data.itertuples()]
    data.loc[data["i"] % 50 == 0, "v"] = np.nan
    df = spark.createDataFrame(with_gaps, "m string, v double, i long")
    out = average_rank(df, ["m"], "v", descending=True).toPandas().sort_values("i")
    expected = data.groupby("m")["v"].rank(ascending=False)
    assert np.allclose(out["rank"].to_numpy(), expected.to_numpy(), equal_nan=True)


def direct_groups(score, weight, n=5):
    """Quantile groups by definition, one cut after the other."""
    order = sorted({s for s in score if s is not None})
    total = sum(w for s, w in zip(score, weight) if s is not None)
    cuts = []
    for p in range(1, n):
        target, cum, met = total * p / n, 0.0, None
        for value in order:
            cum += sum(w for s, w in zip(score, weight) if s == value)
            if cum == target:
                met = value
            if cum > target:
                cuts.append(value if met is None else (met + value) / 2)
                break
    return [None if s is None else 1 + sum(c < s for c in cuts) for s in score], cuts


@pytest.mark.parametrize("seed", range(4))
def test_weighted_quantiles(spark, seed):
    random = np.random.default_rng(seed)
    score = [None if random.random() < 0.05 else float(v) for v in random.integers(0, 30, 200)]
    weight = [float(w) for w in random.integers(1, 4, 200)]
    if seed == 3:  # exact shares
        score, weight = [float(i) for i in range(10)], [1.0] * 10
    df = spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(zip(score, weight))], "i int, s double, w double")
    expected, cuts = direct_groups(score, weight)
    assert weighted_cuts(df, "s", "w", ranges=7).first().cuts == cuts
    out = weighted_quantile_group(df, "s", "w", "q", ranges=7).orderBy("i").collect()
    assert [r.q for r in out] == expected


def test_quantile_weights_are_about_equal(spark):
    df = spark.range(2000).select("id", (F.col("id") * 7919 % 2003).cast("double").alias("s"), F.lit(1.0).alias("w"))
    counts = weighted_quantile_group(df, "s", "w", "q").groupBy("q").count().collect()
    assert sorted(r["count"] for r in counts) == [400] * 5


def test_principal_component(spark):
    random = np.random.default_rng(5)
    data = random.normal(size=(400, 4))
    data[:, 1] += 2 * data[:, 0]
    data[:, 3] = 7.0  # no variation
    weight = random.integers(1, 4, 400)
    table = [(i, *map(float, row), int(w)) for i, (row, w) in enumerate(zip(data, weight))]
    table[3] = (3, None, *table[3][2:])
    df = spark.createDataFrame(table, "i int, a double, b double, c double, d double, w int").repartition(5)
    kept = np.delete(np.repeat(data, weight, axis=0), slice(weight[:3].sum(), weight[:4].sum()), axis=0)
    z = (kept[:, :3] - kept[:, :3].mean(0)) / kept[:, :3].std(0, ddof=1)
    vector = np.linalg.eigh(np.corrcoef(z.T))[1][:, -1]
    vector *= np.sign(vector[np.abs(vector).argmax()])
    loadings = principal_component(df, ["a", "b", "c", "d"], weight="w").loadings
    assert np.allclose(loadings[:3], vector) and abs(loadings[3]) < 1e-9
    out = {r.i: r.asset_index for r in asset_index(df, ["a", "b", "c", "d"], weight="w").collect()}
    assert out[3] is None
    expected = (data[:, :3] - kept[:, :3].mean(0)) / kept[:, :3].std(0, ddof=1) @ vector
    assert all(abs(out[i] - expected[i]) < 1e-8 for i in range(400) if i != 3)


@pytest.fixture
def tight(spark):
    """Thresholds so small that test data counts as skewed, and nothing is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot_members(spark, n=40_000):
    """Two thirds of all members live in one household."""
    return spark.range(0, n, 1, 8).select(
        "id", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 500).cast("int").alias("hh"),
        F.rand(1).alias("x"), F.lit("some text to give the rows a size").alias("note"))


def test_hot_household_is_split_when_group_values_come_back(spark, tight):
    members = hot_members(spark)
    out = attach(members, ["hh"], {"n": F.count("*")})
    assert "skew=true" in executed(out)
    assert out.agg(F.sum("n")).first()[0] == sum(r["count"] ** 2 for r in members.groupBy("hh").count().collect())


def test_hot_household_is_split_in_merges(spark, tight):
    members = hot_members(spark)
    households = members.groupBy("hh").agg(F.max("x").alias("top"))
    for options in ({}, {"null_safe": True}, {"keep": "all", "indicator": "_merge"}):
        out = merge(members, households, "hh", **options)
        assert "skew=true" in executed(out)
        assert out.count() == 40_000


def test_first_row_is_chosen_before_the_shuffle(spark):
    out = first_per_key(hot_members(spark), ["hh"], ["x", "id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == 500


def test_curve_reads_its_input_once(spark):
    from kinfold.operators.evaluate import roc_points

    predictions = spark.range(0, 5000, 1, 4).select(
        F.lit("m").alias("model_name"), "id", (F.col("id") % 2).cast("int").alias("y_true"), F.lit(1).alias("y_pred"),
        (F.col("id") * 7 % 1000 / 1000).alias("y_prob"), F.lit(1.0).alias("weight"))
    points = roc_points(predictions).filter("threshold IS NOT NULL")
    plan = executed(points)
    assert points.count() == 1000 and "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["household_food_spend", "recall_period_spend", "weighted_score_bands",
                                  "plot_labour_hours", "household_composition", "metrics_weighted"])
def test_big_aggregations_hash(spark, name):
    """Text or struct values in an aggregation would make Spark sort all item rows first."""
    from kinfold.catalog import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_scans_are_pruned(spark):
    from kinfold.catalog import QUERIES

    plan = QUERIES["merge_indicator"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "l_shipdate" not in plan and "o_totalprice" not in plan


def test_fractional_weights_give_the_same_groups_for_any_ranges(spark):
    df = spark.createDataFrame([(i, float(i), 0.1) for i in range(20)], "i int, s double, w double")
    for ranges in (2, 8, 16, 200, 1024):
        found = weighted_quantile_group(df, "s", "w", "q", ranges=ranges).groupBy("q").count().orderBy("q").collect()
        assert [r["count"] for r in found] == [4, 4, 4, 4, 4]


def exact_groups(score, weight, n=5):
    """Groups by fractions of what the weights are written as: no rounding anywhere."""
    from fractions import Fraction

    totals = {}
    for s, w in zip(score, weight):
        totals[s] = totals.get(s, 0) + Fraction(repr(w))
    whole, cuts = sum(totals.values()), []
    for p in range(1, n):
        cum, met = Fraction(0), None
        for s in sorted(totals):
            cum += totals[s]
            if cum * n == whole * p:
                met = s
            if cum * n > whole * p:
                cuts.append(s if met is None else (met + s) / 2)
                break
    return [1 + sum(c < s for c in cuts) for s in score]


@pytest.mark.parametrize("weights", [[1e-12], [0.1], [1e12], [1e-12, 0.1, 1e12], [4.9e-324], [1.7e308, 1e290], [0.1, 0.3, 2.0**-60, 3.0],
                                     [1e-36, 1.0], [0.0, 1.0], [0.1, 0.2, 0.3, 0.7], [123456.789, 0.001, 1e-9]])
def test_weights_of_any_size(spark, weights):
    random = np.random.default_rng(len(weights))
    score = [float(v) for v in random.integers(0, 40, 300)]
    weight = [weights[i] for i in random.integers(0, len(weights), 300)]
    rows = [(i, s, w) for i, (s, w) in enumerate(zip(score, weight))] + [(300, 1.0, float("nan")), (301, 1.0, float("inf")), (302, 1.0, None)]
    df = spark.createDataFrame(rows, "i int, s double, w double").repartition(5)
    expected = exact_groups(score, weight)
    for ranges in (2, 1024):
        out = weighted_quantile_group(df, "s", "w", "q", ranges=ranges).orderBy("i").collect()
        assert [r.q for r in out][:300] == expected


def test_exact_parts_of_doubles(spark):
    from fractions import Fraction

    from kinfold.operators.exact import BASE, binary_exponent, digits, order_bits, sign_of_sum, top_place

    random = np.random.default_rng(8)
    values = [abs(float(v)) for v in random.normal(size=300) * 10.0 ** random.integers(-300, 300, 300)]
    values += [5e-324, 2.0**-1022, 2.0**-1023, 1.7976931348623157e308, 1.0, 0.1, 2.0**52, 2.0**53 - 1, float(np.nextafter(8.0, 0)), 8.0, float(np.nextafter(8.0, 9))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", binary_exponent(F.col("v")).alias("e"), order_bits(F.col("v")).alias("o")).collect()
    for v, e, o in got:
        assert 2.0**e <= v and (e == 1023 or v < 2.0 ** (e + 1))
        assert o == int(np.float64(v).view(np.int64))
    near = [(v,) for v in (0.1, -0.1, 9.9, 1e-20, -3.25e-30, 123e-7, 0.0, 5.0, 1.2345678901234567, 9.87654321e-36, 1e-60)]
    for r in spark.createDataFrame(near, "v double").select("v", F.array(*digits(F.col("v"), F.lit(1))).alias("d")).collect():
        held = sum(Fraction(int(d), BASE ** (i + 1)) for i, d in enumerate(r.d)) * 10
        assert held == (Fraction(repr(r.v)) if abs(r.v) > 1e-37 else 0)
    tops = spark.createDataFrame([(v,) for v in (0.0, 0.02, -345.6)], "v double")
    assert top_place(tops, "v").head().place == 3 and top_place(tops.limit(1), "v").head().place == 0 and top_place(tops.limit(0), "v").head().place == 0
    parts = [[int(x) for x in random.integers(-3, 4, 3)] for _ in range(200)] + [[1, -BASE, 0], [1, -BASE, -1], [0, 1, -BASE], [-1, BASE, 0], [-1, BASE - 1, BASE]]
    frame_ = spark.createDataFrame([tuple(p) for p in parts], "a bigint, b bigint, c bigint")
    sign = lambda x: (x > 0) - (x < 0)
    for r in frame_.select("*", sign_of_sum([F.col("a"), F.col("b"), F.col("c")]).alias("s")).collect():
        assert r.s == sign(r.a * BASE * BASE + r.b * BASE + r.c)


def test_oldest_of_any_id_and_age(spark):
    from kinfold.operators.groups import oldest

    big = 1 << 62
    cases = {
        "big ids": [(1 << 52, 40.0, 1), (1 << 53, 41.0, 2)], "fractions": [(2, 70.2, 1), (1, 70.9, 2)],
        "tie": [(5, 30.0, 1), (-7, 30.0, 2), (big, 30.0, 3)], "extremes": [(-(1 << 63), 30.0, 1), ((1 << 63) - 1, 30.0, 2)],
        "next": [(1, 30.0, 1), (2, float(np.nextafter(30.0, 31)), 2)], "zero": [(3, 0.0, 1), (4, 5e-324, 2)],
        "no age": [(1, -1.0, 1), (2, float("nan"), 2), (3, None, 3), (4, float("inf"), 4)], "huge": [(1, 1.7e308, 1), (2, 90.0, 2)]}
    df = spark.createDataFrame([(g, *r) for g, rs in cases.items() for r in rs], "g string, id bigint, age double, x int").repartition(4)
    found = df.groupBy("g").agg(oldest("age", "id", F.lit(True), "x").alias("o"))
    assert {r.g: r.o.x for r in found.collect()} == {
        "big ids": 2, "fractions": 2, "tie": 2, "extremes": 1, "next": 2, "zero": 2, "no age": None, "huge": 1}
    grouped = df.groupBy("x").agg(oldest("age", "id", F.lit(True), "x").alias("o"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_spread_ids_beyond_the_longs(spark):
    """Keys whose id is within the longs, beyond one end of them, and keys whose product alone is beyond it."""
    from kinfold.catalog.households import SPREAD, spread

    keys = [1, 2, 138479, 1000003, 9_000_000_000, (1 << 63) - 1, -5, None]
    orders = spark.createDataFrame([(k, 7, 1234.5) for k in keys], "o_orderkey bigint, o_custkey bigint, o_totalprice double")
    found = {r.pid: r.member for r in spread(orders).collect()}
    exact = {k: (k * 2654435761 % 1000003 - 500000) * 18446744073709 + k for k in keys if k is not None and k > 0}
    exact[-5] = (-(5 * 2654435761 % 1000003) - 500000) * 18446744073709 - 5
    assert not -(1 << 63) <= exact[138479] < 1 << 63
    assert found == {**{k: (e + (1 << 63)) % (1 << 64) - (1 << 63) for k, e in exact.items()}, None: None}
    few = orders.filter("o_orderkey < 138479 AND o_orderkey > 0")
    assert few.selectExpr(*SPREAD.columns).collect() == spread(few).collect()


def test_least_plots_are_sorted_narrow(spark):
    """Repeated plots: packed whole numbers give what the plain columns give, which doubles still take."""
    from kinfold.plans.labour import labour_hours

    random = np.random.default_rng(5)
    tasks, names = {"one": "q1", "two": "q2"}, [f"{q}{x}{n}" for q in ("q1", "q2") for x in "abcd" for n in range(1, 4)]
    pick = {"a": [None, -(1 << 40), 5, 1 << 40], "b": [None, 0, 3], "c": [None, -2, 7], "d": [None, 1, 300]}
    rows = [(int(h), int(g), *[pick[c[2]][random.integers(len(pick[c[2]]))] for c in names])
            for h, g in random.integers(0, 6, (400, 2))] + [(None, 1, *[1] * 24), (None, 1, *[None] * 24), (3, None, *[2] * 24)]
    kinds = {"a": "bigint", "b": "int", "c": "smallint", "d": "int"}
    df = spark.createDataFrame(rows, "h bigint, g int, " + ", ".join(f"{c} bigint" for c in names)).selectExpr(
        "h", "g", *[f"CAST({c} AS {kinds[c[2]]}) AS {c}" for c in names]).repartition(5)
    plain = df.withColumns({c: F.col(c).cast("double") for c in names if c[2] != "a"})
    found = lambda table: labour_hours(table, "h", "m", tasks, 3, plot="g")
    told = lambda out: sorted(map(repr, out.collect()))
    assert found(df).schema == found(plain).schema and told(found(df)) == told(found(plain)) and len(told(found(df))) > 10
    for none in (df.limit(0), df.withColumns({c: F.lit(None).cast("int") for c in names})):
        assert found(none).count() == 0
    # Ids too far apart for a word are sorted as they are.
    far = df.withColumn("q1a1", F.when(F.col("g") == 2, (1 << 63) - 1).when(F.col("g") == 3, -(1 << 63)))
    assert told(found(far)) == told(found(far.withColumns({c: F.col(c).cast("double") for c in names if c[2] == "b"})))
    sorts = [line for line in found(df)._jdf.queryExecution().executedPlan().toString().splitlines() if " Sort [" in line and "words" in line]
    assert sorts and not any("a_one" in line for line in sorts)


def test_component_of_columns_far_from_zero(spark):
    """Means of 1e9 around spreads of 1e-3, which the doubles themselves hold to some 1e-4, and a column without variation."""
    from fractions import Fraction

    random = np.random.default_rng(11)
    base = random.normal(size=3000)
    data = np.column_stack([1e9 + 1e-3 * (base + random.normal(size=3000)), -1e9 + 1e-3 * (base - random.normal(size=3000)),
                            5 + base, np.full(3000, 1e9 + 0.1)])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "i int, a double, b double, c double, d double").repartition(7)
    # Exact means, then exact differences: what is left is rounded once.
    centred = np.array([[float(Fraction(x) - m) for x in data[:, j]] for j in range(4) for m in [sum(map(Fraction, data[:, j])) / 3000]]).T
    z = centred[:, :3] / np.sqrt((centred[:, :3] ** 2).sum(0) / 2999)
    vector = np.linalg.eigh(z.T @ z / 2999)[1][:, -1]
    vector *= np.sign(vector[np.abs(vector).argmax()])
    found = principal_component(df, ["a", "b", "c", "d"])
    assert np.allclose(found.loadings[:3], vector, rtol=1e-10, atol=1e-10) and found.deviations[3] == 0
    out = {r.i: r.asset_index for r in asset_index(df, ["a", "b", "c", "d"]).collect()}
    assert np.abs(np.array([out[i] for i in range(3000)]) - z @ vector).max() < 1e-8


def test_index_is_fitted_in_one_pass(spark):
    from kinfold.operators import wealth

    df = spark.range(0, 1000, 1, 6).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 3).alias("w"))
    counter = spark.sparkContext.accumulator(0)
    seen = df.mapInPandas(lambda frames: (counter.add(len(f)) or f for f in frames), df.schema)
    moments = wealth.column_moments(seen, ["a", "b"], "w")
    assert counter.value == 1000 and moments.weight == sum(i % 3 for i in range(1000))
    nothing = wealth.column_moments(df.filter("a > 2"), ["a", "b"])
    assert nothing is None and asset_index(df.filter("a > 2"), ["a", "b"]).count() == 0

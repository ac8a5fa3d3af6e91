import numpy as np
import pytest
from pyspark.sql import functions as F

from frames import frame, rows
from kinfold.operators import evaluate
from kinfold.plans.evaluation import evaluate_model
from kinfold.session import shared_dir
from kinfold.sources.predictions import load_predictions, model_name, store_predictions

SCHEMA = "model_name string, id int, y_true int, y_pred int, y_prob double, weight double"


def by_hand(y, guess, p, w):
    """Metrics from their definitions, one threshold at a time."""
    y, guess, p, w = map(np.asarray, (y, guess, p, w))
    tp, fp = w[(y == 1) & (guess == 1)].sum(), w[(y == 0) & (guess == 1)].sum()
    fn, tn = w[(y == 1) & (guess == 0)].sum(), w[(y == 0) & (guess == 0)].sum()
    agree, n = (y == guess).mean(), len(y)
    chance = (y == 1).mean() * (guess == 1).mean() + (y == 0).mean() * (guess == 0).mean()
    clipped = np.clip(p, 1e-15, 1 - 1e-15)
    pairs = [(wi * wj, (pi > pj) + 0.5 * (pi == pj)) for pi, wi in zip(p[y == 1], w[y == 1])
             for pj, wj in zip(p[y == 0], w[y == 0])]
    recall, precision = [0.0], [1.0]
    for t in sorted(set(p), reverse=True):
        hit, miss = w[(p >= t) & (y == 1)].sum(), w[(p >= t) & (y == 0)].sum()
        recall.append(hit / w[y == 1].sum())
        precision.append(hit / (hit + miss))
    aupr = sum((b - a) * (c + d) / 2 for a, b, c, d in zip(recall, recall[1:], precision, precision[1:]))
    return {
        "accuracy": (tp + tn) / w.sum(), "precision": tp / (tp + fp), "recall": tp / (tp + fn),
        "f1": 2 * tp / (2 * tp + fp + fn), "cohen_kappa": (agree - chance) / (1 - chance),
        "cross_entropy": -(w * np.where(y == 1, np.log(clipped), np.log(1 - clipped))).sum() / w.sum(),
        "roc_auc": sum(a * b for a, b in pairs) / sum(a for a, _ in pairs), "aupr": aupr,
    }


@pytest.fixture(scope="module")
def scored(spark):
    random = np.random.default_rng(11)
    table, expected = [], {}
    for model in ("a", "b"):
        y = random.integers(0, 2, 150)
        p = np.round(np.clip(0.3 * y + random.random(150) * 0.7, 0, 1), 2)
        p[0], p[1] = 0.0, 1.0
        w = random.integers(1, 6, 150).astype(float)
        guess = (p > 0.5).astype(int)
        expected[model] = by_hand(y, guess, p, w)
        table += [(model, i, int(y[i]), int(guess[i]), float(p[i]), float(w[i])) for i in range(150)]
    table += [("classes", i, i % 2, int(i % 3 > 0), None, None) for i in range(30)]
    return spark.createDataFrame(table, SCHEMA), expected


def test_metrics(scored):
    predictions, expected = scored
    found = {r.model_name: r.asDict() for r in evaluate.all_metrics(predictions).collect()}
    for model, metrics in expected.items():
        assert {m: found[model][m] for m in metrics} == pytest.approx(metrics)
    assert found["classes"]["roc_auc"] is None and found["classes"]["cross_entropy"] is None
    assert found["classes"]["accuracy"] == pytest.approx(0.5)


def test_confusion_weights_sum_to_all_weights(scored):
    predictions, _ = scored
    total = evaluate.confusion_matrix(predictions).groupBy("model_name").agg(F.sum("weight").alias("w"))
    weights = predictions.groupBy("model_name").agg(F.sum(F.coalesce("weight", F.lit(1.0))).alias("w"))
    assert rows(total) == rows(weights)
    first = evaluate.confusion_matrix(predictions).filter("model_name = 'classes'").collect()
    assert [(r.true_label, r.predicted_label) for r in first] == [(1, 1), (1, 0), (0, 1), (0, 0)]


def test_curves_run_from_corner_to_corner(scored):
    predictions, _ = scored
    roc = evaluate.roc_points(predictions).filter("model_name = 'a'").orderBy(F.desc_nulls_first("threshold")).collect()
    assert (roc[0].fpr, roc[0].tpr) == (0.0, 0.0) and (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    assert all(x.tpr <= y.tpr and x.fpr <= y.fpr for x, y in zip(roc, roc[1:]))
    pr = evaluate.pr_points(predictions).filter("model_name = 'a' AND threshold IS NULL").collect()
    assert [(r.recall, r.precision) for r in pr] == [(0.0, 1.0)]


def test_equal_scores_give_half(spark):
    df = frame(spark, SCHEMA, *[("m", i, i % 2, 1, 0.4, 1.0) for i in range(10)])
    areas = evaluate.curve_areas(df).first()
    assert areas.roc_auc == 0.5


def test_undefined_ratios(spark):
    never = frame(spark, SCHEMA, ("m", 1, 1, 0, None, 1.0), ("m", 2, 0, 0, None, 1.0))
    found = evaluate.class_metrics(never).first()
    assert (found.precision, found.recall, found.f1) == (0.0, 0.0, 0.0)


def test_comparison(scored):
    predictions, expected = scored
    table = evaluate.model_comparison(evaluate.all_metrics(predictions)).collect()
    assert [r.model_name for r in table] == [r.model_name for r in sorted(table, key=lambda r: (r.mean_rank, r.model_name))]
    best = {r.model_name: r.best_cross_entropy for r in table}
    lower = min(expected, key=lambda m: expected[m]["cross_entropy"])
    assert best == {m: m == lower for m in ("a", "b", "classes")}
    alone = evaluate.ranked_scores(evaluate.all_metrics(predictions.filter("model_name = 'a'")))
    assert not any(r.is_best for r in alone.collect())
    bars = evaluate.precision_recall_table(evaluate.model_comparison(evaluate.all_metrics(predictions)))
    assert [r.model_name for r in bars.collect()] == [r.model_name for r in
                                                      sorted(table, key=lambda r: (-r.mean_rank, r.model_name))]


def test_score_table(scored):
    predictions, expected = scored
    table = {r.metric: r for r in evaluate.score_table(evaluate.all_metrics(predictions), ["a", "b"]).collect()}
    assert set(table) == set(evaluate.REPORTED)
    assert table["f1"].a == pytest.approx(expected["a"]["f1"])


def test_names():
    assert [model_name(), model_name("m"), model_name(prefix="p"), model_name("m", "p")] == ["score", "m", "p_score", "p_m"]


def test_store_replaces_one_model_and_keeps_the_others(spark, scored, tmp_path):
    predictions, _ = scored
    path = str(tmp_path / "stored")
    store_predictions(predictions, path, features=["x", "y"])
    store_predictions(predictions.filter("model_name = 'a' AND id < 10"), path)
    stored = load_predictions(spark, path)
    assert rows(stored.groupBy("model_name").count()) == [("a", 10), ("b", 150), ("classes", 30)]
    assert load_predictions(spark, path, ["b"]).first().features == ["x", "y"]
    assert stored.filter("stored_at IS NULL").count() == 0
    numbered = predictions.filter("model_name = 'b'").withColumn("model_name", F.lit("01"))
    store_predictions(numbered, path)
    assert load_predictions(spark, path, ["01"]).count() == 150


def test_evaluate_against_stored(spark, scored, tmp_path):
    predictions, expected = scored
    path = str(tmp_path / "models")
    store_predictions(predictions.filter("model_name = 'b'"), path)
    new = predictions.filter("model_name = 'a'").drop("model_name")
    result = evaluate_model(new, name="a", prefix="run", compare_with=["b"], path=path, store=True)
    assert result.name == "run_a"
    found = {r.model_name: r.roc_auc for r in result.metrics.collect()}
    assert found == pytest.approx({"run_a": expected["a"]["roc_auc"], "b": expected["b"]["roc_auc"]})
    assert load_predictions(spark, path, ["run_a"]).count() == 150
    bare = evaluate_model(new.drop("y_prob", "weight"))
    assert bare.name == "score" and bare.metrics.first().roc_auc is None


def test_shared_folder_is_stable(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_unnamed_models_odd_scores_and_odd_labels(spark, scored):
    """A model without a name is evaluated like the others; NaN scores and labels other than 0 and 1 stay out."""
    predictions, expected = scored
    unnamed = predictions.filter("model_name = 'a'").withColumn("model_name", F.lit(None).cast("string"))
    odd = spark.createDataFrame([(None, 900, 1, 1, float("nan"), 0.0), (None, 901, 2, 1, 0.9, 3.0), (None, 902, None, 1, 0.9, 3.0)],
                                SCHEMA)
    for partitions in ("2", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found = evaluate.all_metrics(predictions.union(unnamed).union(odd)).filter("model_name IS NULL").collect()
        assert len(found) == 1
        for metric in ("roc_auc", "aupr", "precision", "recall", "cross_entropy"):
            assert found[0][metric] == pytest.approx(expected["a"][metric])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert evaluate.roc_points(unnamed).count() == evaluate.roc_points(predictions).filter("model_name = 'a'").count()


def test_states_give_the_same_metrics(spark, scored):
    predictions, _ = scored
    parts = [predictions.filter(f"id % 3 = {k}") for k in range(3)]
    state = evaluate.collapse(parts[0])
    for part in parts[1:]:
        state = evaluate.collapse(state.unionByName(evaluate.collapse(part)))
    for plain, merged in zip(*[[r.asDict() for r in evaluate.all_metrics(p).orderBy("model_name").collect()] for p in (predictions, state)]):
        assert plain.keys() == merged.keys()
        for key, value in plain.items():
            assert merged[key] == (value if value is None or isinstance(value, str) else pytest.approx(value, rel=1e-12))
    points = lambda p: [r for r in evaluate.roc_points(p).orderBy("model_name", "threshold").collect()]
    assert [r.threshold for r in points(predictions)] == [r.threshold for r in points(state)]


def test_comparison_reads_states_only(spark, scored, tmp_path):
    predictions, expected = scored
    path = str(tmp_path / "models")
    for k in range(10):
        store_predictions(predictions.filter("model_name = 'b'").withColumn("model_name", F.lit(f"m{k}")), path)
    new = predictions.filter("model_name = 'a'").drop("model_name")
    result = evaluate_model(new, name="a", compare_with=[f"m{k}" for k in range(10)], path=path, store=True)
    for df in (result.metrics, result.roc, result.pr, result.confusion):
        assert df.inputFiles() and all("/models_states/" in f for f in df.inputFiles())
    found = {r.model_name: r.roc_auc for r in result.metrics.collect()}
    assert found == pytest.approx({"a": expected["a"]["roc_auc"], **{f"m{k}": expected["b"]["roc_auc"] for k in range(10)}})


def test_states_of_other_storings_do_not_count(spark, scored, tmp_path):
    from kinfold.sources import predictions as store

    given, expected = scored
    path = str(tmp_path / "models")
    store_predictions(given.filter("model_name IN ('a', 'b')"), path)
    # As if the job had been lost between predictions and states.
    late = given.filter("model_name = 'b'").withColumns({"model_name": F.lit("a"), "features": F.lit(None).cast("array<string>"),
                                                         "stored_at": F.current_timestamp()})
    store._replace_models(late, path)
    for m, wanted in (("a", "b"), ("b", "b")):
        found = evaluate.all_metrics(store.load_states(spark, path, [m])).head()
        assert found.roc_auc == pytest.approx(expected[wanted]["roc_auc"])


@pytest.mark.parametrize("error", [0.05, 0.005])
def test_bounded_curves(spark, error):
    from kinfold.operators.curves import bounded_curve, curve_bins, curve_bounds, curve_points, merged_bins

    predictions = spark.range(0, 20000, 1, 6).select(
        F.when(F.col("id") % 2 == 0, "skewed").when(F.col("id") % 7 > 0, "few").alias("model_name"), "id",
        (F.pmod(F.xxhash64("id"), F.lit(10)) < F.lit(3)).cast("int").alias("y_true"), F.lit(1).alias("y_pred"),
        F.when(F.col("id") % 2 == 0, F.pow(F.rand(3), F.lit(8.0)) + F.pmod(F.xxhash64("id"), F.lit(10)) / 50.0)
        .otherwise(F.round(F.rand(5), 2)).alias("y_prob"),
        F.when(F.col("id") % 100 == 0, 50.0).when(F.col("id") % 3 == 0, None).otherwise(F.rand(7)).alias("weight")).cache()
    exact = {r.model_name: r for r in evaluate.curve_areas(predictions).collect()}
    curve = bounded_curve(predictions, error)
    models = {r.model_name: r for r in curve.collect()}
    assert set(models) == {"skewed", "few", None}
    for name, r in models.items():
        assert r.roc_error <= error and r.aupr_error <= error
        assert abs(r.roc_auc - exact[name].roc_auc) <= r.roc_error + 1e-12
        assert abs(r.aupr - exact[name].aupr) <= r.aupr_error + 1e-12
    # Scores of two digits: every point is there, and exact.
    assert models["few"].roc_error == 0 and models["few"].roc_auc == pytest.approx(exact["few"].roc_auc)
    # Every point of the short curve is one of the long one.
    long = {(r.model_name, r.threshold): (r.fpr, r.tpr) for r in evaluate.roc_points(predictions).collect()}
    for r in curve.filter("threshold IS NOT NULL").collect():
        assert long[r.model_name, r.threshold] == pytest.approx((r.fpr, r.tpr))
    if error > 0.01:
        assert curve.count() < len(long) / 2
    # Curves of parts of the records, put together.
    bounds = curve_bounds(predictions, 50)
    halves = [curve_bins(predictions.filter(f"id % 4 IN ({k}, {k + 1})"), bounds) for k in (0, 2)]
    whole = {r.model_name: r for r in curve_points(curve_bins(predictions, bounds)).collect()}
    merged = {r.model_name: r for r in curve_points(merged_bins(halves[0].unionByName(halves[1]))).collect()}
    for name in whole:
        assert (merged[name].roc_auc, merged[name].roc_error) == pytest.approx((whole[name].roc_auc, whole[name].roc_error))
    assert bounded_curve(predictions.limit(0)).count() == 0

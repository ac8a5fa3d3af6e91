import pytest
from pyspark.sql import functions as F

from frames import frame, rows, values
from kinfold.operators.dedup import distinct_rows, first_per_key, least_row
from kinfold.operators.evaluate import histogram, split_features
from kinfold.operators.filters import drop_all_missing, drop_any_missing, drop_minor_nulls, null_counts
from kinfold.operators.groups import attach, frequency
from kinfold.operators.merge import (duplicate_keys, merge, parent_lookup, require_unique, with_suffix)
from kinfold.operators.ranking import feature_ranking, flag_smallest_abs, importance_table, sorted_importances
from kinfold.operators.reshape import to_long, to_wide, to_wide_flags
from kinfold.sources.labels import caption_of, codes_to_text, dictionary_rows, load_labelled, with_captions


def test_merge_indicator_counts_every_row_once(spark):
    base = frame(spark, "k int, a string", (1, "x"), (1, "y"), (2, "z"))
    lookup = frame(spark, "k int, b string", (1, "p"), (3, "q"))
    out = merge(base, lookup, "k", keep="all", indicator="_merge")
    assert rows(out) == [(1, "x", "p", 3), (1, "y", "p", 3), (2, "z", None, 1), (3, None, "q", 2)]
    assert rows(merge(base, lookup, "k", keep="matched", indicator="_merge")) == [(1, "x", "p", 3), (1, "y", "p", 3)]
    assert values(merge(base, lookup, "k", indicator="m"), "m", "a") == [3, 3, 1]
    assert merge(base, lookup, "k").count() == 3


def test_base_columns_win(spark):
    base = frame(spark, "k int, a int", (1, 10))
    lookup = frame(spark, "k int, a int, b int", (1, 99, 5))
    assert rows(merge(base, lookup, "k")) == [(1, 10, 5)]


def test_missing_keys_match_each_other_on_request(spark):
    base = frame(spark, "h int, k int", (1, None), (1, 2))
    lookup = frame(spark, "h int, k int, v string", (1, None, "none"), (1, 3, "three"))
    assert values(merge(base, lookup, ["h", "k"], null_safe=True), "v", "k") == ["none", None]
    assert values(merge(base, lookup, ["h", "k"]), "v", "k") == [None, None]
    out = merge(base, lookup, ["h", "k"], null_safe=True, keep="all", indicator="m")
    assert rows(out, "m") == [(1, 2, None, 1), (1, 3, "three", 2), (1, None, "none", 3)]


def test_key_contract(spark):
    twice = frame(spark, "k int, v int", (1, 1), (1, 2), (2, 3))
    assert rows(duplicate_keys(twice, "k")) == [(1, 2)]
    with pytest.raises(Exception, match="key is not unique"):
        require_unique(twice, "k").collect()
    with pytest.raises(Exception, match="key is not unique"):
        merge(twice, twice.withColumnRenamed("v", "w"), "k", validate=True).collect()
    lookup = frame(spark, "k int, w int", (1, 5), (2, 6))
    assert merge(twice, lookup, "k").count() == 3
    with pytest.raises(Exception, match="key is not unique"):
        merge(twice, lookup, "k", one_to_one=True).collect()
    once = frame(spark, "k int, v int", (1, 1), (2, None))
    assert rows(require_unique(once, "k")) == [(1, 1), (2, None)]


def test_suffix_spares_keys(spark):
    assert with_suffix(frame(spark, "k int, a int", (1, 2)), "_19", ["k"]).columns == ["k", "a_19"]


def test_parent_lookup(spark):
    people = frame(spark, "h int, id int, father int, job string", (1, 1, None, "a"), (1, 2, 1, "b"), (1, 3, 9, "c"),
                   (2, 1, 1, "d"))
    out = parent_lookup(people, "h", "id", "father", ["job"], "_father", ["job"])
    assert values(out, "job_father", "h", "id") == [None, "a", None, "d"]


def test_first_row_per_key(spark):
    df = frame(spark, "k int, a int, b string", (1, 2, "x"), (1, 1, "y"), (2, None, "z"))
    assert rows(first_per_key(df, ["k"], ["a"])) == [(1, 1, "y"), (2, None, "z")]
    assert rows(least_row(df, ["k"])) == [(1, 1, "y"), (2, None, "z")]
    with pytest.raises(ValueError):
        first_per_key(df, ["k"], [])
    assert rows(distinct_rows(df, ["k"])) == [(1,), (2,)]


def test_group_values_on_every_row(spark):
    df = frame(spark, "g int, x int", (1, 1), (1, None), (2, None))
    out = attach(df, ["g"], {"n": F.count("*"), "top": F.max("x")})
    assert rows(out, "g", "x") == [(1, None, 2, 1), (1, 1, 2, 1), (2, None, 1, None)]
    assert rows(frequency(df, "g")) == [(1, 2), (2, 1)]


def test_reshape(spark):
    long = frame(spark, "h int, item int, v int", (1, 501, 1), (1, 502, 2), (2, 501, None))
    wide = to_wide(long, ["h"], "item", ["v"], [501, 502], validate=True)
    assert wide.columns == ["h", "v501", "v502"]
    assert rows(wide, "h") == [(1, 1, 2), (2, None, None)]
    back = to_long(wide, ["h"], {"v": "v"}, [501, 502], "item")
    assert rows(back, "h", "item") == [(1, 501, 1), (1, 502, 2), (2, 501, None), (2, 502, None)]
    repeated = long.union(long)
    with pytest.raises(Exception, match="key is not unique"):
        to_wide(repeated, ["h"], "item", ["v"], [501, 502]).collect()
    with pytest.raises(Exception, match="code that is not listed: 502"):
        to_wide(long, ["h"], "item", ["v"], [501]).collect()
    assert to_wide(long, ["h"], "item", ["v"], [501], ignored=[502]).columns == ["h", "v501"]
    with pytest.raises(Exception, match="code that is not listed"):
        to_wide_flags(long, ["h"], "item", [501], "f").collect()


def test_several_stubs_and_text_suffixes(spark):
    wide = frame(spark, "h int, xa int, xb int, ya string, yb string", (1, 1, None, "p", None))
    assert rows(to_long(wide, ["h"], {"x": "x", "y": "label"}, ["a", "b"], "j"), "j") == [(1, "a", 1, "p"), (1, "b", None, None)]


def test_flags_with_and_without_the_unrecoded_code(spark):
    df = frame(spark, "e int, c int", (1, 6), (1, 7), (2, 6))
    assert rows(to_wide_flags(df, ["e"], "c", [6, 7], "s"), "e") == [(1, 1, 1), (2, 1, None)]
    assert rows(to_wide_flags(df, ["e"], "c", [6, 7], "s", keep_code=[7]), "e") == [(1, 1, 7), (2, 1, None)]


def test_null_filters(spark):
    df = frame(spark, "a int, b int, c int", (1, None, 1), (None, None, 2), (3, 4, 3))
    assert rows(null_counts(df), "column_name") == [("a", 1), ("b", 2), ("c", 0)]
    assert [r[0] for r in null_counts(df).collect()] == ["b", "a", "c"]
    assert drop_minor_nulls(df, limit=2).count() == 2
    assert drop_minor_nulls(df, limit=3).count() == 1
    assert drop_all_missing(df, ["a", "b"]).count() == 2
    assert drop_any_missing(df, ["a", "b"]).count() == 1


def test_labels(spark):
    dictionary = dictionary_rows(spark, {"s": {1: "one", 2: "two"}})
    df = frame(spark, "id int, s int, v int", (1, 1, 5), (2, 9, 5), (3, None, 5), (4, 2, None))
    assert rows(codes_to_text(df, dictionary, ["s"]), "id") == [(1, "one", 5), (3, None, 5), (4, "two", None)]
    loaded = load_labelled(df, dictionary, ["s"], index=["id"], drop_minor=True)
    assert rows(loaded, "id") == [(1, "one", 5)]
    assert load_labelled(df, dictionary, ["s"], index=["id"]).count() == 3
    captioned = with_captions(df, {"v": "Value"})
    assert caption_of(captioned, "v") == "Value" and caption_of(captioned, "s") is None


def test_histogram(spark):
    df = frame(spark, "t int, x double", (0, 0.0), (0, 1.5), (1, 3.0), (1, 5.0), (1, None))
    assert rows(histogram(df, "x", "t")) == [(0, 0, 1), (0, 1, 1), (1, 3, 1), (1, 5, 1)]
    # Edges -1 … 3; the last bin takes its upper edge, 5 falls outside.
    assert rows(histogram(df, "x", "t", compat_edges=True)) == [(0, 0, 1), (0, 1, 1), (1, 2, 1)]


def test_split(spark):
    df = frame(spark, "a int, dropout int, panelweight_2016 double", (1, 0, 2.0))
    assert [f.columns for f in split_features(df)] == [["a"], ["dropout"], ["panelweight_2016"]]


def test_smallest_absolute_value(spark):
    df = frame(spark, "i int, a double, b double", (1, -1.0, 5.0), (2, 2.0, -3.0), (3, None, 9.0))
    flagged = flag_smallest_abs(df, ["a", "b"]).select("i", "is_min_a", "is_min_b")
    assert rows(flagged) == [(1, True, False), (2, False, True), (3, False, False)]
    whole = flag_smallest_abs(df, ["a", "b"], whole_table=True).select("i", "is_min_a", "is_min_b")
    assert rows(whole) == [(1, True, False), (2, False, False), (3, False, False)]


def test_importance_table(spark):
    out = importance_table(spark, [0.1, 0.7, 0.2], ["a", "b", "c"])
    assert [tuple(r) for r in out.collect()] == [("b", 0.7), ("c", 0.2), ("a", 0.1)]
    assert [r.feature for r in importance_table(spark, [0.1, 0.7], sort=False).collect()] == ["0", "1"]


def test_feature_ranking(spark):
    df = frame(spark, "model string, feature string, importance double, abs double",
               ("m", "x", 3.0, 1.0), ("m", "y", 1.0, 9.0), ("m", "z", 1.0, 5.0),
               ("n", "x", None, 2.0), ("n", "y", None, 4.0))
    out = feature_ranking(df, ["m", "n"])
    assert [tuple(r) for r in out.collect()] == [("x", 1.0, 2.0, 1.5, 2), ("y", 2.5, 1.0, 1.75, 2), ("z", 2.5, None, 2.5, 1)]
    assert values(sorted_importances(df.filter("model = 'm'"), "importance", "feature").limit(1), "feature") == ["x"]


def test_minor_nulls_by_share(spark):
    df = frame(spark, "a int, b int", *[(None if i == 0 else i, None if i % 2 else i) for i in range(100)])
    assert drop_minor_nulls(df, limit=None, share=0.05).count() == 99
    assert drop_minor_nulls(df, share=0.6).count() == 49
    assert drop_minor_nulls(df, limit=51, share=0.6).count() == 49


def test_repeated_dictionary_code_fails(spark):
    labels = dictionary_rows(spark, {"c": {1: "one"}})
    with pytest.raises(Exception, match="key is not unique"):
        codes_to_text(frame(spark, "c int", (1,)), labels.union(labels), ["c"]).collect()


def run(df):
    df.write.format("noop").mode("overwrite").save()


def test_merge_report(spark):
    from kinfold.operators.merge import COUNTS, merge_report

    base = frame(spark, "k int, a string", (1, "x"), (1, "y"), (2, "z"), (None, "n"))
    lookup = frame(spark, "k int, b string", (1, "p"), (3, "q"), (None, "m"))
    with merge_report() as report:
        run(merge(base, lookup, "k", name="left"))
        run(merge(base, lookup, "k", keep="all", name="all"))
        run(merge(base, lookup, "k", keep="matched", name="matched"))
        run(merge(base.filter("a <> 'y'"), lookup, "k", one_to_one=True, name="single"))
        run(merge(base, lookup, "k"))  # without a name
        late = merge(base, lookup, "k", name="late")
    counts = {name: tuple(own.values()) for name, own in report.counts().items()}
    assert list(report.counts()["left"]) == list(COUNTS)
    assert counts == {
        "left": (4, 3, 2, 2, None, None, 0), "all": (4, 3, 2, 2, 2, None, 0), "matched": (4, 3, 2, 2, None, None, 0),
        "single": (3, 3, 1, 2, 2, 0, 0), "late": (None,) * 7}
    run(late)
    assert tuple(report.counts()["late"].values()) == counts["left"]
    assert rows(report.frame(spark).select("merge", "matched")) == [("all", 2), ("late", 2), ("left", 2), ("matched", 2), ("single", 1)]


def test_merge_report_counts_repeats(spark):
    from kinfold.operators.merge import merge_report

    base = frame(spark, "k int, a string", (1, "x"), (1, "y"), (2, "z"))
    lookup = frame(spark, "k int, b string", (1, "p"), (1, "q"), (1, "r"))
    with merge_report() as report:
        out = merge(base, lookup, "k", validate="count", one_to_one=True, name="m")
        assert out.count() == 7
    own = report.counts()["m"]
    assert (own["base_rows"], own["lookup_rows"], own["base_repeats"], own["lookup_repeats"]) == (3, 3, 1, 2)


def test_merge_report_costs_no_exchange(spark):
    from kinfold.catalog.survey import survey_tables
    from kinfold.operators.merge import merge_report
    from kinfold.plans.child_sample import people_table

    tables = survey_tables(spark, "/root/testdata/sf0.001")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    plain = exchanges(people_table(tables))
    with merge_report():
        assert exchanges(people_table(tables)) == plain


def test_repeated_member_stops_the_plot_merge(spark):
    people = frame(spark, "h int, m int", (1, 1), (1, 1))
    hours = frame(spark, "h int, m int, x double", (1, 1, 2.0))
    with pytest.raises(Exception, match="key is not unique"):
        run(merge(people, hours, ["h", "m"], one_to_one=True, split_hot=False))

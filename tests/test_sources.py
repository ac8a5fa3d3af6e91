"""Labelled survey files and tables replaced as a whole."""

import datetime as dt
import math
import os
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinfold.sources import dta_layout
from kinfold.sources.dta import layouts, read_survey_file, value_labels, write_survey_file
from kinfold.sources.labels import caption_of, codes_to_text
from kinfold.sources.tables import overwrite_table, read_table, settle_table, table_exists, write_table
from tests.frames import frame, rows

SMALL = "/root/testdata/sf0.001"


def sample(n=500):
    rng = np.random.default_rng(4)
    return pd.DataFrame({
        "id": np.arange(n, dtype=np.int32), "age": rng.integers(0, 90, n).astype(np.int8), "year": rng.integers(1900, 2020, n).astype(np.int16),
        "weight": rng.normal(0, 1e6, n), "share": rng.random(n).astype(np.float32),
        "name": [f"näme {i % 7}" if i % 5 else "" for i in range(n)],
        "seen": pd.to_datetime("1955-06-01") + pd.to_timedelta(rng.integers(0, 30000, n), "D")})


def expected_rows(pdf):
    out = []
    for r in pdf.itertuples(index=False):
        out.append((r.id, r.age, r.year, r.weight, float(r.share), r.name or None, r.seen.date()))
    return out


@pytest.mark.parametrize("version", [114, 117, 118, 119])
@pytest.mark.parametrize("partition_bytes", [100, 5000, 1 << 20])
def test_files_of_another_writer(spark, tmp_path, version, partition_bytes):
    pdf = sample()
    if version == 114:
        pdf["name"] = pdf["name"].str.replace("ä", "a")
    path = f"{tmp_path}/survey.dta"
    pdf.to_stata(path, version=version, write_index=False, convert_dates={"seen": "td"},
                 variable_labels={"age": "age in years"}, value_labels={"year": {1999: "last", 2000: "first"}})
    found = read_survey_file(spark, path, partition_bytes=partition_bytes)
    assert dict(found.dtypes) == {"id": "int", "age": "int", "year": "int", "weight": "double", "share": "double",
                                  "name": "string", "seen": "date"}
    assert rows(found, "id") == expected_rows(pdf)
    assert caption_of(found, "age") == "age in years" and caption_of(found, "id") is None
    assert rows(value_labels(spark, path)) == [("year", 1999, "last"), ("year", 2000, "first")]
    assert found.rdd.getNumPartitions() == (1 if partition_bytes == 1 << 20 else
                                            -(-500 // max(1, partition_bytes // layouts(path)[0][1].row_bytes)))
    assert found.count() == 500


def test_columns_and_filters_reach_the_file(spark, tmp_path):
    pdf = sample()
    pdf["age"] = pdf["age"].where(pdf["age"] % 10 > 0).astype("Float64")
    path = f"{tmp_path}/survey.dta"
    pdf.to_stata(path, version=118, write_index=False, convert_dates={"seen": "td"})
    found = read_survey_file(spark, path, ["name", "age"], partition_bytes=2000)
    assert found.columns == ["name", "age"]
    some = found.filter("age > 30 AND age IN (31, 32, 33.0, 40) OR age IS NULL").filter("age IS NOT NULL AND age <= 32")
    plain = pdf[(pdf["age"] >= 31) & (pdf["age"] <= 32)]
    assert rows(some) == sorted(((r.name_ or None, float(r.age)) for r in plain.rename(columns={"name": "name_"}).itertuples()),
                                key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    # What the source applies itself, Spark doesn't filter again.
    plan = found.filter("age > 30")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan
    assert found.filter("name = 'näme 1'").count() == (pdf["name"] == "näme 1").sum()
    with pytest.raises(KeyError):
        read_survey_file(spark, path, ["nothing"])


def test_missing_codes(spark, tmp_path):
    """All 27 codes of every type, next to the greatest and least numbers."""
    kinds = ["byte", "int", "long", "float", "double"]
    values = {k: [dta_layout.WHOLE_RANGES[k][1], dta_layout.WHOLE_RANGES[k][0]] if k in dta_layout.WHOLE_RANGES else [1.5e38, -1.5e38] for k in kinds}
    variables, offset = [], 0
    for k in kinds:
        width = np.dtype(dta_layout.NUMPY_TYPES[k]).itemsize
        variables.append(dta_layout.Variable(k, k, width, offset, "%9.0g"))
        offset += width
    layout = dta_layout.Layout(118, "<", 29, 0, tuple(variables))
    block = np.zeros(29, layout.row_type(kinds))
    codes = np.array([-1, -1, *range(27)])
    for k in kinds:
        block[k] = dta_layout.with_missing(np.array([*values[k], *[0] * 27]), codes, k)
    before, after = dta_layout.frame_of(layout)
    path = f"{tmp_path}/codes.dta"
    with open(path, "wb") as out:
        out.write(before + block.tobytes() + after)
    found = read_survey_file(spark, path, codes=True).collect()
    for k in kinds:
        assert [r[k] for r in found[:2]] == pytest.approx(values[k]) and all(r[k] is None for r in found[2:])
        assert [r[k + "_code"] for r in found] == [None, None, *dta_layout.MISSING_CODES]
    # The usual reader agrees on the bytes.
    other = pd.read_stata(path, convert_missing=True)
    assert [str(v) for v in other["double"][2:]] == dta_layout.MISSING_CODES
    assert [str(v) for v in other["byte"][2:]] == dta_layout.MISSING_CODES


@pytest.mark.parametrize("version", [117, 118])
def test_long_texts(spark, tmp_path, version):
    texts = ["x" * 5000 + str(i) if i % 3 else ("same" if i % 2 else "") for i in range(400)]
    pdf = pd.DataFrame({"id": np.arange(400, dtype=np.int32), "text": texts})
    path = f"{tmp_path}/long.dta"
    pdf.to_stata(path, version=version, write_index=False, convert_strl=["text"])
    found = read_survey_file(spark, path, partition_bytes=1000)
    assert rows(found, "id") == [(i, t or None) for i, t in enumerate(texts)]


def test_written_files(spark, tmp_path):
    df = frame(spark, "pid bigint, hh int, small smallint, flag boolean, spend double, price decimal(10,2), day date, at timestamp, text string",
               (1 << 53, 2147483620, -32768, True, 1e300, None, dt.date(1901, 2, 3), dt.datetime(2016, 5, 1, 12, 30, 15, 250000), "é" * 3),
               (None, None, None, None, None, None, None, None, None), (-5, -2147483647, 32767, False, -0.1, Decimal(3), dt.date(2020, 1, 1), None, ""))
    path = f"{tmp_path}/out"
    labels = {"hh": {1: "one", -2: "zwei"}, "small": {5: "five"}}
    for _ in range(2):
        write_survey_file(df.withMetadata("hh", {"label": "household"}), path, {"spend": "spending, local money"}, labels)
    found = read_survey_file(spark, path)
    assert os.listdir(tmp_path) == ["out"]
    assert rows(found.select("pid", "hh", "small", "spend", "price", "day", "at", "text", F.col("flag") == 1), "pid") == [
        (None,) * 9, (-5.0, -2147483647, 32767, -0.1, 3.0, dt.date(2020, 1, 1), None, None, False),
        (float(1 << 53), 2147483620, -32768, 1e300, None, dt.date(1901, 2, 3), dt.datetime(2016, 5, 1, 12, 30, 15, 250000), "é" * 3, True)]
    assert caption_of(found, "hh") == "household" and caption_of(found, "spend") == "spending, local money"
    assert rows(value_labels(spark, path)) == [("hh", -2, "zwei"), ("hh", 1, "one"), ("small", 5, "five")]
    one = [f for f in sorted(os.listdir(path)) if f.endswith(".dta")]
    assert len(one) == df.rdd.getNumPartitions()
    # The usual reader takes the files as well.
    back = pd.concat(pd.read_stata(f"{path}/{f}", convert_categoricals=False) for f in one)
    assert len(back) == 3 and math.isclose(back["spend"].max(), 1e300)
    write_survey_file(df.limit(0), path, labels=labels)
    assert read_survey_file(spark, path).count() == 0 and value_labels(spark, path).count() == 3


@pytest.mark.parametrize("row", [((1 << 53) + 1, 0, "t"), (0, 2147483647, "t"), (0, 0, "t" * 2046)])
def test_what_the_format_cannot_hold(spark, tmp_path, row):
    path = f"{tmp_path}/out"
    write_survey_file(frame(spark, "a bigint, b int, c string", (1, 2, "old")), path)
    with pytest.raises(Exception, match="out of range|2045"):
        write_survey_file(frame(spark, "a bigint, b int, c string", row), path)
    # The old file is untouched, and nothing is left beside it.
    assert rows(read_survey_file(spark, path)) == [(1.0, 2, "old")] and os.listdir(tmp_path) == ["out"]


def test_survey_file_to_texts(spark, tmp_path):
    """A file computed from itself, and codes to texts by the file's own labels."""
    path = f"{tmp_path}/out"
    write_survey_file(frame(spark, "id int, area int", (1, 1), (2, 2), (3, None), (4, 9)), path, labels={"area": {1: "urban", 2: "rural"}})
    labels = {"area": {r.code: r.text for r in value_labels(spark, path).collect()}}
    write_survey_file(read_survey_file(spark, path).withColumn("id", F.col("id") + 10), path, labels=labels)
    read = read_survey_file(spark, path)
    assert rows(codes_to_text(read, value_labels(spark, path), ["area"]), "id") == [(11, "urban"), (12, "rural"), (13, None)]


def test_files_that_differ_or_break_off(spark, tmp_path):
    path = f"{tmp_path}/many"
    write_survey_file(frame(spark, "a int", (1,)), path)
    write_survey_file(frame(spark, "b int", (1,)), f"{tmp_path}/other")
    first, other = (next(f"{p}/{f}" for f in os.listdir(p) if f.endswith(".dta")) for p in (path, f"{tmp_path}/other"))
    with open(other, "rb") as source, open(f"{path}/z.dta", "wb") as out:
        out.write(source.read())
    with pytest.raises(ValueError, match="other columns"):
        read_survey_file(spark, path)
    with open(f"{tmp_path}/text.dta", "w") as out:
        out.write("no survey file")
    with pytest.raises(ValueError, match="not a labelled survey file"):
        read_survey_file(spark, f"{tmp_path}/text.dta")
    with pytest.raises(FileNotFoundError):
        read_survey_file(spark, f"{tmp_path}/nothing.dta")


def test_table_computed_from_itself(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_table(spark.range(100).withColumn("n", F.lit(0)), path)
    for _ in range(2):
        own = read_table(spark, path)
        overwrite_table(own.filter("id % 2 = 0").withColumns({"id": F.col("id") / 2, "n": F.col("n") + F.lit(1)}).withColumn("id", F.col("id").cast("bigint")), path)
    assert rows(read_table(spark, path)) == [(i, 2) for i in range(25)]
    assert os.listdir(tmp_path) == ["table"]


def test_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_table(spark.range(10), path)
    bad = read_table(spark, path).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        overwrite_table(bad, path)
    assert read_table(spark, path).count() == 10 and os.listdir(tmp_path) == ["table"]


def test_lost_writers_are_settled(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_table(spark.range(10), path)
    # Lost while writing.
    write_table(spark.range(3), f"{path}-staged-1")
    settle_table(spark, path)
    assert os.listdir(tmp_path) == ["table"] and read_table(spark, path).count() == 10
    # Lost between the two renames.
    os.rename(path, f"{path}-replaced-2")
    write_table(spark.range(3), f"{path}-staged-2")
    assert not table_exists(spark, path)
    settle_table(spark, path)
    assert os.listdir(tmp_path) == ["table"] and read_table(spark, path).count() == 10
    # Lost before the old table was removed.
    write_table(spark.range(3), f"{path}-replaced-3")
    settle_table(spark, path)
    assert os.listdir(tmp_path) == ["table"] and read_table(spark, path).count() == 10


LISTED = [("a", 1, "one"), ("a", 2, "two"), ("b", -3, "minus"), ("b", 7, None), ("c", 1, "unused"), ("a", None, "no code")]


@pytest.mark.parametrize("as_map", [True, False])
def test_codes_to_texts(spark, monkeypatch, as_map):
    from kinfold.sources import labels

    monkeypatch.setattr(labels, "MAP_CODES", 256 if as_map else 0)
    dictionary = frame(spark, "column_name string, code int, text string", *LISTED)
    df = frame(spark, "i int, a bigint, b double, z string", (1, 1, -3.0, "x"), (2, 2, None, "x"), (3, None, None, None),
               (4, 9, -3.0, "x"), (5, 1, 7.0, "x"), (6, 1, 1.5, "x"))
    found = codes_to_text(df, dictionary, ["b", "a"])
    assert found.columns == df.columns
    assert rows(found, "i") == [(1, "one", "minus", "x"), (2, "two", None, "x"), (3, None, None, None)]
    every = codes_to_text(df, dictionary, ["a"], drop_unlabelled=False)
    assert rows(every.select("i", "a"), "i") == [(1, "one"), (2, "two"), (3, None), (4, None), (5, "one"), (6, "one")]
    assert rows(codes_to_text(df, dictionary.limit(0), ["a"]), "i") == [(3, None, None, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) is not as_map
    twice = dictionary.unionByName(dictionary.filter("code = 2"))
    with pytest.raises(Exception, match="not unique"):
        codes_to_text(df, twice, ["a"]).collect()


def test_labelled_load_reads_its_table_once_besides_the_null_counts(spark, tmp_path):
    from kinfold.sources.labels import load_labelled

    path = f"{tmp_path}/coded"
    write_table(spark.range(1000).selectExpr("id", "id % 3 AS a", "id % 5 AS b"), path)
    dictionary = frame(spark, "column_name string, code int, text string", *[(c, i, f"t{i}") for c in "ab" for i in range(4)])
    loaded = load_labelled(read_table(spark, path), dictionary, ["a", "b"], index=["id"])
    assert loaded.count() == 800
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan

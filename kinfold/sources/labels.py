"""Value labels: a dictionary table (column_name, code, text), and labelled loading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.filters import drop_minor_nulls
from kinfold.operators.merge import require_unique

# The largest dictionary that goes to the rows as a map: codes of one column, and bytes of all texts.
MAP_CODES, MAP_BYTES = 256, 4 << 20
_TEXTS = "__texts"


def dictionary_rows(spark, labels: Mapping[str, Mapping[int, str]]) -> DataFrame:
    """A dictionary table from label texts by column."""
    rows = [(column, code, text) for column, texts in labels.items() for code, text in texts.items()]
    return spark.createDataFrame(rows, "column_name string, code int, text string")


def with_captions(df: DataFrame, captions: Mapping[str, str]) -> DataFrame:
    """Store a caption in the metadata of each column."""
    return df.select(*[
        F.col(f.name).alias(f.name, metadata={**f.metadata, "label": captions[f.name]}) if f.name in captions else F.col(f.name)
        for f in df.schema.fields])


def caption_of(df: DataFrame, column: str) -> str | None:
    return df.schema[column].metadata.get("label")


def _fits_a_map(dictionary: DataFrame) -> bool:
    """Whether a dictionary is small enough to be handed to every task, and to be looked through for every row."""
    sizes = dictionary.groupBy("column_name").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    most, size = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).head()
    return most <= MAP_CODES and size <= MAP_BYTES


def codes_to_text(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], drop_unlabelled: bool = True) -> DataFrame:
    """Replace codes by their texts.

    A row with a code that has no text is dropped; a missing code stays. A code that is
    listed twice for a column stops the job. All columns are replaced in one projection, to which the dictionary comes as a map
    per column in a scalar subquery. A dictionary beyond ``MAP_CODES`` codes for a column or ``MAP_BYTES`` of text is
    joined instead, once per column and without a hint. Which of the two it is takes a job over the dictionary.
    """
    if not columns:
        return df
    listed = dictionary.filter(F.col("column_name").isin(*columns) & F.col("code").isNotNull())
    if not _fits_a_map(listed):
        return _joined_texts(df, listed, columns, drop_unlabelled)
    once = require_unique(listed, ["column_name", "code"])
    # Codes are compared as doubles, as a join would.
    per_column = once.groupBy("column_name").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("code").cast("double"), "text"))).alias("texts"))
    maps = per_column.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "texts"))).alias("maps"))
    held = df.withColumn(_TEXTS, maps.scalar())
    text = {c: F.try_element_at(F.try_element_at(F.col(_TEXTS), F.lit(c)), F.col(c).cast("double")) for c in columns}
    if drop_unlabelled:
        held = held.filter(reduce(and_, [F.col(c).isNull() | text[c].isNotNull() for c in columns]))
    return held.select(*[text[c].alias(c) if c in text else F.col(c) for c in df.columns])


def _joined_texts(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], drop_unlabelled: bool) -> DataFrame:
    keep = []
    for column in columns:
        texts = require_unique(dictionary.filter(F.col("column_name") == column).select(
            F.col("code").alias(f"__c_{column}"), F.col("text").alias(f"__t_{column}")), f"__c_{column}")
        df = df.join(texts, df[column] == texts[f"__c_{column}"], "left")
        keep.append(F.col(column).isNull() | F.col(f"__t_{column}").isNotNull())
    if drop_unlabelled:
        df = df.filter(reduce(and_, keep))
    mapped = set(columns)
    names = [c for c in df.columns if not c.startswith(("__c_", "__t_"))]
    return df.select(*[F.col(f"__t_{c}").alias(c) if c in mapped else F.col(c) for c in names])


def load_labelled(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], index: Sequence[str] = (),
                  drop_minor: bool = False, minor_limit: int | None = 100, minor_share: float | None = None) -> DataFrame:
    """Codes to texts, optional minor-null drop, unlabelled rows dropped.

    Index columns count as keys: they come first and take no part in the null counts.
    """
    values = [c for c in df.columns if c not in index]
    if drop_minor:
        df = drop_minor_nulls(df, minor_limit, values, minor_share)
    return codes_to_text(df.select(*index, *values), dictionary, [c for c in columns if c not in index])

"""Long to wide and wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.merge import require_unique


def _listed(df: DataFrame, item: str, codes: Sequence, ignored: Sequence) -> DataFrame:
    """The same rows; the job stops at an item code that is neither listed nor named as ignored."""
    kind = df.schema[item].dataType
    message = F.concat(F.lit(f"{item} has a code that is not listed: "), F.col(item).cast("string"))
    known = F.col(item).isNull() | F.col(item).isin(*codes, *ignored)
    return df.withColumn(item, F.when(known, F.col(item)).otherwise(F.raise_error(message).cast(kind)))


def to_wide(df: DataFrame, ids: Sequence[str], item: str, values: Sequence[str], codes: Sequence,
            validate: bool = True, ignored: Sequence = ()) -> DataFrame:
    """One row per id with a column ``<value><code>`` per item code.

    The code list is given, so no job has to look for it; a code that is neither in it nor
    in ``ignored`` stops the job, and so does a repeated (id, item), unless ``validate=False``
    says that there are none. A pair that is absent is null.
    """
    df = _listed(df.select(*ids, item, *values), item, codes, ignored)
    if validate:
        df = require_unique(df, [*ids, item])
    aggregates = [
        F.max(F.when(F.col(item) == F.lit(code), F.col(v))).alias(f"{v}{code}")
        for v in values for code in codes
    ]
    return df.groupBy(*ids).agg(*aggregates)


def to_wide_flags(df: DataFrame, ids: Sequence[str], item: str, codes: Sequence, prefix: str,
                  keep_code: Sequence = (), ignored: Sequence = ()) -> DataFrame:
    """A 1/missing column per item code; a code neither listed nor ``ignored`` stops the job.

    Codes in ``keep_code`` hold the code itself instead of 1, as a column that was
    never recoded would.
    """
    df = _listed(df, item, codes, ignored)
    aggregates = [
        F.max(F.when(F.col(item) == F.lit(code), F.lit(code if code in keep_code else 1))).alias(f"{prefix}{code}")
        for code in codes
    ]
    return df.groupBy(*ids).agg(*aggregates)


def to_long(df: DataFrame, ids: Sequence[str], stubs: Mapping[str, str], suffixes: Sequence, name: str) -> DataFrame:
    """One row per id and suffix, all stubs together; rows with only missing values stay.

    ``stubs`` maps the wide column prefix to the long column name; the suffix is put
    in ``name``. A narrow operation: rows are multiplied in place, nothing moves.
    """
    cells = F.array(*[
        F.struct(F.lit(s).alias(name), *[F.col(f"{stub}{s}").alias(out) for stub, out in stubs.items()])
        for s in suffixes
    ])
    return df.select(*ids, F.inline(cells))

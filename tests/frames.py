"""Small frames and row helpers for the tests."""


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (nulls first)."""
    found = [tuple(r) for r in df.collect()]
    places = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted(found, key=lambda r: [(r[i] is not None, r[i]) for i in places])


def values(df, column, *order):
    place = df.columns.index(column)
    return [r[place] for r in rows(df, *order)]

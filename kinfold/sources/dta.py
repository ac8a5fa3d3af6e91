"""Labelled survey files (.dta) as a partitioned Spark source and sink.

A file's rows have one width, so any range of rows can be read by itself: header and label blocks are read once, ranges
become partitions, and each task maps its bytes onto a row type that holds the wanted columns only. Filters on numbers are
applied to these before anything becomes Arrow. The format's 27 missing codes become nulls, on request with the code
beside them.

Files are opened through Arrow's file systems in the tasks, so they have to lie in a store that Arrow knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
    StringType, StructField, StructType, TimestampType)

from kinfold.sources import dta_layout as dta
from kinfold.sources.dta_layout import Layout, Variable
from kinfold.sources.labels import dictionary_rows
from kinfold.sources.tables import remove_folder, replace_folder

FORMAT = "dta"
PARTITION_BYTES = 64 << 20
BATCH_ROWS = 16_384
# Days and milliseconds of the format begin with 1960.
EPOCH_DAYS = -3653
CODE_SUFFIX = "_code"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def data_files(path: str) -> list[str]:
    """The file itself, or the .dta files of a folder by name; hidden ones and those under way are left out."""
    store, place = open_store(path.removeprefix("file:") if path.startswith("file:/") and "://" not in path else path)
    info = store.get_file_info(place)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    names = [f.base_name for f in store.get_file_info(pafs.FileSelector(place)) if f.type == pafs.FileType.File]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(names) if n.endswith(".dta") and n[0] not in "._"]


def layout_of(path: str) -> Layout:
    store, place = open_store(path)
    with store.open_input_file(place) as source:
        return dta.read_layout(source, source.size())


def layouts(path: str) -> list[tuple[str, Layout]]:
    """The layouts of all files of a path, which have to agree in names and kinds of columns and in label texts."""
    files = data_files(path)
    if not files:
        raise FileNotFoundError(f"no .dta file in {path}")
    with ThreadPoolExecutor(16) as threads:
        found = list(threads.map(layout_of, files))
    texts: dict[tuple[str, int], str] = {}
    for file, own in zip(files, found):
        if [(v.name, column_type(v)) for v in own.variables] != [(v.name, column_type(v)) for v in found[0].variables]:
            raise ValueError(f"{file} has other columns than {files[0]}")
        for name, labels in own.labels.items():
            for code, text in labels.items():
                if texts.setdefault((name, code), text) != text:
                    raise ValueError(f"{file} has another text for code {code} of {name} than the files before it")
    return list(zip(files, found))


def column_type(variable: Variable) -> DataType:
    if variable.kind in ("str", "strL"):
        return StringType()
    if variable.is_date:
        return DateType()
    if variable.is_time:
        return TimestampType()
    return IntegerType() if variable.kind in dta.WHOLE_RANGES else DoubleType()


def schema_of(layout: Layout, codes: bool = False) -> StructType:
    """Columns with their captions and the names of their value labels as metadata."""
    fields = []
    for v in layout.variables:
        notes = {"label": v.caption, "value_labels": v.label_name, "format": v.format}
        fields.append(StructField(v.name, column_type(v), True, {k: t for k, t in notes.items() if t}))
        if codes and v.kind not in ("str", "strL"):
            fields.append(StructField(v.name + CODE_SUFFIX, StringType()))
    return StructType(fields)


@dataclass
class RowRange(InputPartition):
    file: int
    first: int
    rows: int


_COMPARE = {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less,
            LessThanOrEqual: np.less_equal}


class SurveyFileReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, partition_bytes: int, codes: bool):
        self.files = layouts(path)
        first = self.files[0][1]
        known = {v.name for v in first.variables}
        self.columns = [f.name for f in schema.fields]
        self.coded = {c.removesuffix(CODE_SUFFIX) for c in self.columns if codes and c not in known}
        unknown = {c.removesuffix(CODE_SUFFIX) if codes and c not in known else c for c in self.columns} - known
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        self.partition_bytes = partition_bytes
        self.filters: list = []
        self.known = known
        # Long texts are found by a sparse index, made once.
        self.indexes = {}
        if any(first.variable(c).kind == "strL" for c in self.columns if c in known):
            for k, (file, own) in enumerate(self.files):
                store, place = open_store(file)
                with store.open_input_file(place) as source:
                    self.indexes[k] = dta.long_text_index(source, own)

    def pushFilters(self, filters):
        """Comparisons of numbers with numbers and tests for nulls are applied here, all others are given back to Spark."""
        first = self.files[0][1]
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            plain = name in self.known and isinstance(column_type(first.variable(name)), (IntegerType, DoubleType))
            numbers = f.value if isinstance(f, In) else [getattr(f, "value", 0)]
            simple = isinstance(f, (In, IsNull, IsNotNull, *_COMPARE)) and all(
                isinstance(v, (int, float)) and not isinstance(v, bool) for v in numbers)
            if plain and simple:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        parts = []
        for k, (_, own) in enumerate(self.files):
            step = max(1, self.partition_bytes // max(1, own.row_bytes))
            parts += [RowRange(k, first, min(step, own.rows - first)) for first in range(0, own.rows, step)]
        return parts or [RowRange(0, 0, 0)]

    def read(self, partition: RowRange):
        file, layout = self.files[partition.file]
        wanted = [c for c in self.columns if c in self.known]
        needed = list(dict.fromkeys([*wanted, *self.coded, *(f.attribute[0] for f in self.filters)]))
        row_type = layout.row_type(needed)
        store, place = open_store(file)
        with store.open_input_file(place) as source:
            for low in range(partition.first, partition.first + partition.rows, BATCH_ROWS):
                n = min(BATCH_ROWS, partition.first + partition.rows - low)
                source.seek(layout.data_at + low * layout.row_bytes)
                raw = source.read(n * layout.row_bytes)
                if len(raw) < n * layout.row_bytes:
                    raise ValueError(f"{file} ends within its rows")
                # Without any column, as for a count, only the number of rows matters.
                rows = np.frombuffer(raw, row_type) if needed else np.empty(n, "V0")
                for f in self.filters:
                    rows = rows[self._fits(f, rows, layout)]
                arrays = {c: self._column(rows, c, layout, source, partition.file) for c in wanted}
                for c in self.coded:
                    arrays[c + CODE_SUFFIX] = self._codes(rows[c], layout.variable(c).kind)
                if self.columns:
                    yield pa.RecordBatch.from_arrays([arrays[c] for c in self.columns], self.columns)
                else:
                    yield pa.RecordBatch.from_struct_array(pa.array([{}] * len(rows), pa.struct([])))

    @staticmethod
    def _fits(f, rows: np.ndarray, layout: Layout) -> np.ndarray:
        name = f.attribute[0]
        values = rows[name]
        known = dta.missing_codes(values, layout.variable(name).kind) < 0
        if isinstance(f, IsNull):
            return ~known
        if isinstance(f, IsNotNull):
            return known
        if isinstance(f, In):
            return known & np.isin(values.astype(np.float64), [float(v) for v in f.value])
        return known & _COMPARE[type(f)](values.astype(np.float64), f.value)

    @staticmethod
    def _codes(values: np.ndarray, kind: str) -> pa.Array:
        codes = dta.missing_codes(values, kind)
        return pa.array(np.array(dta.MISSING_CODES, object)[np.maximum(codes, 0)], pa.string(), mask=codes < 0)

    def _column(self, rows: np.ndarray, name: str, layout: Layout, source, file: int) -> pa.Array:
        variable, values = layout.variable(name), rows[name]
        if variable.kind == "str":
            texts = [t.split(b"\0", 1)[0].decode(layout.encoding, "replace") for t in values.tolist()]
            return pa.array([t or None for t in texts], pa.string())
        if variable.kind == "strL":
            marks = dta.references(values, layout)
            texts = dta.long_texts(source, layout, set(marks), *self.indexes[file])
            return pa.array([texts[m] or None for m in marks], pa.string())
        missing = dta.missing_codes(values, variable.kind) >= 0
        if variable.is_date:
            days = np.where(missing, 0, values).astype(np.float64)
            return pa.array(np.floor(days).astype(np.int32) + EPOCH_DAYS, pa.int32(), mask=missing).cast(pa.date32())
        if variable.is_time:
            micros = np.round(np.where(missing, 0, values).astype(np.float64) * 1000).astype(np.int64) + EPOCH_DAYS * 86_400_000_000
            return pa.array(micros, pa.int64(), mask=missing).cast(pa.timestamp("us", "UTC"))
        kind = np.int32 if variable.kind in dta.WHOLE_RANGES else np.float64
        return pa.array(np.where(missing, 0, values).astype(kind), mask=missing)


class SurveyFileSource(DataSource):
    """Options: path (a file or a folder of files), codes (true: a column with the missing code beside each number),
    partition_bytes; for writing also frame (captions, labels and widths, see ``write_survey_file``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _codes(self) -> bool:
        return self.options.get("codes", "false").lower() == "true"

    def schema(self) -> StructType:
        return schema_of(layouts(self.options["path"])[0][1], self._codes())

    def reader(self, schema: StructType) -> SurveyFileReader:
        return SurveyFileReader(self.options["path"], schema, int(self.options.get("partition_bytes", PARTITION_BYTES)),
                                self._codes())

    def writer(self, schema: StructType, overwrite: bool) -> SurveyFileWriter:
        if overwrite:
            raise ValueError("files are only added to a folder; write_survey_file replaces one as a whole")
        return SurveyFileWriter(self.options["path"], schema, json.loads(self.options.get("frame", "{}")))


@dataclass
class Written(WriterCommitMessage):
    draft: str
    name: str


_STORED = {BooleanType: "byte", ByteType: "int", ShortType: "long", IntegerType: "long", LongType: "double", FloatType: "float",
           DoubleType: "double", DecimalType: "double", DateType: "long", TimestampType: "double"}


class SurveyFileWriter(DataSourceArrowWriter):
    """One file per task; files appear in the folder when all tasks are done."""

    def __init__(self, path: str, schema: StructType, frame: Mapping):
        self.path, self.schema, self.frame, self.job = path.rstrip("/"), schema, frame, uuid.uuid4().hex

    def layout(self, rows: int) -> Layout:
        found, offset = [], 0
        widths, captions, names = (self.frame.get(k, {}) for k in ("widths", "captions", "labels"))
        for f in self.schema.fields:
            if isinstance(f.dataType, StringType):
                kind, width, form = "str", max(1, widths.get(f.name, dta.LONGEST_TEXT)), "%9s"
            elif type(f.dataType) in _STORED:
                kind = _STORED[type(f.dataType)]
                width = np.dtype(dta.NUMPY_TYPES[kind]).itemsize
                form = {DateType: "%td", TimestampType: "%tc"}.get(type(f.dataType), "%10.0g")
            else:
                raise ValueError(f"the format has no type for column {f.name} of {f.dataType.simpleString()}")
            found.append(Variable(f.name, kind, width, offset, form, f.name if f.name in names else "", captions.get(f.name, "")))
            offset += width
        labels = {n: {int(c): t for c, t in texts.items()} for n, texts in names.items()}
        return Layout(118, "<", rows, 0, tuple(found), labels)

    def write(self, iterator) -> Written:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{self.job}"
        store, place = open_store(self.path)
        store.create_dir(place, recursive=True)
        # Rows come first, because the header says how many there are.
        draft, rows = f"{place}/_{name}-{context.taskAttemptId()}", 0
        empty = self.layout(0)
        row_type = empty.row_type([v.name for v in empty.variables])
        with store.open_output_stream(f"{draft}.rows") as out:
            for batch in iterator:
                block = np.zeros(batch.num_rows, row_type)
                for v in empty.variables:
                    block[v.name] = _stored(batch.column(v.name), v)
                out.write(block.tobytes())
                rows += batch.num_rows
        before, after = dta.frame_of(self.layout(rows))
        with store.open_output_stream(f"{draft}.file") as out, store.open_input_stream(f"{draft}.rows") as source:
            out.write(before)
            while block := source.read(8 << 20):
                out.write(block)
            out.write(after)
        store.delete_file(f"{draft}.rows")
        return Written(f"{draft}.file", f"{place}/{name}.dta")

    def commit(self, messages) -> None:
        store, _ = open_store(self.path)
        for m in messages:
            if m is not None:
                store.move(m.draft, m.name)

    def abort(self, messages) -> None:
        store, _ = open_store(self.path)
        for m in messages:
            if m is not None and store.get_file_info(m.draft).type == pafs.FileType.File:
                store.delete_file(m.draft)


def _stored(column: pa.Array, variable: Variable) -> np.ndarray:
    """A column in storage form. Numbers and texts that the type can't hold stop the job."""
    if variable.kind == "str":
        raw = [t.encode() for t in column.fill_null("").to_pylist()]
        longest = max(map(len, raw), default=0)
        if longest > variable.width:
            raise ValueError(f"a text of {variable.name} takes {longest} bytes, more than the {variable.width} of its type")
        return np.array(raw, f"S{variable.width}")
    missing = np.asarray(column.is_null())
    if variable.is_date:
        values = np.asarray(column.cast(pa.int32()).fill_null(0)).astype(np.int64) - EPOCH_DAYS
    elif variable.is_time:
        micros = np.asarray(column.cast(pa.timestamp("us", column.type.tz)).cast(pa.int64()).fill_null(0))
        values = (micros - EPOCH_DAYS * 86_400_000_000) / 1000
    elif pa.types.is_decimal(column.type):
        values = np.asarray(column.cast(pa.float64()).fill_null(0))
    else:
        values = np.asarray(column.fill_null(False if pa.types.is_boolean(column.type) else 0))
    if variable.kind in dta.WHOLE_RANGES:
        low, high = dta.WHOLE_RANGES[variable.kind]
        held = (values >= low) & (values <= high)
    elif pa.types.is_integer(column.type):
        held = np.abs(values) <= 1 << 53
    else:
        missing |= np.isnan(values)
        first, _, bits = dta.MISSING_BITS[variable.kind]
        held = np.abs(values) < np.array(first, bits).view(dta.NUMPY_TYPES[variable.kind])
    if not (held | missing).all():
        raise ValueError(f"a number of {variable.name} is out of range for the format")
    return dta.with_missing(np.where(missing, 0, values), np.where(missing, 0, -1), variable.kind)


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(SurveyFileSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def read_survey_file(spark: SparkSession, path: str, columns: Sequence[str] | None = None, codes: bool = False,
                     partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """A labelled survey file, or a folder of files with the same columns, as a table of codes.

    Only the named ``columns`` are taken out of the rows. Whole types are integers, both float types doubles, daily and
    millisecond dates dates and timestamps; missing codes are nulls, and so is the empty text. With ``codes`` every number
    has a text column ``<name>_code`` beside it with ``.`` or ``.a`` to ``.z`` where it is missing. Captions are in
    the columns' metadata (``labels.caption_of``), label texts in ``value_labels``.
    """
    files = layouts(path)
    schema = schema_of(files[0][1], codes)
    if columns is not None:
        by_name = {f.name: f for f in schema.fields}
        schema = StructType([by_name[c] for c in columns])
    reader = _registered(spark).read.format(FORMAT).schema(schema).options(codes=str(codes).lower(), partition_bytes=partition_bytes)
    found = reader.load(path)
    # A source's columns come without metadata.
    for f in schema.fields:
        found = found.withMetadata(f.name, f.metadata) if f.metadata else found
    return found


def value_labels(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary (column_name, code, text) of all labelled columns of a file or folder."""
    texts: dict[str, dict[int, str]] = {}
    for _, own in layouts(path):
        for v in own.variables:
            if own.labels.get(v.label_name):
                texts.setdefault(v.name, {}).update(own.labels[v.label_name])
    return dictionary_rows(spark, texts)


def write_survey_file(df: DataFrame, path: str, captions: Mapping[str, str] | None = None,
                      labels: Mapping[str, Mapping[int, str]] | None = None, files: int | None = None) -> None:
    """Write a folder of labelled survey files (release 118), one per task or ``files`` of them, replacing what is there.

    The files are whole before the folder takes the place of an older one, which may be read by ``df`` itself.
    Captions default to those in the columns' metadata. Long integers are stored as doubles; numbers beyond 2^53 or
    beyond a type's range and texts of more than 2,045 bytes stop the job. The empty text and null are the same
    in the format. Widths of texts come from one aggregation over them.
    """
    captions = {**{f.name: f.metadata["label"] for f in df.schema.fields if "label" in f.metadata}, **(captions or {})}
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    widths = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).head().asDict() if texts else {}
    widths = {c: w or 1 for c, w in widths.items()}
    too_long = {c: w for c, w in widths.items() if w > dta.LONGEST_TEXT}
    if too_long:
        raise ValueError(f"texts of more than {dta.LONGEST_TEXT} bytes: {too_long}")
    frame = json.dumps({"captions": captions, "labels": labels or {}, "widths": widths})
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    _registered(df.sparkSession)
    try:
        (df.coalesce(files) if files else df).write.format(FORMAT).mode("append").option("frame", frame).save(staged)
    except Exception:
        remove_folder(df.sparkSession, staged)
        raise
    replace_folder(df.sparkSession, staged, path)

"""Vector code compression: product quantisation with Drake-Hamerly adaptive bounds.

Every vector is cut into equal parts and each part position has its own codebook, improved in rounds of Lloyd's
method on whole numbers. Between rounds every part keeps its entry with an upper bound of the distance, its ``b``
next closest entries with lower bounds in ascending order, and one outer bound below the distances of all other
entries. After the codebooks have moved, bounds move by as much as their entries did; a part whose upper bound lies
under all lower bounds stays where it is without any distance. For the others the bounds tell how far down
its list a nearer entry may stand, and only these entries, or all of them beyond the outer bound, are compared in whole numbers.

``b`` follows the work: what is kept for a part position after a round covers nearly all parts of the batch as far as
they had to look. Bounds are rounded outwards, so neither ``b`` nor the batches ever change a result.

Codebooks are the only thing that all tasks share (``entries`` vectors). Rounds are written tables without a shuffle of
vectors; a round's sums are one row per part position and entry from each task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import cut_lineage
from kinfold.operators.merge import join_on

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CLOSEST = 8
SETTLED = 0.95
# Whole components beyond this are set to it, so that distances of 2,048 dimensions are exact in every sum.
LARGEST = 1 << 22

_STATE = ("vec_id bigint, label int, x binary, assigned binary, upper binary, b binary, closest binary, lower binary, "
          "outer binary")


def finite_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds neither nulls nor NaN nor infinities."""
    value = lambda x: x.cast("double")
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")))
    return vectors.filter(F.col(column).isNotNull() & fine)


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * scale), -LARGEST, LARGEST).astype(np.int64)


def _down(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


def _up(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values.astype(np.float32), np.float32(np.inf))


def distances(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact: all terms are whole numbers below 2^53."""
    x, codebook = x.astype(np.float64), codebook.astype(np.float64)
    found = (x * x).sum(1)[:, None] - 2 * (x @ codebook.T) + (codebook * codebook).sum(1)
    return found.astype(np.int64)


def _to_entries(x: np.ndarray, codebook: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each row to its own entries."""
    return ((x[:, None, :] - codebook[entries]) ** 2).sum(2)


class Bounds:
    """Assigned entry, upper bound, closest other entries with ordered lower bounds, and outer bound of one part position."""

    def __init__(self, assigned, upper, closest, lower, outer):
        self.assigned, self.upper, self.closest, self.lower, self.outer = assigned, upper, closest, lower, outer

    @classmethod
    def of(cls, x: np.ndarray, codebook: np.ndarray, b: int) -> Bounds:
        """From all distances. The nearest entry is the first of the least distances."""
        found = distances(x, codebook)
        b = min(b, len(codebook) - 1)
        order = np.argsort(found, axis=1, kind="stable")
        near = np.sqrt(np.take_along_axis(found, order[:, :b + 2], 1))
        outer = _down(near[:, b + 1]) if len(codebook) > b + 1 else np.full(len(x), np.inf, np.float32)
        return cls(order[:, 0], _up(near[:, 0]), order[:, 1:b + 1], _down(near[:, 1:b + 1]), outer)

    def moved(self, drift: np.ndarray) -> None:
        """Widen all bounds by what their entries have moved; the lower ones are put in order again."""
        # Adding in double precision and rounding outwards keeps every bound on its side.
        self.upper = _up(self.upper.astype(np.float64) + drift[self.assigned])
        lower = _down(self.lower.astype(np.float64) - drift[self.closest])
        self.outer = _down(self.outer.astype(np.float64) - drift.max(initial=0.0))
        order = np.argsort(lower, axis=1, kind="stable")
        self.closest, self.lower = np.take_along_axis(self.closest, order, 1), np.take_along_axis(lower, order, 1)

    def settle(self, x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
        """Make ``assigned`` the nearest entry again; gives how far down each part's list it had to look."""
        b = self.closest.shape[1]
        looked = np.zeros(len(x), np.int64)
        least = np.minimum(self.lower[:, 0], self.outer) if b else self.outer
        open_ = np.flatnonzero(self.upper >= least)
        if not len(open_):
            return looked
        own = ((x[open_] - codebook[self.assigned[open_]]) ** 2).sum(1)
        self.upper[open_] = _up(np.sqrt(own))
        upper = self.upper[open_]
        # Lower bounds are in order, so the first one above the upper bound ends the search.
        depth = (self.lower[open_] <= upper[:, None]).sum(1)
        beyond = self.outer[open_] <= upper
        depth[beyond] = b + 1
        looked[open_] = depth
        for d in np.unique(depth[(depth > 0) & ~beyond]):
            self._compare(open_[depth == d], own[depth == d], int(d), x, codebook)
        if beyond.any():
            rows = open_[beyond]
            fresh = Bounds.of(x[rows], codebook, b)
            self.assigned[rows], self.upper[rows], self.outer[rows] = fresh.assigned, fresh.upper, fresh.outer
            self.closest[rows], self.lower[rows] = fresh.closest, fresh.lower
        return looked

    def _compare(self, rows: np.ndarray, own: np.ndarray, depth: int, x: np.ndarray, codebook: np.ndarray) -> None:
        """Whole distances to the assigned and the first ``depth`` listed entries; the nearest one becomes the assigned."""
        entries = np.column_stack([self.assigned[rows], self.closest[rows, :depth]])
        found = np.column_stack([own, _to_entries(x[rows], codebook, entries[:, 1:])])
        best = np.lexsort((entries, found), axis=1)[:, :1]
        self.assigned[rows] = np.take_along_axis(entries, best, 1)[:, 0]
        self.upper[rows] = _up(np.sqrt(np.take_along_axis(found, best, 1)[:, 0]))
        rest = np.ones(entries.shape, bool)
        np.put_along_axis(rest, best, False, 1)
        closest = np.column_stack([entries[rest].reshape(len(rows), depth), self.closest[rows, depth:]])
        lower = np.column_stack([_down(np.sqrt(found[rest])).reshape(len(rows), depth), self.lower[rows, depth:]])
        order = np.argsort(lower, axis=1, kind="stable")
        self.closest[rows] = np.take_along_axis(closest, order, 1)
        self.lower[rows] = np.take_along_axis(lower, order, 1)

    def shortened(self, b: int) -> None:
        """Keep the first ``b`` listed entries; the outer bound takes over for the others."""
        if b < self.closest.shape[1]:
            self.outer = np.minimum(self.outer, self.lower[:, b])
            self.closest, self.lower = self.closest[:, :b], self.lower[:, :b]


def enough(looked: np.ndarray, b: int, settled: float = SETTLED) -> int:
    """The least list length, two at least, that covers this share of the parts; those beyond the outer bound count as b."""
    if not len(looked) or b <= 2:
        return b
    return int(np.clip(np.quantile(np.minimum(looked, b), settled, method="higher"), 2, b))


def _rows(column: pa.Array, dtype) -> np.ndarray:
    """Binary values of equal length as a matrix."""
    n = len(column)
    parts = np.frombuffer(b"".join(column.to_pylist()), dtype)
    return parts.reshape(n, -1) if n else parts.reshape(0, 0)


def _half(values: np.ndarray, towards: float) -> np.ndarray:
    """Half precision for the table, rounded outwards once more; a bound too large for it becomes the largest number or infinite."""
    with np.errstate(over="ignore"):
        near = values.astype("<f2")
    past = near < values if towards > 0 else near > values
    return np.where(past, np.nextafter(near, np.float16(towards)), near).astype("<f2")


def _smallest(x: np.ndarray) -> np.ndarray:
    """Two bytes for each component where they do, else four."""
    return x.astype("<i2" if -(1 << 15) <= x.min(initial=0) and x.max(initial=0) < 1 << 15 else "<i4")


def _binary(matrix: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(matrix)
    step = data.shape[1] * data.itemsize
    return pa.array([data[i].tobytes() for i in range(len(data))], pa.binary()) if step else pa.array([b""] * len(data), pa.binary())


def _packed(batch: pa.RecordBatch, x: np.ndarray, parts: list[Bounds]) -> pa.RecordBatch:
    b = np.array([p.closest.shape[1] for p in parts], np.uint8)
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("label"), _binary(_smallest(x)),
         _binary(np.column_stack([p.assigned for p in parts]).astype(np.uint8)),
         _binary(_half(np.column_stack([p.upper for p in parts]), np.inf)), _binary(np.tile(b, (len(x), 1))),
         _binary(np.column_stack([p.closest for p in parts]).astype(np.uint8)),
         _binary(_half(np.column_stack([p.lower for p in parts]), -np.inf)),
         _binary(_half(np.column_stack([p.outer for p in parts]), -np.inf))],
        ["vec_id", "label", "x", "assigned", "upper", "b", "closest", "lower", "outer"])


def _components(column: pa.Array, length: int) -> np.ndarray:
    """Whole components of ``length`` dimensions, as long numbers; rows may differ in bytes per component."""
    rows = column.to_pylist()
    sizes = {len(r) for r in rows}
    if len(sizes) == 1:
        return np.frombuffer(b"".join(rows), f"<i{sizes.pop() // length}").astype(np.int64).reshape(len(rows), length)
    return np.array([np.frombuffer(r, f"<i{len(r) // length}") for r in rows], np.int64).reshape(len(rows), length)


def _unpacked(batch: pa.RecordBatch, length: int):
    """The batch cut where the list lengths change: (rows, x, one Bounds for each part position)."""
    lengths = _rows(batch.column("b"), np.uint8)
    cuts = [0, *(np.flatnonzero((lengths[1:] != lengths[:-1]).any(1)) + 1).tolist(), len(lengths)]
    for low, high in zip(cuts, cuts[1:]):
        own = batch.slice(low, high - low)
        assigned, upper = _rows(own.column("assigned"), np.uint8).astype(np.int64), _rows(own.column("upper"), "<f2").astype(np.float32)
        closest = _rows(own.column("closest"), np.uint8).astype(np.int64)
        lower, outer = (_rows(own.column(c), "<f2").astype(np.float32) for c in ("lower", "outer"))
        ends = np.concatenate([[0], np.cumsum(lengths[low])]).astype(int)
        yield own, _components(own.column("x"), length), [
            Bounds(assigned[:, p], upper[:, p].copy(), closest[:, ends[p]:ends[p + 1]].copy(),
                   lower[:, ends[p]:ends[p + 1]].copy(), outer[:, p].copy()) for p in range(assigned.shape[1])]


def _first(batches, codebooks: np.ndarray, closest: int):
    """Bounds of all parts from all distances."""
    parts, _, width = codebooks.shape
    for batch in batches:
        if batch.num_rows:
            x = whole(np.asarray(batch.column("vector").flatten()).reshape(batch.num_rows, parts * width))
            yield _packed(batch, x, [Bounds.of(x[:, p * width:(p + 1) * width], codebooks[p], closest) for p in range(parts)])


def _assigned_again(batch: pa.RecordBatch, codebooks: np.ndarray, drifts: np.ndarray):
    parts, _, width = codebooks.shape
    for own, x, bounds in _unpacked(batch, parts * width):
        looked = []
        for p in range(parts):
            bounds[p].moved(drifts[p])
            looked.append(bounds[p].settle(x[:, p * width:(p + 1) * width], codebooks[p]))
        yield own, x, bounds, looked


def _next(batches, codebooks: np.ndarray, drifts: np.ndarray):
    """Bounds after the codebooks have moved, with lists as long as this batch needed them."""
    for batch in batches:
        for own, x, bounds, looked in _assigned_again(batch, codebooks, drifts):
            for part, depth in zip(bounds, looked):
                part.shortened(enough(depth, part.closest.shape[1]))
            yield _packed(own, x, bounds)


def _codes(batches, codebooks: np.ndarray, drifts: np.ndarray):
    """Codes and errors under the final codebooks."""
    parts, _, width = codebooks.shape
    for batch in batches:
        for own, x, bounds, _ in _assigned_again(batch, codebooks, drifts):
            code = np.column_stack([b.assigned for b in bounds])
            nearest = codebooks[np.arange(parts)[None, :], code].reshape(len(x), parts * width)
            error = ((x - nearest) ** 2).sum(1)
            texts = ["".join(f"{e:02x}" for e in row) for row in code.tolist()]
            yield pa.RecordBatch.from_arrays([own.column("vec_id"), own.column("label"), pa.array(texts), pa.array(error)],
                                             ["vec_id", "label", "code", "error"])


def _sums(batches, shape: tuple[int, int, int]):
    """Number and component sums of the parts at each entry, over the task."""
    parts, entries, width = shape
    counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
    for batch in batches:
        if batch.num_rows:
            x = _components(batch.column("x"), parts * width).reshape(batch.num_rows, parts, width)
            assigned = _rows(batch.column("assigned"), np.uint8).astype(np.int64)
            for p in range(parts):
                counts[p] += np.bincount(assigned[:, p], minlength=entries)
                np.add.at(sums[p], assigned[:, p], x[:, p])
    part, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
         pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])


def improved(state: DataFrame, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks moved to the floor of their parts' means, and a bound of how far each entry moved."""
    width = codebooks.shape[2]
    rows = state.select("x", "assigned").mapInArrow(
        lambda batches: _sums(batches, codebooks.shape), "part int, entry int, n bigint, sums array<bigint>")
    total = rows.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    moved = codebooks.copy()
    for row in total.collect():  # one row for each part position and used entry
        moved[row.part, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]
    drift = np.sqrt(((moved - codebooks) ** 2).sum(2).astype(np.float64))
    return moved, np.where(drift > 0, np.nextafter(drift, np.inf), 0.0)


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks from the vectors of the smallest ids; of rows with the same id the least vector counts."""
    smallest = vectors.select("vec_id").filter("vec_id IS NOT NULL").distinct().orderBy("vec_id").limit(entries)
    ids = [r.vec_id for r in smallest.collect()]
    if not ids:
        return None
    chosen = vectors.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = [r.vector for r in sorted(chosen.collect(), key=lambda r: r.vec_id)]
    length = len(rows[0])
    if length % parts or not length:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    # An entry of another length can't take part; its own rows are without code in the result.
    found = whole(np.array([r for r in rows if len(r) == length], np.float64))
    return found.reshape(len(found), parts, length // parts).transpose(1, 0, 2).copy()


def codebooks_text(codebooks: np.ndarray) -> str:
    return ",".join(map(str, codebooks.ravel().tolist()))


def encode_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                   closest: int = CLOSEST) -> tuple[DataFrame, np.ndarray | None]:
    """vec_id, label, code and error of every finite vector of ``vectors`` (vec_id, embedding, label), and the codebooks.

    Other columns are ignored. Rows with a null vector, a null component or one that isn't finite are left out.
    Codebooks begin with the vectors of the ``entries`` smallest ids. ``rounds`` times every part takes its nearest
    entry (squared distance of whole numbers floor(256 x), ties to the lower index) and every used entry becomes the floor of its
    parts' mean; then codes are taken once more. ``code`` has two hex digits per part, ``error`` is the squared distance
    of the whole vector.

    Repeated rows each get their row; a null id gets a code but never begins a codebook. A vector of another length
    than that of the smallest id has null code and error, and so has every row if all ids are null. Components are set
    to the range of +-16,384. An empty table gives no rows and no codebooks. Lengths that ``parts`` doesn't divide are
    an error.
    """
    if not 0 < entries <= 256 or closest >= 256:
        raise ValueError("an entry has to fit into two hex digits")
    kept = finite_vectors(vectors).select("vec_id", "label", F.col("embedding").alias("vector"))
    codebooks = first_codebooks(kept, parts, entries)
    if codebooks is None:
        return kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                           F.lit(None).cast("bigint").alias("error")), None
    fitting = F.size("vector") == parts * codebooks.shape[2]
    state = cut_lineage(kept.filter(fitting).withColumn("label", F.col("label").cast("int")).mapInArrow(
        lambda batches, c=codebooks: _first(batches, c, closest), _STATE))
    codebooks, drifts = improved(state, codebooks)
    for _ in range(rounds - 1):
        state = cut_lineage(state.mapInArrow(lambda batches, c=codebooks, d=drifts: _next(batches, c, d), _STATE))
        codebooks, drifts = improved(state, codebooks)
    coded = cut_lineage(state.mapInArrow(
        lambda batches: _codes(batches, codebooks, drifts), "vec_id bigint, label int, code string, error bigint"))
    odd = kept.filter(~fitting).select("vec_id", F.col("label").cast("int").alias("label"),
                                       F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return coded.unionByName(odd), codebooks


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the error summed over equal labels, nulls together: added up first, then joined back on the label."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_on(coded, totals, "label", "left", null_safe=True)


def code_table(vectors: DataFrame) -> DataFrame:
    """Codes with errors per label and the digest of the final codebooks on every row."""
    coded, codebooks = encode_vectors(vectors)
    text = None if codebooks is None else hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(text).cast("string"))

"""Histogram sort into shards of equal bytes, in DataFrame operations only.

Rows are ordered by (hash of the text, doc_id), so equal texts lie side by side. Splitters are found by
counting: a pass sums the bytes and rows of every bin of the open key intervals on the executors, and the
bins' running sums give the exact bytes below each bin's start. A splitter is settled when a bin start
is within its tolerance; otherwise the bin it falls in is probed with finer bins. An interval that is down to
one text, a group of copies larger than the tolerance, is probed further by doc_id. Rows then move once,
to their ranges, where they are sorted and numbered; counts below each range give its first number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import cut_lineage

KEY_BITS = 60
FIRST_BITS, MORE_BITS = 12, 8
RANGE_BYTES = 256 << 20
MOST_RANGES = 4096
TOLERANCE = 0.005
LEAST_ID = -(1 << 63)


@dataclass
class Splitter:
    """Rows below (key, doc) belong to lower ranges; ``bytes_`` and ``rows`` are what lies below."""

    key: int
    doc: int
    bytes_: int
    rows: int


@dataclass
class _Open:
    """A splitter still sought in [low, low + 2^bits) of the keys, or of the doc_ids of one key."""

    place: int
    target: float
    tolerance: float
    low: int
    bits: int
    bytes_: int
    rows: int


def keyed(docs: DataFrame) -> DataFrame:
    """size and key of every row; a null text has size 1, a null doc_id sorts first."""
    return docs.withColumns({
        "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1,
        "key": F.shiftrightunsigned(F.xxhash64("text"), 64 - KEY_BITS),
        "order_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST_ID))})


def _histogram(rows: DataFrame, value: F.Column, starts: list[int], bits: int, step: int) -> dict[int, list]:
    """Per interval start: (bin start, bytes, rows) of its non-empty bins of 2^step values, in order."""
    own = rows.withColumns({"low": F.shiftleft(F.shiftright(value, bits), bits) if bits < 63 else F.lit(starts[0]),
                            "bin": F.shiftleft(F.shiftright(value, step), step)})
    counted = own.filter(F.col("low").isin(starts)).groupBy("low", "bin").agg(
        F.sum("size").alias("bytes_"), F.count("*").alias("n")).collect()
    out: dict[int, list] = {}
    for low, bin_, size, n in sorted(counted):
        out.setdefault(low, []).append((bin_, size, n))
    return out


def _probe(opened: list[_Open], bins: dict[int, list], step: int) -> tuple[list[tuple[_Open, int, int, int]], list[_Open]]:
    """Settled splitters as (open, start, bytes, rows), and those that need finer bins."""
    done, still = [], []
    for x in opened:
        below, rows = x.bytes_, x.rows
        for start, size, n in bins.get(x.low, []):
            if below + size > x.target or (start, size, n) == bins[x.low][-1]:
                down, up = x.target - below, below + size - x.target
                if min(down, up) <= x.tolerance or n == 1:
                    done.append((x, start, below, rows) if down <= up else (x, start + (1 << step), below + size, rows + n))
                else:
                    still.append(_Open(x.place, x.target, x.tolerance, start, step, below, rows))
                break
            below, rows = below + size, rows + n
    return done, still


def splitters(rows: DataFrame, total: int, shards: int, ranges: int, tolerance: float) -> list[Splitter]:
    """The lower ends of ranges 1 to shards * ranges - 1, as exact as ``tolerance`` (a share of a shard) asks."""
    count = shards * ranges
    limit = total / shards * tolerance
    opened = [_Open(i, total * i / count, limit if i % ranges == 0 else max(limit, total / count / 20), 0, KEY_BITS, 0, 0)
              for i in range(1, count)]
    found: dict[int, Splitter] = {}
    step = KEY_BITS - FIRST_BITS
    bits = KEY_BITS
    while opened and bits:
        bins = _histogram(rows, F.col("key"), sorted({x.low for x in opened}), bits, step)
        done, opened = _probe(opened, bins, step)
        found |= {x.place: Splitter(start, LEAST_ID, below, n) for x, start, below, n in done}
        bits, step = step, max(0, step - MORE_BITS)
    # What is left falls within one key each: go on by doc_id, for one key after the other.
    for key in sorted({x.low for x in opened}):
        own = rows.filter(F.col("key") == key).select("size", F.col("order_id").alias("place"))
        least, most = own.agg(F.min("place"), F.max("place")).head()
        bits = max(1, (most - least).bit_length())
        own = own.withColumn("place", F.col("place") - F.lit(least)) if bits < 63 else own.withColumn(
            "place", F.shiftright("place", 2) - F.lit(least >> 2))
        shift = 0 if bits < 63 else 2
        bits = min(bits, 62)
        within = [_Open(x.place, x.target, x.tolerance, 0, bits, x.bytes_, x.rows) for x in opened if x.low == key]
        while within:
            step = max(0, bits - FIRST_BITS)
            bins = _histogram(own, F.col("place"), sorted({x.low for x in within}), bits, step)
            # Rows of one doc_id and one text cannot be told apart, so the nearer side has to do.
            done, within = _probe([x if step else _Open(x.place, x.target, math.inf, x.low, x.bits, x.bytes_, x.rows)
                                   for x in within], bins, step)
            found |= {x.place: Splitter(key, (start << shift) + least, below, n) for x, start, below, n in done}
            bits = step
    return [found[i] for i in range(1, count)]


def shard_by_bytes(docs: DataFrame, shards: int = 8, range_bytes: int = RANGE_BYTES,
                   tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; sizes of shards differ by ``tolerance`` at most.

    Needs doc_id (integer) and text; other columns are ignored. size is the UTF-8 bytes of the text plus 1.
    slot numbers the rows of a shard from 0 without gaps, in the order of (hash of the text, doc_id). Equal texts
    share a shard unless their group straddles a border by more than the tolerance; then it is split by doc_id.
    A row can't be cut, so borders are off by half a row at most where rows are larger than the tolerance.

    A null text counts as empty, a null doc_id as the least. Repeated rows each get a slot. An empty table gives no
    rows. The driver sees bin sums only: at most 4,096 first, then 256 for each open splitter.
    """
    rows = cut_lineage(keyed(docs.select("doc_id", "text")).select(
        "doc_id", "size", "key", "order_id", F.coalesce(F.crc32("text"), F.lit(0)).alias("text_crc32")))
    total = rows.agg(F.sum("size")).head()[0] or 0
    ranges = max(1, min(MOST_RANGES // shards, math.ceil(total / shards / range_bytes)))
    cuts = splitters(rows, total, shards, ranges, tolerance) if total else []
    ends = [Splitter(0, LEAST_ID, 0, 0), *cuts]
    table = [(i, c.key, c.doc, i // ranges, c.rows - ends[i // ranges * ranges].rows) for i, c in enumerate(ends)]
    # The range of a row: the last one whose lower end is not above it. Ranges are looked up by the first bits of
    # the key; a bin without a splitter of its own belongs to the range that is open there.
    firsts: dict[int, list[tuple[int, int, int]]] = {}
    for i, key, doc, _, _ in table[1:]:
        firsts.setdefault(key >> (KEY_BITS - FIRST_BITS), []).append((key, doc, i))
    bins, current = [], 0
    for b in range(1 << FIRST_BITS):
        own = firsts.get(b, [])
        bins.append((b, current, own))
        current = own[-1][2] if own else current
    spark = docs.sparkSession
    lookup = spark.createDataFrame(bins, "first int, range int, cuts array<struct<key: bigint, doc: bigint, range: int>>")
    bases = spark.createDataFrame([(i, s, n) for i, _, _, s, n in table], "range int, shard int, base bigint")
    # Both tables are bounded: 4,096 bins, and MOST_RANGES splitters in all.
    placed = rows.withColumn("first", F.shiftright("key", KEY_BITS - FIRST_BITS).cast("int")).join(
        F.broadcast(lookup.withColumnRenamed("range", "open")), "first").withColumn("range", F.expr(
            "coalesce(array_max(transform(filter(cuts, c -> c.key < key OR c.key = key AND c.doc <= order_id), "
            "c -> c.range)), open)"))
    numbered = placed.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy("key", "order_id")))
    return numbered.join(F.broadcast(bases), "range").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place") - 1).alias("slot"))

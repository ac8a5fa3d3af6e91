"""Benchmark decontamination with one FM-index per training shard.

Every group of texts (a few megabytes, the shard) becomes a text of word ids over the words of
the benchmark; other words only break it, and runs shorter than the shortest test phrase cannot
hold one and are left out. Test phrases are searched backwards through wavelet ranks, located by
sampled suffix positions, and their spans merged. Nothing is shuffled: the benchmark goes to the
documents. It does so in blocks of bounded size, each with its own pass over the documents; the
passes are put together per document when there is more than one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.fm_index import BREAK, END, FIRST_WORD, FMIndex
from kinfold.llm.shared import cut_lineage, frugal
from kinfold.llm.words import ALPHANUMERIC, Words, word_groups

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 8 << 20
SPANS = "array<struct<start: bigint, end: bigint>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


@dataclass
class Phrases:
    """Distinct test phrases as rows of word ids, ends aligned right, and the items each belongs to."""

    hashes: np.ndarray
    ids: np.ndarray
    words: list[bytes]
    rows: np.ndarray
    length: np.ndarray
    items: list[list[str]]

    @property
    def shortest(self) -> int:
        return int(self.length.min()) if len(self.length) else 0


def phrases(items: list[tuple[str, str]], window: int = WINDOW) -> Phrases:
    """Windows of ``window`` consecutive words of each item; a shorter item is one window, an empty one none."""
    vocabulary: dict[bytes, int] = {}
    hashes: list[int] = []
    found: dict[tuple[int, ...], set[str]] = {}
    for group in word_groups(pa.array([text for _, text in items], pa.large_string()), ALPHANUMERIC, lower=True):
        codes, ids = group.hashes(), np.empty(len(group.start), np.int64)
        for i in range(len(ids)):
            word = group.word(i)
            if word not in vocabulary:
                vocabulary[word] = len(vocabulary) + FIRST_WORD
                hashes.append(int(codes[i]))
            ids[i] = vocabulary[word]
        for k in range(group.high - group.low):
            own = ids[group.first[k]:group.first[k + 1]].tolist()
            for at in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(tuple(own[at:at + window]), set()).add(items[group.low + k][0])
    keys = list(found)
    rows = np.full((len(keys), window), -1, np.int64)
    for i, key in enumerate(keys):
        rows[i, window - len(key):] = key
    codes = np.array(hashes, np.uint64)
    order = np.argsort(codes)
    return Phrases(codes[order], order + FIRST_WORD, list(vocabulary), rows,
                   np.array([len(key) for key in keys], np.int64), [sorted(found[key]) for key in keys])


def _occurrences(group: Words, known: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word place and phrase of every occurrence in a group of texts."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(known.length) or not len(group.start):
        return nothing
    codes = group.hashes()
    at = np.minimum(np.searchsorted(known.hashes, codes), len(known.hashes) - 1)
    symbol = np.where(known.hashes[at] == codes, known.ids[at], BREAK)
    while True:
        # Runs of benchmark words within one text; the shorter ones hold no phrase.
        text = group.owner()
        word = symbol != BREAK
        opens = word & np.concatenate([[True], ~word[:-1] | (text[1:] != text[:-1])])
        run = np.cumsum(opens) - 1
        long_enough = np.bincount(run[word], minlength=run[-1] + 1 if len(run) else 0) >= known.shortest
        kept = np.flatnonzero(word & (run >= 0) & long_enough[np.maximum(run, 0)]) if len(long_enough) else nothing[0]
        if not len(kept):
            return nothing
        # One break before each run, then its words.
        place = np.arange(len(kept)) + np.cumsum(opens[kept])
        shard = np.full(place[-1] + 2, BREAK, np.int64)
        shard[place], shard[-1] = symbol[kept], END
        back = np.zeros(len(shard), np.int64)
        back[place] = kept
        index = FMIndex(shard)
        rows, low, high = index.search(known.rows)
        found, which = index.locate(low, high)
        start, phrase = back[found], rows[which]
        # Words are compared by 64 bits so far; words of occurrences are compared in full.
        cover = _covered(start, known.length[phrase], len(symbol))
        wrong = [i for i in np.flatnonzero(cover) if group.word(i) != known.words[symbol[i] - FIRST_WORD]]
        if not wrong:
            return start, phrase
        symbol[wrong] = BREAK


def _covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    change = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def _scan(batch: pa.RecordBatch, known: Phrases):
    for group in word_groups(batch.column("text"), ALPHANUMERIC, lower=True, group_bytes=SHARD_BYTES):
        start, phrase = _occurrences(group, known)
        texts = group.high - group.low
        n_words, hit = np.diff(group.first), _covered(start, known.length[phrase], len(group.start))
        owner = group.owner()
        spans, places, items = [[] for _ in range(texts)], [[] for _ in range(texts)], [set() for _ in range(texts)]
        for text, row in {(int(t), int(p)) for t, p in zip(owner[start], phrase)}:
            items[text].update(known.items[row])
        opens = np.flatnonzero(hit & np.concatenate([[True], ~hit[:-1] | (owner[1:] != owner[:-1])])) if len(hit) else []
        closes = np.flatnonzero(hit & np.concatenate([~hit[1:] | (owner[1:] != owner[:-1]), [True]])) if len(hit) else []
        # Code points before each byte, only where there is something to report.
        points = np.concatenate([[0], np.cumsum((group.data & 0xC0) != 0x80)]) if len(opens) else None
        for a, b in zip(opens, closes):
            text = owner[a]
            origin = points[group.text_start[text]]
            spans[text].append({"start": int(points[group.start[a]] - origin), "end": int(points[group.end[b]] - origin)})
            places[text].append({"start": int(a - group.first[text]), "end": int(b + 1 - group.first[text])})
        rest = batch.slice(group.low, texts).drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(n_words, pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
             pa.array(places, SPAN_TYPE), pa.array(spans, SPAN_TYPE)],
            [*rest.schema.names, "n_words", "items", "word_spans", "spans"])


@frugal(keeps_cache=False)
def _found(batches, known: Broadcast):
    for batch in batches:
        yield from _scan(batch, known.value)


@frugal(keeps_cache=False)
def _clean(batches, known: Broadcast):
    """The rows in which nothing is found, with all their columns."""
    for batch in batches:
        yield batch.filter(pa.array([not items for part in _scan(batch.select(["text"]), known.value)
                                     for items in part.column("items").to_pylist()], pa.bool_()))


def _merged(spans: str) -> F.Column:
    """Overlapping and touching spans of an array as one, in order."""
    return F.expr(f"""aggregate(array_sort({spans}), cast(array() as {SPANS}), (done, x) ->
        CASE WHEN size(done) = 0 OR try_element_at(done, -1).end < x.start THEN concat(done, array(x))
             ELSE concat(slice(done, 1, size(done) - 1), array(named_struct('start', try_element_at(done, -1).start,
                  'end', greatest(try_element_at(done, -1).end, x.end)))) END)""")


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[tuple[Broadcast, bool]]:
    """The phrases of the benchmark in broadcasts of about ``block_bytes`` of text each, one at a time, and whether it is the only one.

    Blocks are dealt by rows: the items of a document are put together from all of them, so an item may be in several,
    and only a single text can make a block larger.
    """
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").filter("text IS NOT NULL")
    total = bench.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else bench
        rows = [tuple(r) for r in part.distinct().collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(phrases(rows, window)), blocks == 1


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, extra: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences of benchmark phrases, one row per document.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Gives doc_id, the
    columns ``extra``, n_words, items (ids of items with an occurrence, as sorted strings), word_spans and spans
    (merged occurrences in words and in code points, ends exclusive).

    A null or empty text has no words and nothing is found in it; items without words are ignored; rows of
    one item id are taken together, those without an id as an item named by the empty text; repeated documents each get
    their row. Very long texts form a shard alone. An empty benchmark gives documents without occurrences. A benchmark of
    more than ``block_bytes`` is passed in blocks: each comes to the driver, goes to the tasks for a pass that
    is written at once, and is released before the next one.
    """
    rows = docs.select("doc_id", "text", *extra)
    marked = rows.withColumn("row_mark", F.xxhash64(*[F.col(c) for c in rows.columns]))
    parts = []
    for known, only in _blocks(benchmark, window, block_bytes):
        source = rows if only else marked
        schema = ", ".join(f"`{c}` {t}" for c, t in source.dtypes if c != "text")
        schema += f", n_words bigint, items array<string>, word_spans {SPANS}, spans {SPANS}"
        found = source.mapInArrow(lambda batches, known=known: _found(batches, known), schema)
        if only:
            return found
        parts.append(cut_lineage(found))
        known.destroy()
    union = reduce(DataFrame.unionByName, parts)
    # Rows that are alike have the same mark, so each pass has as many of them: count them once.
    grouped = union.groupBy("doc_id", "row_mark").agg(
        *[F.first(c).alias(c) for c in extra], F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("word_spans")).alias("w"), F.flatten(F.collect_list("spans")).alias("s"),
        (F.count("*") / len(parts)).cast("int").alias("copies"))
    return grouped.select(
        "doc_id", *extra, "n_words", "items", _merged("w").alias("word_spans"), _merged("s").alias("spans"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in which nothing of the benchmark occurs, with all their columns; a written pass for each block."""
    for known, only in _blocks(benchmark, window, block_bytes):
        docs = docs.mapInArrow(lambda batches, known=known: _clean(batches, known), docs.schema)
        if not only:
            docs = cut_lineage(docs)
            known.destroy()
    return docs


def n_hit() -> F.Column:
    return F.expr("aggregate(word_spans, 0L, (n, x) -> n + x.end - x.start)")


def cut_spans(text: str = "text", spans: str = "spans") -> F.Column:
    """The text without the spans."""
    return F.expr(f"""concat(
        array_join(transform({spans}, (x, i) -> substr({text}, cast(if(i = 0, 0, get({spans}, i - 1).end) + 1 AS int),
            cast(x.start - if(i = 0, 0, get({spans}, i - 1).end) AS int))), ''),
        substr({text}, cast(coalesce(try_element_at({spans}, -1).end, 0) + 1 AS int)))""")

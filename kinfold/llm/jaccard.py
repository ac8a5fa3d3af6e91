"""N-gram Jaccard join by T-occurrence search in the manner of DivideSkip.

A document whose set holds n shingles is only linked to documents that share at least T of them,
T = ceil(threshold * n). Its n inverted lists are divided: the T - 1 longest ones are set aside, and the
short ones that remain must hold every partner at least once. Only short lists are built, as sorted
runs (Spark's sort-merge shuffle is the heap merge); long lists are never built, they are probed by
binary search in the partner's sorted set when a candidate is checked in full.

A pair's candidates stand in the list of its first common shingle, near enough to the beginning of both sets that what
follows can be the overlap that their two sizes ask for. Bit vectors of the sets drop most pairs that don't reach it before
their texts are compared.

List lengths come from counts over all documents in 2^22 bins, of which those well above the mean are taken as
long. They only order the lists, so their bins never change a result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.graph import components
from kinfold.llm.shared import cut_lineage, frugal
from kinfold.llm.words import SPACED, Words, mix, windows, word_groups
from kinfold.operators.dedup import first_per_key
from kinfold.operators.merge import join_on

WIDTH = 5
PERCENT = 80
BIN_BITS = 22
BLOCK_BINS = 1 << 16
ID_BINS = 1 << 20
# Turns of one pair per document: one over all lists, and more over those that hold more than so many entries outside their main
# component, until a turn takes less than this share of these off a list. They end when what these lists still ask to compare is no more
# than the entries of all lists times the last number. What is left is always compared in the same way, so these only choose how often.
FEW_OTHERS = 8
LEAST_GAIN = 0.05
MOST_TURNS = 12
PAIRS_PER_ENTRY = 0.25
# Bits kept for each shingle of a set.
BITS_EACH = 4
_HASH = "__text_hash"
# Parts in which the list of a frequent shingle is counted.
OFTEN_PARTS = 64


def _group_sets(group: Words, width: int):
    """Sorted distinct shingle hashes of each text of a group."""
    hashes = group.hashes()
    runs = windows(hashes, width)
    for i in range(len(group.first) - 1):
        low, high = group.first[i], group.first[i + 1]
        if high - low >= width:
            yield np.unique(runs[low:high - width + 1])
        elif high > low:
            # The whole sequence is one shingle; its length keeps it apart from longer ones.
            yield windows(mix(hashes[low:high] + np.uint64(high - low)), high - low)
        else:
            yield hashes[:0]


def shingle_sets(column: pa.Array, width: int = WIDTH):
    for group in word_groups(column, SPACED, lower=True):
        yield from _group_sets(group, width)


def _needed(n: int, percent: int) -> int:
    """Least overlap of a set of n with any linked one."""
    return -(-percent * n // 100)


@frugal(keeps_cache=False)
def _count_bins(batches, width: int):
    """Documents of a task per bin, up to 255, in blocks of bins."""
    counts = np.zeros(1 << BIN_BITS, np.int32)
    for batch in batches:
        for group in word_groups(batch.column("text"), SPACED, lower=True):
            sets = list(_group_sets(group, width))
            np.add.at(counts, (np.concatenate(sets) >> np.uint64(64 - BIN_BITS)).astype(np.int64), 1)
    blocks = np.minimum(counts, 255).astype(np.uint8).reshape(-1, BLOCK_BINS)
    kept = np.flatnonzero(blocks.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array([blocks[k].tobytes() for k in kept], pa.binary())], ["block", "counts"])


@frugal(keeps_cache=False)
def _sum_blocks(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
            own = sums.setdefault(block, np.zeros(BLOCK_BINS, np.int64))
            own += np.frombuffer(counts.as_buffer(), np.uint8)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([np.minimum(own, 2**31 - 1).astype("<i4").tobytes() for own in sums.values()], pa.binary())],
        ["block", "counts"])


def list_lengths(texts: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Documents per bin of shingles, 0 where they are not well above the mean of all bins; 16 MB whatever the input.

    Numbers are rounded down to powers of two: near copies then order what they share by value, and so in few different ways.
    """
    rows = texts.select("text").mapInArrow(lambda batches: _count_bins(batches, width), "block int, counts binary")
    lengths = np.zeros(1 << BIN_BITS, np.int32).reshape(-1, BLOCK_BINS)
    for block, counts in rows.repartition("block").mapInArrow(_sum_blocks, "block int, counts binary").collect():
        lengths[block] = np.frombuffer(counts, "<i4")
    mean = float(lengths.mean(dtype=np.float64))
    lengths[lengths <= mean + 4 * np.sqrt(mean) + 1] = 0
    return (1 << np.frexp(lengths)[1] >> 1).astype(np.int32).ravel()


@frugal(keeps_cache=False)
def _marks(batches, width: int):
    """Size, 128-bit mark and bits of every set; an empty one has neither mark nor bits."""
    for batch in batches:
        sets = list(shingle_sets(batch.column("text"), width))
        marks = [_mark(own) for own in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(own) for own in sets], pa.int64()),
             pa.array([a for a, _ in marks], pa.int64()), pa.array([b for _, b in marks], pa.int64()),
             pa.array([_bits(own) if len(own) else None for own in sets], pa.binary())],
            ["doc_id", "text_hash", "n", "mark1", "mark2", "bits"])


def _bits(own: np.ndarray) -> bytes:
    """Bits that some shingle of a set falls on: a power of two, at least ``BITS_EACH`` for each shingle."""
    size = 1 << max(6, (BITS_EACH * len(own) - 1).bit_length())
    seen = np.zeros(size, bool)
    seen[(own & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(seen).tobytes()


def _short(own: np.ndarray, lengths: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The shingles of a set's short lists in the one order that all sets share (by list length, then by value), and how many of them are in long ones."""
    weight = lengths[(own >> np.uint64(64 - BIN_BITS)).astype(np.int64)]
    keep = len(own) - _needed(len(own), percent) + 1
    if not weight.any():
        return own[:keep], 0
    order = np.argsort(weight, kind="stable")[:keep]
    return own[order], int(np.count_nonzero(weight[order]))


def _mark(own: np.ndarray):
    return np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64) if len(own) else (None, None)


@frugal(keeps_cache=False)
def _short_lists(batches, lengths: np.ndarray, width: int, percent: int):
    """Size and mark of every set, the shingles of its short lists, and how many of these are in no long list."""
    for batch in batches:
        sets = list(shingle_sets(batch.column("text"), width))
        marks = [_mark(own) for own in sets]
        short = [_short(own, lengths, percent) if len(own) else (own, 0) for own in sets]
        ends = np.cumsum([0, *(len(own) for own, _ in short)]).astype(np.int32)
        values = np.concatenate([own for own, _ in short]) if short else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(own) for own in sets], pa.int64()), pa.array([a for a, _ in marks], pa.int64()),
             pa.array([b for _, b in marks], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64))),
             pa.array([len(own) - often for own, often in short], pa.int32())],
            ["doc_id", "n", "mark1", "mark2", "short", "cold"])


@frugal(keeps_cache=False)
def _linked(batches, width: int, percent: int):
    """Of pairs with both texts, those whose sets overlap enough; the shorter set is probed in the longer one."""
    for batch in batches:
        kept = []
        pairs = zip(shingle_sets(batch.column("text_a"), width), shingle_sets(batch.column("text_b"), width))
        for a, b in pairs:
            few, many = (a, b) if len(a) <= len(b) else (b, a)
            at = np.searchsorted(many, few)
            common = int((many[np.minimum(at, len(many) - 1)] == few).sum()) if len(few) else 0
            kept.append(common > 0 and 100 * common >= percent * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked ones of candidate pairs (a, b), by their whole texts.

    Texts are picked by the hash bins of the pairs' ids, at most 2^20 numbers, which go to every task; so only texts
    that are compared move, and a few that share a bin with them.
    """
    bin_ = lambda c: F.pmod(F.xxhash64(c), F.lit(ID_BINS)).cast("int").alias("bin")
    bins = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(bin_("id")).distinct()
    own = cut_lineage(texts.withColumn("bin", bin_("doc_id")).join(F.broadcast(bins), "bin", "left_semi").drop("bin"))
    left = join_on(pairs, own.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a", "inner")
    both = join_on(left, own.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b", "inner")
    return cut_lineage(both.select("a", "b", "text_a", "text_b").mapInArrow(
        lambda batches: _linked(batches, width, percent), "a bigint, b bigint"))


def _reach(percent: int) -> F.Column:
    """The largest size of a set that can be linked with this one if their first common shingle stands here.

    A pair overlaps in what follows its first common shingle at most, and needs percent * (n + other) / (100 + percent). So for the
    pair n + other <= (n - pos) (100 + percent) / percent has to hold on both sides.
    """
    return F.expr(f"(n - pos) * {100 + percent} div {percent} - n")


def _lists(entries: DataFrame, percent: int) -> DataFrame:
    """Entries that may have a partner in their list, written.

    One needs another member within its reach that reaches as far as itself. Lists of shingles that are counted as long are
    looked at in parts, so that no task gets a whole one; they are kept, and the next step looks at them as a whole.
    """
    dealt = entries.withColumns({
        "reach": _reach(percent), "salt": F.when(F.col("often"), F.pmod(F.xxhash64("doc_id"), F.lit(OFTEN_PARTS))).otherwise(0)})
    whole = Window.partitionBy("shingle", "salt")
    seen = dealt.withColumns({"length": F.count("*").over(whole), "least": F.min("n").over(whole), "most": F.max("reach").over(whole)})
    return cut_lineage(seen.filter("often OR length > 1 AND reach >= least AND n <= most").select(
        "doc_id", "n", "pos", "reach", "shingle"))


def _turn_mark(turn: int) -> int:
    """A number of 62 bits; ids in the order of their exclusive or with it begin with another one each turn."""
    return xxhash.xxh3_64_intdigest(b"turn %d" % turn) >> 2


def _mixed(lists: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Entries of lists whose members have several labels.

    Each entry has its list's most frequent label, the first member of it (another one in every turn), and the number of entries with
    other labels, now and before this turn. Entries without a partner in reach are dropped. All of it is added up
    by list and label first and joined back, so a long list is split.
    """
    entries = lists.select("doc_id", "n", "pos", "reach", "shingle", *([] if labels is None else [F.col("others").alias("before")]))
    order = F.col("doc_id").bitwiseXOR(F.lit(_turn_mark(turn)))
    bounds = [F.min("n").alias("least"), F.max("reach").alias("most")]
    if labels is None:
        # Every document has a label of its own.
        placed = entries.withColumns({"label": F.col("doc_id"), "before": F.lit(None).cast("bigint")})
        by_list = placed.groupBy("shingle").agg(
            F.count("*").alias("labels"),
            F.min(F.struct(order.alias("order"), "n")).alias("top"), *bounds).withColumns({
                "main": F.col("top.order").bitwiseXOR(F.lit(_turn_mark(turn))), "others": F.lit(None).cast("bigint")})
    else:
        placed = join_on(entries, labels, "doc_id").withColumn("label", F.coalesce("label", "doc_id"))
        by_label = placed.groupBy("shingle", "label").agg(
            F.count("*").alias("own"), F.min(F.struct(order.alias("order"), "n")).alias("first"), F.min("n").alias("least"),
            F.max("reach").alias("most"))
        by_list = by_label.groupBy("shingle").agg(
            F.sum("own").alias("all"), F.count("*").alias("labels"), F.max(F.struct("own", "label", "first")).alias("largest"),
            F.min("least").alias("least"), F.max("most").alias("most")).withColumns({
                "main": F.col("largest.label"), "top": F.col("largest.first"), "others": F.col("all") - F.col("largest.own")})
    by_list = by_list.filter("labels > 1").select(
        "shingle", "others", "main", F.col("top.order").bitwiseXOR(F.lit(_turn_mark(turn))).alias("first_id"),
        F.col("top.n").alias("first_n"), "least", "most")
    mixed = join_on(placed, cut_lineage(by_list), "shingle", "inner")
    return cut_lineage(mixed.filter("reach >= least AND n <= most").drop("least", "most"))


def _crowded() -> F.Column:
    """Whether an entry's list goes on to another turn: many of its members have other labels, and the last turn made them fewer.

    The first turn compares with members picked from unlinked ones, so all crowded lists get a second one.
    """
    return F.expr(f"others > {FEW_OTHERS} AND (before IS NULL OR others <= {1 - LEAST_GAIN} * before)")


def _pairs_with_first(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """One pair for each document: with the first member of a list, of those it may be linked with the one it shares most lists with."""
    candidates = mixed.filter(f"label <> main AND 100 * least(n, first_n) >= {percent} * greatest(n, first_n)").groupBy(
        F.col("doc_id").alias("a"), F.col("first_id").alias("b")).agg(F.count("*").alias("shared"))
    best = first_per_key(_bits_allow(candidates, sets, percent), ["a"], [F.desc("shared"), "b"])
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _remaining_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """All pairs across labels that may be linked, each found in the list of its first common shingle.

    Frequent shingles stand at the end of every set. A passage that very many sets share, but that is too short to link
    them, stands so far behind in them that none of its lists holds two entries within each other's reach. Members of a
    list's main label are not compared with one another, so a list costs its other members times its length.
    """
    reached = mixed.select("shingle", "doc_id", "n", "pos", "label", "reach", "main")
    other = reached.select("shingle", *[F.col(c).alias(f"other_{c}") for c in ("doc_id", "n", "pos", "label", "reach")])
    found = join_on(reached.filter("label <> main"), other, "shingle", "inner").filter(
        "label <> other_label AND n <= other_reach AND other_n <= reach AND (other_label = main OR doc_id < other_doc_id) "
        f"AND 100 * least(n, other_n) >= {percent} * greatest(n, other_n)")
    # What two sets have in common: the lists found, and what may follow the last of them on either side.
    side = lambda own, then: F.when(F.col("doc_id") < F.col("other_doc_id"), F.col(own)).otherwise(F.col(then))
    pairs = found.groupBy(
        F.least("doc_id", "other_doc_id").alias("a"), F.greatest("doc_id", "other_doc_id").alias("b"),
        side("n", "other_n").alias("n_a"), side("other_n", "n").alias("n_b")).agg(
        F.count("*").alias("shared"), F.max(side("pos", "other_pos")).alias("pos_a"), F.max(side("other_pos", "pos")).alias("pos_b"))
    return pairs.filter(f"{100 + percent} * (shared + least(n_a - 1 - pos_a, n_b - 1 - pos_b)) >= {percent} * (n_a + n_b)").select(
        "a", "b").distinct()


@frugal(keeps_cache=False)
def _possible(batches, columns: list[str], percent: int):
    """Rows of pairs whose bits leave room for the overlap that a link needs."""
    for batch in batches:
        kept = []
        for n, m, x, y in zip(*[batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")]):
            a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            # The longer one is folded: a shingle's place among fewer bits is its place among more of them, less the highest.
            while len(a) > len(b):
                a = a[:len(a) // 2] | a[len(a) // 2:]
            while len(b) > len(a):
                b = b[:len(b) // 2] | b[len(b) // 2:]
            most = min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))
            kept.append((100 + percent) * most >= percent * (n + m))
        yield batch.select(columns).filter(pa.array(kept, pa.bool_()))


def _bits_allow(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, ...) whose bits don't rule out that they overlap as much as a link needs.

    Every bit of one side that the other lacks is a shingle it lacks, so no linked pair is lost. Bits are a twelfth of a
    text, which spares most of the texts that would be compared in vain.
    """
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = join_on(join_on(pairs, side("a"), "a", "inner"), side("b"), "b", "inner")
    columns = pairs.columns
    return both.mapInArrow(lambda batches: _possible(batches, columns, percent), pairs.schema).distinct()


def _relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (doc_id, label) of all linked documents: the least document of the component that the links so far make.

    Links go between components that are known already, so only these are joined.
    """
    if labels is None:
        return cut_lineage(components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("label")))
    side = lambda c: labels.select(F.col("doc_id").alias(c), F.col("label").alias(f"label_{c}"))
    between = join_on(join_on(links, side("a"), "a"), side("b"), "b").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    joined = cut_lineage(components(between).select(F.col("node").alias("label"), "component"))
    # A document that had no link before is a component of its own name.
    known = labels.unionByName(joined.select(F.col("label").alias("doc_id"), "label")).distinct()
    return cut_lineage(join_on(known, joined, "label").select("doc_id", F.coalesce("component", "label").alias("label")))


def similar_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, text_hash and set_mark.

    Documents link when 100 * overlap >= percent * union of their sets of ``width``-word shingles. component_id is
    the least doc_id reachable by links, class_id the least doc_id with the same set. text_hash (xxhash64 of the text) and
    set_mark tell rows of one doc_id apart. Needs doc_id (integer) and text; other columns are ignored.

    Equal sets are joined first, by their 128-bit marks; only one document of each is searched. Every document is compared
    with one first member of its lists, and components grow; while a list holds many documents outside its main component, and a
    turn makes them fewer, these are compared with another member of that component. In the end all pairs are compared that
    could still join two components and whose sizes and places in the list let them overlap enough. So a group of near copies
    costs its size, and so does a passage that many documents share without being linked by it; no link between components is missed.

    A null text or one without words has an empty set and is alone. A row without doc_id is alone, with a null
    component. Repeated rows each get their row. An empty table gives no rows.
    """
    texts = docs.select("doc_id", "text")
    lengths = docs.sparkSession.sparkContext.broadcast(list_lengths(texts, width))
    filled = "n > 0 AND doc_id IS NOT NULL"
    # Sizes and marks are kept for the result. Short lists are large and pass on to the shuffle without being kept.
    sets = cut_lineage(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        lambda batches: _marks(batches, width),
        "doc_id bigint, text_hash bigint, n bigint, mark1 bigint, mark2 bigint, bits binary"))
    filled_sets = sets.filter(filled)
    short = texts.mapInArrow(
        lambda batches: _short_lists(batches, lengths.value, width, percent),
        "doc_id bigint, n bigint, mark1 bigint, mark2 bigint, short array<bigint>, cold int").filter(filled)
    entries = first_per_key(short, ["mark1", "mark2"], ["doc_id"]).select(
        "doc_id", "n", "cold", F.posexplode("short").alias("pos", "shingle")).select(
        "doc_id", "n", "pos", "shingle", (F.col("pos") >= F.col("cold")).alias("often"))
    labels, left, first_left = None, [], None
    mixed = _mixed(_lists(entries, percent), None, 0)
    for turn in range(1, MOST_TURNS + 1):
        labels = _relabelled(labels, _verify(cut_lineage(_pairs_with_first(mixed, filled_sets, percent)), texts, width, percent))
        mixed = _mixed(mixed, labels, turn)
        entries_left, pairs = mixed.agg(F.count("*"), F.coalesce(F.sum(F.when(_crowded(), F.col("others"))), F.lit(0))).head()
        first_left = entries_left if turn == 1 else first_left
        if pairs <= PAIRS_PER_ENTRY * first_left:
            break
        # All entries of a list leave together, with labels that may be joined later on: that only costs comparisons.
        left.append(mixed.filter(~_crowded()))
        mixed = mixed.filter(_crowded())
    likely = _bits_allow(_remaining_pairs(reduce(DataFrame.unionByName, [*left, mixed]), percent), filled_sets, percent)
    groups = _relabelled(labels, _verify(cut_lineage(likely), texts, width, percent))
    classes = first_per_key(sets.filter(filled), ["mark1", "mark2"], ["doc_id"])
    named = join_on(classes.select(F.col("doc_id").alias("class_id"), "mark1", "mark2"),
                    groups.select(F.col("doc_id").alias("class_id"), F.col("label").alias("component")), "class_id")
    joined = join_on(sets.filter(filled), named, ["mark1", "mark2"])
    alone = sets.filter("n = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"),
        "text_hash", F.col("mark1").alias("set_mark"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.coalesce("component", "class_id", "doc_id").alias("component_id"),
                         F.coalesce("class_id", "doc_id").alias("class_id"), "text_hash",
                         F.col("mark1").alias("set_mark")).unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id, once.

    Documents without words are alone, and rows without doc_id stay. Where one doc_id stands for different texts, each text
    is judged by its own links: only rows with an equal set, or whose set is linked with another document's, go.
    """
    found = similar_documents(docs).filter("component_id = doc_id")
    # The least text of each set that a component's first document has; sets of one id that aren't linked stay both.
    firsts = first_per_key(found.select("doc_id", "set_mark", "text_hash"), ["doc_id", "set_mark"], ["text_hash"]).select("doc_id", "text_hash")
    hashed = docs.withColumn(_HASH, F.xxhash64("text"))
    kept = join_on(hashed, firsts.withColumnRenamed("text_hash", _HASH), ["doc_id", _HASH], "left_semi")
    once = first_per_key(kept, ["doc_id", _HASH], [F.xxhash64(*docs.columns), *docs.columns])
    return once.drop(_HASH).unionByName(docs.filter("doc_id IS NULL"))

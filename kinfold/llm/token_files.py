"""Token ids as flat unsigned integer files with 64-bit document offsets, written by ranges of doc_id.

For every range there are three files: ``.bin`` with the ids of its documents one after another (16 bits where
the vocabulary allows it, otherwise 32, little-endian), ``.idx`` with n + 1 offsets into it, counted in ids, and
``.doc`` with the n document ids. Documents without an id come first in a range. A manifest table has one row per range
and counts these; the running sum of its counts is the base
of each range, so that offsets of a range become positions in the whole corpus. Readers map the files into memory.
"""

from __future__ import annotations

import math
from array import array
from functools import lru_cache, reduce
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import cut_lineage, new_folder, open_folder, publish
from kinfold.llm.tokens import AFTER_SPACE, LATIN, Cache, fast_tokenizer, finer_pieces, space_pieces, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
RANGE_BYTES = 64 << 20
JOINED = 2000
# Letters of all editions of Unicode below U+0250, and ASCII signs behind them but the apostrophe; see ``finer_pieces``.
SIGNED_WORD = (r"^(?P<stem>[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)"
               r"(?P<tail>[!-&(-/:-@\[-`{-~]+)$")
_pieces = Cache()


@lru_cache(maxsize=4)
def cuts_words(path: str) -> bool:
    """Whether the library matches words behind spaces one by one, and keeps the space: true for byte-level vocabularies."""
    found = fast_tokenizer(path).encode(" one two", add_special_tokens=False)
    return fast_tokenizer(path).decode(found.ids) == " one two" and len(set(found.word_ids)) == 2


def id_type(vocabulary_size: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")


def _encoded(parts: list[str], path: str, code: str) -> list[bytes]:
    """Ids of unknown pieces by the library.

    Words behind a space are each a match of the pattern, so many of them are given as one text and its ids cut where the
    match changes; everything else is given alone.
    """
    tokenizer = fast_tokenizer(path)
    found: dict[str, bytes] = {}
    words = [p for p in parts if p[0] == " " and p[1:].isalpha() and max(p) < LATIN] if cuts_words(path) else []
    for low in range(0, len(words), JOINED):
        own = words[low:low + JOINED]
        whole = tokenizer.encode("".join(own), add_special_tokens=False)
        match = np.array(whole.word_ids, np.int64)
        ends = [0, *(np.flatnonzero(match[1:] != match[:-1]) + 1).tolist(), len(match)]
        if len(ends) != len(own) + 1:
            continue  # some of them were not cut as expected: all are given alone
        ids = array(code, whole.ids).tobytes()
        size = array(code).itemsize
        found.update(zip(own, [ids[size * x:size * y] for x, y in zip(ends, ends[1:])]))
    rest = [p for p in parts if p not in found] if found else parts
    found.update(zip(rest, [array(code, e.ids).tobytes() for e in tokenizer.encode_batch_fast(rest, add_special_tokens=False)]))
    return [found[p] for p in parts]


def _looked_up(pieces: list[str], path: str, code: str, whole: frozenset[str] = frozenset()) -> list[bytes]:
    """Ids of pieces from the cache; one that isn't known yet is put together from finer ones, most of which are."""
    def answer(parts: list[str]) -> list[bytes]:
        cut = [[p] if p in whole else finer_pieces(p) for p in parts]
        found = _pieces.lookup(list(chain.from_iterable(cut)), lambda new: _encoded(new, path, code), (path, code))
        ends = list(accumulate(map(len, cut), initial=0))
        return [found[a] if b == a + 1 else b"".join(found[a:b]) for a, b in zip(ends, ends[1:])]

    return _pieces.lookup(pieces, answer, (path, code))


def encode_batch(texts: pa.Array, path: str, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and how many each has.

    Texts are cut at spaces and their distinct pieces numbered by Arrow; only these are looked up, and the ids of all
    pieces are taken from theirs. A text with a special token's string goes in whole, as the library would look for it
    there, and one with white space before a space is cut by ``space_pieces``.
    """
    code = {2: "H", 4: "I"}[dtype.itemsize]
    texts = texts.fill_null("")
    special = [t.content for t in fast_tokenizer(path).get_added_tokens_decoder().values()]
    whole = reduce(pc.or_, [pc.match_substring(texts, s) for s in special], pa.array([False] * len(texts), pa.bool_()))
    odd = pc.or_(whole, pc.match_substring_regex(texts, AFTER_SPACE))
    cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
    first = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
    pieces = cut.flatten()
    leads = np.zeros(len(pieces), bool)
    leads[first] = True
    numbered = pieces.filter(pa.array(~leads)).dictionary_encode()
    # A word and the signs behind it are looked up one by one: most words are known without them.
    signed = pc.extract_regex(numbered.dictionary, SIGNED_WORD)
    stems = pc.coalesce(pc.struct_field(signed, "stem"), numbered.dictionary).dictionary_encode()
    tails = pc.fill_null(pc.struct_field(signed, "tail"), "").dictionary_encode()
    blobs = _looked_up([" " + w for w in stems.dictionary.to_pylist()], path, code)
    behind = tails.dictionary.to_pylist()
    known = _looked_up([t for t in behind if t], path, code)
    if "" in behind:
        known.insert(behind.index(""), b"")
    words = np.column_stack([np.asarray(stems.indices), len(blobs) + np.asarray(tails.indices)])
    blobs += known
    # What stands before the first space, or the whole of a text that is not cut there.
    heads = pieces.take(pa.array(first)).to_pylist()
    plain = _looked_up([h or " " for h in heads], path, code)
    for i, (head, strange) in enumerate(zip(heads, odd.to_pylist())):
        if strange:
            text = texts[i].as_py()
            plain[i] = b"".join(_looked_up([text], path, code, frozenset([text])) if whole[i].as_py() else
                                _looked_up(space_pieces(text), path, code))
        elif not head:
            plain[i] = b""
    # Two codes for each piece; a head has nothing behind it.
    codes = np.full((len(pieces), 2), len(blobs), np.int64)
    codes[~leads] = words[np.asarray(numbered.indices)]
    codes[first, 0] = len(blobs) + 1 + np.arange(len(first))
    blobs.append(b"")
    blobs += plain
    size = np.array(list(map(len, blobs)), np.int64) // dtype.itemsize
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    every = np.frombuffer(b"".join(blobs), dtype)
    codes = codes.ravel()
    long = size[codes]
    ends = np.cumsum(long)
    ids = every[np.repeat(start[codes] - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)]
    counts = np.add.reduceat(long, 2 * first) if len(first) else np.zeros(0, np.int64)
    return ids, counts


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _grouped(batches, rows: int = 2048, size: int = 8 << 20):
    """Batches put together, so that a distinct piece is looked up less often."""
    held, n, bytes_ = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, bytes_ = n + batch.num_rows, bytes_ + batch.nbytes
        if n >= rows or bytes_ >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n, bytes_ = [], 0, 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _write(batches, folder: str, path: str, end_id: int):
    dtype = id_type(fast_tokenizer(path).get_vocab_size())
    files, root = open_folder(folder)
    context = TaskContext.get()
    part, attempt = context.partitionId(), context.taskAttemptId()
    name, sizes, docs = f"range-{part:06d}", [], []
    nulls = 0

    def ids():
        nonlocal nulls
        for table in _grouped(batches):
            nulls += table.column("doc_id").null_count
            own = table.column("doc_id").to_pylist()
            found, counts = encode_batch(_one(table.column("text")), path, dtype)
            sizes.extend((counts + 1).tolist())
            # The end id goes behind each document.
            yield np.insert(found, np.cumsum(counts), end_id).astype(dtype).tobytes()
            docs.extend(0 if d is None else d for d in own)

    publish(files, root, f"{name}.bin", str(attempt), ids())
    if sizes:
        publish(files, root, f"{name}.idx", str(attempt), [np.cumsum([0, *sizes]).astype("<i8").tobytes()])
        publish(files, root, f"{name}.doc", str(attempt), [np.array(docs, "<i8").tobytes()])
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([name]), pa.array([len(sizes)], pa.int64()),
         pa.array([sum(sizes)], pa.int64()), pa.array([dtype.itemsize], pa.int32()), pa.array([nulls], pa.int64())],
        ["place", "name", "n_docs", "n_ids", "width", "n_nulls"])


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text; other columns are ignored) to ``folder``; gives the manifest.

    Documents are in ascending doc_id, those without one first; equal ids are in the order of their text's hash.
    A null text is empty and has the end id only. Repeated rows are documents of their own. Ranges hold about
    ``range_bytes`` of text each; equal ids may be split, so none is larger for them. A task that runs again
    writes the same files.
    """
    path = vocabulary_path(vocabulary)
    # Where a row stands in its input tells rows of the same id and text apart, so these are split as well.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("at"))
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    ranged = rows.repartitionByRange(max(1, math.ceil(size / range_bytes)), "doc_id", "mark", "at")
    manifest = cut_lineage(ranged.sortWithinPartitions("doc_id", "mark", "at").select("doc_id", "text").mapInArrow(
        lambda batches: _write(batches, folder, path, end_id),
        "place int, name string, n_docs bigint, n_ids bigint, width int, n_nulls bigint"))
    # One row per file; its running sum is small work for one task.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.filter("n_docs > 0").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _mapped(files, path: str, dtype: str) -> np.ndarray:
    """A file as an array: mapped into memory where the store is local, read where it is not."""
    if files.type_name == "local":
        return np.memmap(path, dtype, "r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype)


def _read(batches, folder: str, step_bytes: int = 8 << 20):
    files, root = open_folder(folder)
    for batch in batches:
        for row in batch.to_pylist():
            ids = _mapped(files, f"{root}/{row['name']}.bin", f"<u{row['width']}")
            offsets = _mapped(files, f"{root}/{row['name']}.idx", "<i8")
            docs = _mapped(files, f"{root}/{row['name']}.doc", "<i8")
            low = 0
            while low < len(docs):
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + step_bytes // 4, "right")) - 1)
                part = np.asarray(ids[offsets[low]:offsets[high]]).astype("<u4")
                bounds = (np.asarray(offsets[low:high + 1]) - offsets[low])
                own = np.asarray(docs[low:high])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64(), mask=np.arange(low, high) < row["n_nulls"]), pa.array(row["base"] + np.asarray(offsets[low:high])),
                     pa.array(np.diff(bounds), pa.int64()),
                     pa.Array.from_buffers(pa.large_binary(), high - low,
                                           [None, pa.py_buffer((bounds * 4).astype(np.int64)), pa.py_buffer(part)]
                                           ).cast(pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])
                low = high


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of token files: doc_id, start (place in the corpus), n_tokens and ids (little-endian 32-bit)."""
    count = max(1, manifest.count())
    return manifest.repartition(count, "place").mapInArrow(
        lambda batches: _read(batches, folder), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Documents written as token files in the shared folder and read back from them."""
    folder = new_folder(spark, "tokens")
    return read_tokens(cut_lineage(write_tokens(docs, folder, vocabulary, end_id)), folder)

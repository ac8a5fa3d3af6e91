"""Token counts by a two-tier lookup on the map side: a broadcast table of frequent pre-tokens, then worker caches.

Pre-tokens are cut where no piece of the vocabulary can reach across, so the counts of a text's pre-tokens add up to
its own. The first tier is filled from counts over all documents: every task reports its most frequent pre-tokens,
at most ``PER_TASK`` of them, and the sums of these reports give the table. The pre-tokens of the
documents themselves are never shuffled. The table only saves time; it never changes a count.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.tokens import Cache, piece_model, vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
PER_TASK = 4096
TABLE_ENTRIES = 1 << 15
LONGEST = 32
SPACE = "▁"
_lengths = Cache()


@lru_cache(maxsize=4)
def splitter(path: str):
    """A pattern whose matches are the pre-tokens of a model, after spaces have become its space mark.

    It may cut after a character before a space mark if no piece has a space mark behind another character, and
    around white space characters that no longer piece holds. Both are read from the vocabulary.
    """
    model = piece_model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        return re.compile(r"(?s).+")
    alone = "".join(c for c in "\t\n\r\v\f" if not any(c in p and len(p) > 1 for p in pieces))
    own = f"|[{re.escape(alone)}]" if alone else ""
    return re.compile(f"{SPACE}*[^{SPACE}{re.escape(alone)}]+|{SPACE}+{own}")


def pre_tokens(text: str, path: str) -> list[str]:
    """The pre-tokens of a text; the model itself puts a space mark before every text that isn't empty."""
    return splitter(path).findall(SPACE + text.replace(" ", SPACE)) if text else []


@lru_cache(maxsize=4)
def _mark_length(path: str) -> int:
    """Tokens of a text that begins a line break followed by nothing: what a dummy prefix costs, see ``lengths``."""
    return len(piece_model(path).encode("\n"))


def lengths(parts: list[str], path: str) -> list[int]:
    """Tokens of each pre-token.

    The model puts a space mark before what it is given. One that begins with such a mark is given without it; any
    other one, which follows a line break, is given behind a line break whose tokens are taken off.
    """
    model, mark = piece_model(path), _mark_length(path)
    texts = [p[1:] if p[0] == SPACE else "\n" + p for p in parts]
    return [(len(ids) if p[0] == SPACE else len(ids) - mark) if p != SPACE else _lone_mark(path)
            for p, ids in zip(parts, model.encode(texts, num_threads=1))]


@lru_cache(maxsize=4)
def _lone_mark(path: str) -> int:
    """Tokens of a single space mark, which the model can't be given alone."""
    return _mark_length(path) - len(piece_model(path).encode("\n\n")) + _mark_length(path)


def _report(batches, path: str, per_task: int):
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").fill_null("").to_pylist():
            seen.update(pre_tokens(text, path))
        if len(seen) > 8 * per_task + 200_000:
            seen = Counter(dict(seen.most_common(4 * per_task)))
    top = [(p, n) for p, n in seen.most_common(per_task) if len(p) <= LONGEST and n > 1]
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                                     ["piece", "n"])


def frequent_lengths(texts: DataFrame, path: str, entries: int = TABLE_ENTRIES, per_task: int = PER_TASK) -> dict[str, int]:
    """Token counts of the ``entries`` most frequent pre-tokens: at most 32 characters each, so a few megabytes."""
    reports = texts.select("text").mapInArrow(lambda batches: _report(batches, path, per_task), "piece string, n bigint")
    top = reports.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries)
    pieces = [r.piece for r in top.collect()]
    return dict(zip(pieces, lengths(pieces, path)))


def _count(batches, path: str, frequent: dict[str, int]):
    for batch in batches:
        counts = []
        for text in batch.column("text").fill_null("").to_pylist():
            parts = pre_tokens(text, path)
            found = list(map(frequent.get, parts, repeat(-1)))
            total = sum(found)
            if -1 in found:
                misses = [p for p, n in zip(parts, found) if n < 0]
                total += len(misses) + sum(_lengths.lookup(misses, lambda new: lengths(new, path), path))
            counts.append(total)
        yield pa.RecordBatch.from_arrays([*batch.drop_columns(["text"]).columns, pa.array(counts, pa.int64())],
                                         [*batch.drop_columns(["text"]).schema.names, "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs`` (doc_id, text; other columns are ignored).

    Tokens are those of the sentencepiece library for the whole text, without begin or end. A null or empty text
    has none. Repeated rows each get their row; an empty table gives no rows.
    """
    path = vocabulary_path(vocabulary)
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(rows, path))
    return rows.mapInArrow(lambda batches: _count(batches, path, frequent.value),
                           "doc_id bigint, n_bytes bigint, n_tokens bigint")

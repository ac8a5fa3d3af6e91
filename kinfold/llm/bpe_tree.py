"""Byte-level BPE as a tree reduction over halves of a text.

An encoding is an element of a monoid: two neighbours are joined by encoding a window around their border anew, and
the window grows until the tokens outside it can't change. Two facts make that certain.

* Text: a match of the pattern ends wherever a letter, a digit or a symbol is followed by a character its run can't
  take, whatever stands before it, and the pattern never looks back. Tokens before the last such place of the
  left text and after the first one of the right text are final.
* Bytes of one match: tokens t1 ... tn are the encoding of their bytes exactly if every two neighbours encode to
  themselves. The first merge across a border would need the pair around it to merge as well. So a window is
  large enough when its first and last tokens get on with those next to it.

Decoding joins the bytes of token halves up the same kind of tree.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import frugal
from kinfold.llm.tokens import rank_encoding, ranks, vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF_CHARS = 4096
LEAF_BYTES = 2048
LEAF_TOKENS = 4096
WINDOW_CHARS = 64
WINDOW_TOKENS = 8
# Unassigned characters are left out: another version of the character tables may call them letters.
_BORDER = regex.compile(r"(?<=\p{L})(?=[^\p{L}\p{Cn}])|(?<=\p{N})(?=[^\p{N}\p{Cn}])"
                        r"|(?<=[^\s\p{L}\p{N}\p{Cn}])(?=[ \t\r\n\p{N}])")
_MATCHES = regex.compile(public_tokenizers.PATTERN)


class TreeEncoder:
    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES,
                 window_chars: int = WINDOW_CHARS, window_tokens: int = WINDOW_TOKENS):
        self.library, self.ranks = rank_encoding(path), ranks(path)
        self.size = np.zeros(max(self.ranks.values()) + 1, np.int64)
        self.bytes = [b""] * len(self.size)
        for token, rank in self.ranks.items():
            self.size[rank], self.bytes[rank] = len(token), token
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        self.window_chars, self.window_tokens = window_chars, window_tokens
        self._pairs: dict[tuple[int, int], bool] = {}

    # Bytes of one match of the pattern.

    def _merge(self, data: bytes) -> list[int]:
        """The merges of a stretch of bytes. The library takes a whole token for granted, so those are merged here."""
        if data not in self.ranks:
            return self.library._core_bpe.encode_single_piece(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            best = min((r for r in found if r is not None), default=None)
            if best is None:
                break
            i = found.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _together(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) > 1 << 16:
                self._pairs.clear()
            known = self._merge(self.bytes[left] + self.bytes[right]) == [left, right]
            self._pairs[left, right] = known
        return known

    def _merge_tree(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf_bytes:
            return self._merge(data)
        half = len(data) // 2
        return self._join_tokens(self._merge_tree(data[:half]), self._merge_tree(data[half:]))

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if self._together(left[-1], right[0]):
            return left + right
        reach = self.window_tokens
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            data = b"".join(self.bytes[t] for t in left[a:] + right[:b])
            whole = a == 0 and b == len(right)
            window = self._merge_window(data, whole)
            if (a == 0 or self._together(left[a - 1], window[0])) and (
                    b == len(right) or self._together(window[-1], right[b])):
                return left[:a] + window + right[b:]
            reach *= 2

    def _merge_window(self, data: bytes, whole: bool) -> list[int]:
        """A window's own encoding; long ones go back to the tree unless they are all there is."""
        if len(data) <= self.leaf_bytes or whole:
            return self._merge(data)
        return self._merge_tree(data)

    def encode_match(self, match: str) -> list[int]:
        data = match.encode()
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self._merge_tree(data)

    # Texts.

    def _leaf(self, text: str) -> list[int]:
        """A short text by the library; one whose matches may be long, match by match."""
        if len(text) <= self.leaf_chars:
            return self.library.encode_ordinary(text)
        return [t for match in _MATCHES.findall(text) for t in self.encode_match(match)]

    def encode(self, text: str) -> list[int]:
        """Ids of a text: those of its halves, joined."""
        if len(text) <= self.leaf_chars or _BORDER.search(text, 1) is None:
            return self._leaf(text)
        half = len(text) // 2
        return self._join_texts(text[:half], self.encode(text[:half]), text[half:], self.encode(text[half:]))

    def _join_texts(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        a = self._last_border(left)
        found = _BORDER.search(right, 1)
        b = found.start() if found else len(right)
        window = left[a:] + right[:b]
        # With no border on a side its window is all of that side; a border of the whole inside it is as good.
        middle = self.encode(window) if len(window) < len(left) + len(right) else self._leaf(window)
        return (self._without(left_ids, len(left[a:].encode()), last=True) + middle
                + self._without(right_ids, len(right[:b].encode()), last=False))

    def _last_border(self, text: str) -> int:
        """The last border of a text, sought in windows that grow to the left; 0 if there is none."""
        reach = self.window_chars
        while True:
            low = max(0, len(text) - reach)
            found = [m.start() for m in _BORDER.finditer(text, low + 1 if low else 1)]
            if found or not low:
                return found[-1] if found else 0
            reach *= 2

    def _without(self, ids: list[int], size: int, last: bool) -> list[int]:
        """The ids that remain when the tokens of the last or first ``size`` bytes go."""
        gone = 0
        n = 0
        while gone < size:
            n += 1
            gone += self.size[ids[-n] if last else ids[n - 1]]
        if gone != size:
            raise AssertionError("a border lies within a token")
        return ids[:len(ids) - n] if last else ids[n:]

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return b"".join(map(self.bytes.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_encoders: dict[str, TreeEncoder] = {}


def encoder(path: str) -> TreeEncoder:
    if path not in _encoders:
        _encoders[path] = TreeEncoder(path)
    return _encoders[path]


def _in_steps(batches, rows: int = 512):
    for batch in batches:
        for low in range(0, len(batch), rows):
            yield batch.slice(low, rows)


@frugal(keeps_cache=False)
def _encode(batches, path: str):
    own = encoder(path)
    for batch in _in_steps(batches):
        ids = [np.array(own.encode(t), "<u4") for t in batch.column("text").fill_null("").to_pylist()]
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
            [*rest.schema.names, "n_tokens", "ids"])


@frugal(keeps_cache=False)
def _decode(batches, path: str):
    own = encoder(path)
    for batch in _in_steps(batches):
        texts = [own.decode(np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian 32-bit) of every row of ``docs`` (doc_id, text; others are ignored).

    A null text is empty and has no ids. Repeated rows each get their row; an empty table gives no rows. Nothing
    is shuffled; a text of any length is encoded in the task that reads it, with memory in proportion to it.
    """
    path = vocabulary_path(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _encode(batches, path),
                                                    "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with the bytes of its ids as column decoded; null ids count as none."""
    path = vocabulary_path(vocabulary)
    rows = encoded.select(*[F.coalesce("ids", F.lit(b"")).alias("ids") if c == "ids" else F.col(c) for c in encoded.columns])
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", decoded binary"
    return rows.mapInArrow(lambda batches: _decode(batches, path), schema)

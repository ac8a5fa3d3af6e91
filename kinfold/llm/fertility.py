"""Quality rules on how well public vocabularies fit a text: characters per token, byte fallbacks, token entropy.

Prose of a language that a vocabulary knows takes a few characters per token, rarely falls back to bytes, and spreads
over many tokens. Encoded data, noise and repetition leave these bands. Bands are stated per language, or per script
where the language is unknown, and leave room on both sides; they are parameters.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import frugal
from kinfold.llm.tokens import Cache, piece_model, rank_encoding, vocabulary_path
from kinfold.llm.words import SPACED, Words, windows, word_groups

PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"
RUN = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
_SYMBOLS = np.array([chr(c) in "#*$%&|<>" for c in range(256)])
_words = Cache(entries=400_000)


@dataclass(frozen=True)
class Band:
    """Accepted values: characters per token of the pieces, of the ranks, of either, share of byte tokens, bits of token entropy."""

    least_pieces: float
    least_ranks: float
    most_chars: float
    most_bytes: float
    least_entropy: float


# Lower bounds: the least value among texts labelled good at sf0.1 that pass the base rules (2013 en, 488 de, 490 fr, 311 es),
# less 8 % for characters and 20 % for entropy, which short texts lower. Such texts reach 2.5 characters a token only, being
# invented; real prose takes more, yet never more than its word length, which bounds it from above. No text there falls
# back to bytes; 5 % leave room for foreign signs. An unknown Latin language gets the widest of the four. No text of
# the given tables is in another script: those bands leave a quarter below, and as many bytes above, what the first article
# of the Universal Declaration of Human Rights takes in languages of the script. What is in none of them has a wide band.
BANDS = {
    "en": Band(1.62, 1.82, 5.5, 0.05, 3.95),
    "de": Band(1.88, 1.93, 6.0, 0.05, 4.0),
    "fr": Band(1.52, 1.66, 5.5, 0.05, 4.4),
    "es": Band(1.62, 1.76, 5.5, 0.05, 4.3),
    "latin": Band(1.52, 1.66, 6.0, 0.05, 3.95),
    "cyrillic": Band(1.6, 1.55, 6.0, 0.05, 3.95),
    "greek": Band(0.65, 1.27, 5.5, 0.05, 3.3),
    "arabic": Band(0.68, 1.15, 5.5, 0.05, 3.3),
    "hebrew": Band(0.62, 1.1, 5.5, 0.05, 3.0),
    "devanagari": Band(0.58, 0.58, 5.5, 0.2, 3.4),
    "thai": Band(0.7, 0.75, 5.5, 0.15, 3.8),
    "han": Band(0.65, 0.62, 5.5, 0.2, 4.2),
    "hangul": Band(0.57, 0.78, 5.5, 0.15, 3.8),
    "other": Band(0.25, 0.25, 6.0, 0.9, 2.5),
}
# The first code point of ranges, and the script of each up to the next one. Kana goes with Han, as Japanese has both.
_RANGES = [(0, None), (0x41, "latin"), (0x250, None), (0x370, "greek"), (0x400, "cyrillic"), (0x530, None), (0x590, "hebrew"),
           (0x600, "arabic"), (0x700, None), (0x900, "devanagari"), (0x980, None), (0xE00, "thai"), (0xE80, None), (0x1100, "hangul"),
           (0x1200, None), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, None), (0x3040, "han"), (0x3100, None), (0x3130, "hangul"),
           (0x3190, None), (0x3400, "han"), (0xA000, None), (0xAC00, "hangul"), (0xD7B0, None), (0xF900, "han"), (0xFB00, None),
           (0xFB50, "arabic"), (0xFE00, None), (0x20000, "han"), (0x32000, None)]
_STARTS = np.array([start for start, _ in _RANGES])
_SCRIPTS = [script for _, script in _RANGES]


def script_of(text: str) -> str:
    """The script of most of a text's letters, "other" where most are in none of those with a band; ASCII signs don't count."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    points = points[(points >= 0x41) & ~((points > 0x5A) & (points < 0x61)) & ~((points > 0x7A) & (points < 0xAA))]
    found = np.bincount(np.searchsorted(_STARTS, points, "right") - 1, minlength=len(_RANGES))
    counts: dict[str, int] = {}
    for script, n in zip(_SCRIPTS, found.tolist()):
        counts[script or "other"] = counts.get(script or "other", 0) + n
    return max(counts, key=counts.get)


def band_of(lang: str | None, text: str | None, text_bytes: int, bands: dict[str, Band]) -> Band:
    """By language where it has a band, otherwise by script. Bytes tell Latin letters, which take 1 or 2 a character."""
    if lang in bands:
        return bands[lang]
    if text_bytes <= 1.4 * max(1, len(text or "")):
        return bands["latin"]
    return bands.get(script_of(text), bands["other"])


def _repeated(runs: np.ndarray, length: int) -> int:
    """Entries that lie in a run found twice or more."""
    ordered = np.sort(runs)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    start = np.flatnonzero(np.isin(runs, twice))
    change = np.bincount(start, minlength=len(runs) + length) - np.bincount(start + length, minlength=len(runs) + length)
    return int((np.cumsum(change) > 0).sum())


def _duplicate_lines(text: str | None) -> int:
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\v\f")]
    return len(lines) - len(set(lines))


def _base(group: Words, texts: list[str | None]) -> dict[str, list[int]]:
    """The base counts of every text of a group."""
    points = np.concatenate([[0], np.cumsum((group.data & 0xC0) != 0x80)])
    chars = np.concatenate([[0], np.cumsum(points[group.end] - points[group.start])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[group.data])])
    ends = np.append(group.text_start[1:], len(group.data))
    runs = windows(group.hashes(), RUN)
    first = group.first
    return {
        "n_words": np.diff(first).tolist(),
        "word_chars": np.diff(chars[first]).tolist(),
        "n_symbols": (symbols[ends] - symbols[group.text_start]).tolist(),
        "n_dup_lines": [_duplicate_lines(t) for t in texts],
        "n_repeat_words": [_repeated(runs[a:b - RUN + 1], RUN) if b - a > RUN else 0 for a, b in zip(first, first[1:])],
    }


def _answers(words: list[str], pieces, encoding) -> list[bytes]:
    """Per word, as 32-bit numbers: ids of the piece model, its byte tokens, and tokens of the rank vocabulary."""
    found = pieces.encode(words, num_threads=1)
    return [array("I", [*ids, sum(map(pieces.is_byte, ids)), len(encoding.encode_ordinary(" " + w))]).tobytes()
            for w, ids in zip(words, found)]


def fit(words: list[str], chars: int, pieces, encoding, key=None) -> tuple[float, float, float, float]:
    """Characters per token of both vocabularies, share of byte tokens, and entropy in bits; ``key`` names the vocabularies."""
    if not words:
        return 0.0, 0.0, 0.0, 0.0
    found = _words.lookup(words, lambda new: _answers(new, pieces, encoding), key)
    numbers = np.frombuffer(b"".join(found), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)
    by_ranks, in_bytes = int(numbers[ends - 1].sum()), int(numbers[ends - 2].sum())
    own = np.ones(len(numbers), bool)
    own[ends - 1] = own[ends - 2] = False
    share = np.bincount(numbers[own])
    n = len(numbers) - 2 * len(found)
    share = share[share > 0] / n
    return chars / n, chars / max(1, by_ranks), in_bytes / n, float(-(share * np.log2(share)).sum())


def within(band: Band, by_pieces: float, by_ranks: float, bytes_: float, entropy: float) -> bool:
    return (band.least_pieces <= by_pieces <= band.most_chars and band.least_ranks <= by_ranks <= band.most_chars
            and bytes_ <= band.most_bytes and entropy >= band.least_entropy)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_FIT = ["chars_per_piece", "chars_per_rank_token", "byte_share", "entropy"]


def _measure(batches, paths: tuple[str, str], bands: dict[str, Band]):
    pieces, encoding = piece_model(paths[0]), rank_encoding(paths[1])
    for batch in batches:
        column = batch.column("text")
        langs = batch.column("lang").to_pylist()
        for group in word_groups(column, SPACED):
            texts = column.slice(group.low, group.high - group.low).to_pylist()
            counts = _base(group, texts)
            fits, kept, failed = [], [], []
            for i in range(len(texts)):
                n, chars = counts["n_words"][i], counts["word_chars"][i]
                words = group.data[group.text_start[i]:group.text_start[i + 1] if i + 1 < len(texts) else None].tobytes()
                fits.append(fit(_split(words), chars, pieces, encoding, paths))
                failed.append(n < LEAST_WORDS or 100 * counts["n_repeat_words"][i] > MOST_REPEATED * n)
                band = band_of(langs[group.low + i], texts[i], len(words), bands)
                kept.append(not failed[-1] and within(band, *fits[-1]))
            rest = batch.slice(group.low, len(texts)).drop_columns(["text", "lang"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, *[pa.array(counts[c], pa.int64()) for c in _COUNTS],
                 *[pa.array([f[k] for f in fits], pa.float64()) for k in range(len(_FIT))],
                 pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())],
                [*rest.schema.names, *_COUNTS, *_FIT, "base_failed", "kept"])


@frugal(keeps_cache=True)
def _kept(batches, text: str, paths: tuple[str, str], bands: dict[str, Band]):
    """The rows of whole batches that the rules keep."""
    for batch in batches:
        langs = batch.column("lang") if "lang" in batch.schema.names else pa.nulls(len(batch), pa.string())
        narrow = pa.RecordBatch.from_arrays([pa.array(range(len(batch)), pa.int64()), batch.column(text), langs.cast(pa.string())],
                                            ["doc_id", "text", "lang"])
        yield batch.filter(pa.array([k for part in _measure([narrow], paths, bands) for k in part.column("kept").to_pylist()],
                                    pa.bool_()))


def _split(text: bytes) -> list[str]:
    """The words of a text's bytes; bytes split at ASCII white space only."""
    words = text.split()
    return b" ".join(words).decode().split(" ") if words else []


def measure(docs: DataFrame, bands: dict[str, Band] = BANDS, pieces: str = PIECES, ranks: str = RANKS) -> DataFrame:
    """doc_id, the base counts, the fit to the vocabularies, base_failed and kept of every row of ``docs``.

    Needs doc_id and text, and uses lang where there is one; other columns are ignored. kept is false for texts of
    fewer than 20 words or with over 30 % of words in repeated runs of eight, and for those outside their band.
    A null or empty text has no words and fails. Repeated rows each get their row; an empty table gives no rows.
    Nothing is shuffled.
    """
    paths = (vocabulary_path(pieces), vocabulary_path(ranks))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    schema = ("doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", "
              + ", ".join(f"{c} double" for c in _FIT) + ", base_failed boolean, kept boolean")
    return docs.select("doc_id", "text", lang.alias("lang")).mapInArrow(
        lambda batches: _measure(batches, paths, bands), schema)


def keep(docs: DataFrame, bands: dict[str, Band] = BANDS, pieces: str = PIECES, ranks: str = RANKS) -> DataFrame:
    """The rows of ``docs`` that ``measure`` keeps, with all their columns, in one pass."""
    paths = (vocabulary_path(pieces), vocabulary_path(ranks))
    return docs.mapInArrow(lambda batches: _kept(batches, "text", paths, bands), docs.schema)

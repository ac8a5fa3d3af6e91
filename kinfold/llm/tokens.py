"""Tokenisers in tasks: loaded once per worker, and answers for repeated pieces of text kept in a bounded cache."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import public_tokenizers

CACHE_ENTRIES = 800_000
CACHED_LENGTH = 48


def vocabulary_path(name: str) -> str:
    """A path is taken as it is, a bare name is one of the public vocabularies."""
    return name if os.sep in name else public_tokenizers.path(name)


@lru_cache(maxsize=4)
def fast_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def rank_encoding(path: str):
    import tiktoken

    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Cache(dict):
    """Answers by piece of text, of one vocabulary at a time.

    Short pieces stay while they are used: at half of ``entries`` the younger half becomes the older one, whose pieces
    move back when they are looked up, and what is left of the one before goes. A worker that goes on to another operator, or to
    another vocabulary, empties the cache of the one before, so that it holds one at a time.
    """

    last: Cache | None = None

    def __init__(self, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.entries, self.older, self.key = entries, {}, None

    def empty(self) -> None:
        self.clear()
        self.older = {}

    def lookup(self, pieces: list[str], answer, key=None) -> list:
        """The answers for ``pieces``, none of which is None; ``answer`` gets the unknown ones as a list, each once.

        ``key`` says whose answers these are, such as the vocabulary's path.
        """
        if Cache.last is not self or self.key != key:
            if Cache.last is not None:
                Cache.last.empty()
            self.empty()
            Cache.last, self.key = self, key
        found = list(map(self.get, pieces))
        holes = [i for i, f in enumerate(found) if f is None]
        if not holes:
            return found
        missing = dict.fromkeys([pieces[i] for i in holes])
        new = {p: a for p in missing if (a := self.older.get(p)) is not None} if self.older else {}
        unknown = [p for p in missing if p not in new] if new else list(missing)
        if unknown:
            new.update(zip(unknown, answer(unknown)))
        if len(self) + len(new) > self.entries // 2:
            self.older = dict(self)
            self.clear()
        self.update([item for item in new.items() if len(item[0]) <= CACHED_LENGTH])
        for i in holes:
            found[i] = new[pieces[i]]
        return found


# A space after white space belongs to what comes before, so texts with such a place are not cut at spaces.
_AFTER_SPACE = re.compile(r"\s ")
# The same for Arrow's regular expressions, all white space spelled out.
AFTER_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_PAIRS = [chr(c) + " " for c in range(128) if chr(c).isspace()]


def space_pieces(text: str) -> list[str]:
    """Cut before every space that follows another character, which no byte-level pattern match spans.

    Matches end at such a place whatever lies before, and what follows is matched without looking back, so the
    pieces encode to the text's tokens one after another. White space before a space keeps the two together.
    """
    if any(pair in text for pair in _PAIRS) if text.isascii() else _AFTER_SPACE.search(text):
        return re.split(r"(?<=\S)(?= )", text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + r for r in rest]


# ASCII signs, none of which the pattern joins with letters; the apostrophe is one it does.
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
# Letters below are letters in every edition of Unicode.
LATIN = "\u0250"


def finer_pieces(piece: str) -> list[str]:
    """A piece of ``space_pieces`` cut on where no byte-level pattern match spans either: at single line breaks, and before signs
    that end a word.

    A line break between two other characters is a match of its own. Letters and signs never share a match, and a word
    up to its signs has letters only, so that signs behind it begin a match and end it with the piece.
    """
    if "\n" in piece:
        lines = piece.split("\n")
        if any(not x or x[-1].isspace() for x in lines) or any(x[0].isspace() for x in lines[1:]):
            return [piece]
        parts = finer_pieces(lines[0])
        for line in lines[1:]:
            parts += ["\n", *finer_pieces(line)]
        return parts
    stem = piece.rstrip(_SIGNS)
    if len(stem) < len(piece):
        letters = stem[1:] if stem[:1] == " " else stem
        if letters.isalpha() and max(letters) < LATIN:
            return [stem, piece[len(stem):]]
    return [piece]

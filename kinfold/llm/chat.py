"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to one string. Conversations are rendered turn by turn: the
renderings of successive prefixes are compared, and where the new one begins with the old one, what was added is the
new turn's span. Where it doesn't, the template has rewritten history: the old rendering is closed as a sequence of its own
and the new one goes on with a loss mask for the turns that follow, so each text is trained on once, in the
rendering that it had as the last turn. Inside its span a turn's text lies between what two renderings with other texts in its
place have in common at both ends.

Turns are dealt out by ranges of (conversation, turn), so one conversation with very many turns is cut over many
tasks. A sequence holds at most ``SEQUENCE_TURNS`` turns; longer conversations become several sequences,
each rendered on its own, in order of ``place``. Rendering a turn therefore costs a bounded number of renderings.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import cut_lineage

SEQUENCE_TURNS = 16
# A sequence also ends once it has so many characters, so that prefixes of long texts aren't rendered over and over.
SEQUENCE_CHARS = 1 << 16
TURN, END = "<|turn|>", "<|end|>"
# Control strings of common chat formats, which no text may bring into a sequence.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", TURN, END)
LOSS_ROLES = ("assistant",)

Turns = list[tuple[str, str]]

# Each control string split behind its first character, where escaping puts its mark.
_ANY = "|".join(f"(?<={re.escape(c[0])})(?P<m{i}>\\\\*)(?={re.escape(c[1:])})" for i, c in enumerate(CONTROLS))
_OPEN = re.compile(_ANY)
_QUICK = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROLS))


def escape(text: str) -> str:
    r"""Put one more ``\`` behind the first character of every control string, marked already or not."""
    return _OPEN.sub(lambda m: m[0] + "\\", text) if _QUICK.search(text) else text


def unescape(text: str) -> str:
    r"""Take one ``\`` out of every marked control string."""
    return _OPEN.sub(lambda m: m[0][1:], text) if _QUICK.search(text) else text


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def render(turns: Turns) -> str:
    """The library's own template: every turn between control strings, its role on the first line."""
    return "".join(f"{TURN}{_role_line(role)}\n{escape(text)}{END}\n" for role, text in turns)


_ESCAPED = re.compile(r"\\(.)")


def parse(formatted: str) -> Turns:
    """The turns of a sequence that ``render`` has made."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        head, _, body = part.partition("\n")
        role = _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(head))
        turns.append((role, unescape(body[:-len(END) - 1])))
    return turns


def _common(a: str, b: str) -> int:
    return len(commonprefix([a, b]))


def _text_span(template: Callable[[Turns], str], before: Turns, role: str, whole: str, start: int) -> tuple[int, int] | None:
    """Where a turn's text lies in ``whole``, the rendering that ends with it; None if the template doesn't show it as one piece."""
    one, other = template([*before, (role, "a")])[start:], template([*before, (role, "b")])[start:]
    head, tail = _common(one, other), _common(one[::-1], other[::-1])
    if head + tail != len(one) - 1 or len(one) != len(other):
        return None
    end = len(whole) - tail
    fits = end >= start + head and whole[start:start + head] == one[:head] and whole[end:] == one[len(one) - tail:]
    return (start + head, end) if fits else None


def sequences(turns: list[tuple[int | None, str, str]], template: Callable[[Turns], str] = render,
              loss_roles=LOSS_ROLES, most_turns: int = SEQUENCE_TURNS, most_chars: int = SEQUENCE_CHARS) -> Iterator[dict]:
    """Renderings of a conversation's turns (number, role, text), each with the spans of the turns it is to be trained on.

    A span has the turn's number and role, where it lies, where its text lies in it (null if the template hides the
    text) and whether the text counts for the loss.
    """
    done: Turns = []
    text, spans, rewrites = template([]), [], False

    def closed() -> dict:
        return {"formatted": text, "spans": spans, "n_turns": len(spans), "rewrites": rewrites}

    for number, role, content in turns:
        if spans and (len(done) >= most_turns or len(text) >= most_chars):
            yield closed()
            done, text, spans, rewrites = [], template([]), [], False
        grown = template([*done, (role, content)])
        start = len(text)
        if not grown.startswith(text):
            if spans:
                rewrites = True
                yield closed()
            # What the two have in common may be carried over; the turn's own span begins where its text makes a difference.
            start, spans, rewrites = _common(template([*done, (role, "a")]), template([*done, (role, "b")])), [], True
        at = _text_span(template, done, role, grown, start)
        spans.append({"turn": number, "role": role, "start": start, "end": len(grown), "text_start": at and at[0],
                      "text_end": at and at[1], "loss": bool(at) and role in loss_roles})
        done.append((role, content))
        text = grown
    if spans:
        yield closed()


_SPAN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                   ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())])
_OUTPUT = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("closed", pa.bool_()), ("formatted", pa.string()),
                     ("spans", pa.list_(_SPAN)), ("n_turns", pa.int64()), ("rewrites", pa.bool_())])
_FORMATTED = ("conv_id bigint, place bigint, closed boolean, formatted string, spans array<struct<turn: bigint, "
              "role: string, start: bigint, end: bigint, text_start: bigint, text_end: bigint, loss: boolean>>, n_turns bigint, rewrites boolean")
_WRITE_BYTES = 4 << 20


def _rows(batches):
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")])


def _parts(turns, most: int):
    """Lists of at most ``most`` turns, so that no conversation is held as a whole."""
    part = []
    for turn in turns:
        part.append(turn)
        if len(part) == most:
            yield part
            part = []
    if part:
        yield part


def _format(batches, template, loss_roles, most_turns: int, most_chars: int):
    """Sequences of the conversations of a partition, whose rows come in order.

    ``closed`` marks a sequence that holds its conversation from the first to the last turn. The partition's first
    and last conversation may go on in another one.
    """
    context, count, ready, size = TaskContext.get(), 0, [], 0
    base = context.partitionId() << 40

    def made():
        previous = None
        for k, (conv_id, rows) in enumerate(groupby(_rows(batches), key=lambda r: r[0])):
            turns = ((turn, role or "", text or "") for _, turn, role, text in rows)
            n = 0
            for part in _parts(turns, most_turns):
                for sequence in sequences(part, template, loss_roles, most_turns, most_chars):
                    if previous:
                        # Something follows in this partition: is it another conversation?
                        yield previous | {"closed": previous["closed"] and previous["group"] != k}
                    previous = sequence | {"conv_id": conv_id, "group": k, "closed": k > 0 and n == 0}
                    n += 1
        if previous:
            yield previous | {"closed": False}

    for sequence in made():
        ready.append(sequence | {"place": base + count})
        count, size = count + 1, size + len(sequence["formatted"])
        if size >= _WRITE_BYTES or len(ready) >= 1024:
            yield pa.RecordBatch.from_pylist(ready, _OUTPUT)
            ready, size = [], 0
    if ready:
        yield pa.RecordBatch.from_pylist(ready, _OUTPUT)


def format_conversations(turns: DataFrame, template: Callable[[Turns], str] = render, loss_roles=LOSS_ROLES,
                         most_turns: int = SEQUENCE_TURNS, most_chars: int = SEQUENCE_CHARS) -> DataFrame:
    """Sequences of all conversations of ``turns`` (conv_id, turn, role, text; other columns are ignored).

    One row per sequence: conv_id, place (order of the sequences of a conversation), closed (it holds the whole
    conversation for certain), formatted, spans, n_turns and rewrites (the template changed what it had
    rendered before, at the sequence's end or its beginning).

    Turns go by number, those without one first; equal numbers by role and text. A null text or role is empty. Rows
    without conv_id form one conversation. Repeated rows are turns of their own. An empty table gives no rows.
    ``template`` gets lists of (role, text) and has to give the same string for the same list.
    """
    # Equal rows could not be told apart by ranges; where a row stands in its file settles it, also when a task runs again.
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text",
                        F.xxhash64("role", "text").alias("mark"), F.monotonically_increasing_id().alias("at"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "conv_id", "turn", "mark", "at").sortWithinPartitions("conv_id", "turn", "mark", "at")
    return dealt.select("conv_id", "turn", "role", "text").mapInArrow(
        lambda batches: _format(batches, template, loss_roles, most_turns, most_chars), _FORMATTED)


def _digests(batches):
    """Digests of whole conversations whose sequences come in order; nothing of a conversation is held but its hashes."""
    def sequence_rows():
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans")])

    ready = []
    for conv_id, rows in groupby(sequence_rows(), key=lambda r: r[0]):
        every, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = formatted_chars = 0
        for _, formatted, spans in rows:
            formatted_chars += len(formatted)
            for role, text in parse(formatted):
                every.update(f"{role}\n{text}\n".encode())
                n_turns += 1
            for span in spans:
                if span["loss"]:
                    text = unescape(formatted[span["text_start"]:span["text_end"]])
                    loss.update(text.encode())
                    loss_chars += len(text)
        ready.append((conv_id, n_turns, every.hexdigest(), loss_chars, loss.hexdigest(), formatted_chars))
        if len(ready) == 1024:
            yield _digest_rows(ready)
            ready = []
    if ready:
        yield _digest_rows(ready)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DIGEST.types)], schema=_DIGEST)


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from sequences that ``render`` has formatted.

    Turns are parsed from the sequences, loss texts are cut out by their spans. Conversations of one sequence are
    read where they are. Others, longer than a sequence or at the border of two partitions, are brought together in
    order; a task reads the sequences of one conversation as a stream, because a digest can't be divided.
    """
    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    columns = formatted.select("conv_id", "place", "closed", "formatted", "spans")
    alone = columns.filter("closed").drop("place", "closed")
    longer = columns.filter("NOT closed").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return alone.mapInArrow(_digests, kinds).unionByName(longer.select("conv_id", "formatted", "spans").mapInArrow(_digests, kinds))


def round_trip(turns: DataFrame) -> DataFrame:
    """Conversations formatted into the shared folder, and what is read back from there."""
    return digests(cut_lineage(format_conversations(turns)))

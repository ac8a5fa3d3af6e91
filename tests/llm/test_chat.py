"""Chat formatting against a plain version, and templates other than the library's own."""

import hashlib
import random

import pytest

from kinfold.llm.chat import CONTROLS, digests, escape, format_conversations, parse, render, round_trip, sequences, unescape
from kinfold.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn int, role string, text string, place string, n_turns int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """Digests of each conversation from its rows; the length is that of the whole rendering."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, own in by.items():
        own = [(r, t) for _, _, r, t in sorted(own, key=lambda r: r[:2])]
        loss = "".join(t for r, t in own if r == "assistant")
        out.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss), len(render(own))))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
                      .collect()), key=str)


def odd_text(rng):
    pieces = [*CONTROLS, "<", "s>", "\\", "[", "<\\s>", "\n", " words", "é", "\U0001f600", "<|", "|>", "INST]"]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))


def test_escaping_round_trip():
    rng = random.Random(3)
    for _ in range(20000):
        text = odd_text(rng)
        assert unescape(escape(text)) == text and not any(c in escape(text) for c in CONTROLS)
        turns = [(odd_text(rng), odd_text(rng)) for _ in range(rng.randint(0, 4))]
        assert parse(render(turns)) == turns


def test_chat_query(spark):
    rows = list(map(tuple, spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    text = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    assert got(QUERIES["op12_chat_formatting"](spark, SMALL)) == plain(rows)


@pytest.mark.parametrize("most_turns", [1, 16])
def test_odd_conversations(spark, most_turns):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool\nx", "a\\b"]), odd_text(rng)) for c in range(40) for t in range(c % 9 + 1)]
    rows += [(1000, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(700)]  # more than half of all rows
    rows += [(2000, 0, "user", None), (2000, 1, None, ""), (2000, 2, "assistant", "x" * 300_000 + "[INST]"), (2000, 3, "assistant", None)]
    rows += [(3000, None, "assistant", "first"), (3000, -5, "user", "second"), (None, 1, "user", "no id"), (None, 2, "assistant", "no id")]
    rows += [(4000, 7, "assistant", "same")] * 50  # equal rows
    frame = spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA).repartition(6)
    made = format_conversations(frame, most_turns=most_turns)
    assert got(digests(made)) == plain(rows)
    assert made.selectExpr("max(n_turns)").head()[0] <= most_turns and not made.filter("rewrites").head(1)
    assert made.filter("conv_id = 1000").select("place").distinct().count() >= 700 / max(most_turns, 16)


def test_no_conversations(spark):
    assert round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def loss_texts(found):
    return [s["formatted"][p["text_start"]:p["text_end"]] for s in found for p in s["spans"] if p["loss"]]


TURNS = [(0, "system", "be kind"), (1, "user", "hi"), (2, "assistant", "<think>a</think>one"), (3, "user", "more"),
         (4, "assistant", "two"), (5, "user", ""), (6, "assistant", "")]


def test_template_that_keeps_history():
    """Marks that depend on the place of a turn are no change of history."""
    def numbered(turns):
        return "<bos>" + "".join(f"[{i}:{r}]{t}." for i, (r, t) in enumerate(turns))

    found = list(sequences(TURNS, numbered))
    assert len(found) == 1 and not found[0]["rewrites"] and loss_texts(found) == ["<think>a</think>one", "two", ""]
    text = found[0]["formatted"]
    assert text == numbered([t[1:] for t in TURNS])
    assert [text[p["start"]:p["end"]] for p in found[0]["spans"]] == [f"[{i}:{r}]{t}." for i, r, t in TURNS]


def test_template_that_ends_what_it_renders():
    """An end mark after the last turn is history rewritten by every further turn: a sequence for each."""
    def ended(turns):
        return "".join(f"{r}: {t}\n" for r, t in turns) + "<eos>"

    found = list(sequences(TURNS, ended))
    assert len(found) == len(TURNS) and all(s["rewrites"] for s in found)
    assert loss_texts(found) == ["<think>a</think>one", "two", ""]
    assert found[-1]["formatted"] == ended([t[1:] for t in TURNS])


def test_template_that_drops_thoughts():
    """Thoughts are only shown in the last answer: each answer counts where it was shown in full."""
    def thoughtless(turns):
        last = len(turns) - 1
        return "".join(f"{r}: {t if i >= last else t.split('</think>')[-1]}\n" for i, (r, t) in enumerate(turns))

    found = list(sequences(TURNS, thoughtless))
    assert [s["n_turns"] for s in found] == [3, 4] and [s["rewrites"] for s in found] == [True, True]
    assert loss_texts(found) == ["<think>a</think>one", "two", ""]
    assert "<think>" in found[0]["formatted"] and "<think>" not in found[1]["formatted"]


def test_template_that_hides_texts():
    """A text that isn't shown as one piece has no span and no loss."""
    found = list(sequences(TURNS, lambda turns: "".join(f"{r}={t}={t};" for r, t in turns)))
    assert loss_texts(found) == [] and all(p["text_start"] is None for p in found[0]["spans"])

"""Decontamination and the n-gram Jaccard join against plain versions."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import decontaminate
from kinfold.llm.fm_index import END, FMIndex, suffix_order
from kinfold.llm.jaccard import similar_documents
from kinfold.llm.queries import QUERIES
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def tuples(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=str)


def digest(found):
    return tuples(found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("sha"), (decontaminate.n_hit() > 0).alias("hit")))


@pytest.mark.parametrize("length", [1, 2, 3, 50, 500])
def test_suffix_order_and_locate(length):
    rng = np.random.default_rng(length)
    body = rng.integers(1, 5, length)
    text = np.concatenate([body, body, [END]])
    assert suffix_order(text, 3).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = FMIndex(text, sample=4)
    phrases = [text[i:i + n].tolist() for i in range(len(text) - 1) for n in (1, 2, 3) if i + n < len(text)]
    rows = np.full((len(phrases), 3), -1, np.int64)
    for i, p in enumerate(phrases):
        rows[i, 3 - len(p):] = p
    hits, low, high = index.search(rows)
    assert len(hits) == len(phrases)
    found, which = index.locate(low, high)
    got = {}
    for place, i in zip(found, hits[which]):
        got.setdefault(int(i), set()).add(int(place))
    for i, p in enumerate(phrases):
        assert got[i] == {k for k in range(len(text)) if text[k:k + len(p)].tolist() == p}


ITEMS = [(1, "w1 w2"), (2, "Ünknown w7"), (3, "the same words here"), (4, "The SAME words, here"), (5, ""), (6, None),
         (None, "w3"), (7, "日本語"), (10, " ".join(f"w{i}" for i in range(40)))]


def contaminated_docs(odd_texts):
    return odd_texts + [
        (1000, "start the same words here end"), (1001, "x " + " ".join(f"W{i}" for i in range(5, 33)) + " y"),
        (1002, "w1 w2 w1 w2 w1"), (1002, "w1 w2 w1 w2 w1"), (None, "w1 w2")]


def test_contamination(spark, odd_texts):
    docs = contaminated_docs(odd_texts)
    frame = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id bigint, text string, n_words string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id bigint, text string, n int")
    expected = sorted(brute.contamination(docs, ITEMS), key=str)
    assert digest(decontaminate.find_contamination(frame, bench)) == expected
    # In many blocks, and without items or documents.
    assert digest(decontaminate.find_contamination(frame, bench, block_bytes=60)) == expected
    assert {r[2:] for r in digest(decontaminate.find_contamination(frame, bench.limit(0)))} == {
        (0, 0, hashlib.sha256(b"").hexdigest(), False)}
    assert decontaminate.find_contamination(frame.limit(0), bench).count() == 0
    # Whole documents go by the same hits, in one block or in many; items without an id count.
    clean = sorted((d for d, found in zip(docs, brute.contamination(docs, ITEMS)) if not found[5]), key=str)
    for block_bytes in (1 << 20, 60):
        kept = decontaminate.drop_contaminated(frame, bench, block_bytes=block_bytes)
        assert tuples(kept, "doc_id", "text") == clean


def test_rows_of_one_id_keep_their_own_columns(spark):
    """Rows that differ in a carried column only, over many blocks."""
    docs = spark.createDataFrame([(1, "w1 w2 here", "a"), (1, "w1 w2 here", "b"), (1, "w1 w2 here", "b"), (2, None, None)],
                                 "doc_id bigint, text string, source string")
    bench = spark.createDataFrame([(i, f"w{i} w{i + 1}") for i in range(40)], "item_id bigint, text string")
    found = decontaminate.find_contamination(docs, bench, block_bytes=50, extra=("source",))
    assert tuples(found.selectExpr("doc_id", "source", "array_join(items, ',') i")) == sorted(
        [(1, "a", "1"), (1, "b", "1"), (1, "b", "1"), (2, None, "")], key=str)


def test_contaminated_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "é before, THE same words here. After"), (2, "w1 w2 mid w1 w2"), (3, "clean"), (4, None)],
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame(ITEMS[:4], "item_id bigint, text string")
    found = docs.join(decontaminate.find_contamination(docs, bench), "doc_id")
    assert tuples(found, "doc_id", decontaminate.cut_spans().alias("t")) == [
        (1, "é before, . After"), (2, " mid "), (3, "clean"), (4, None)]


def test_contamination_query(spark):
    read = lambda t, *c: list(map(tuple, spark.read.parquet(f"{SMALL}/{t}.parquet").select(*c).collect()))
    expected = brute.contamination(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    found = QUERIES["op1_fm_index_decontaminate"](spark, SMALL)
    assert tuples(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(expected, key=str)
    assert sum(r[5] for r in expected) > 0


def test_similar_documents(spark, odd_texts, odd_docs):
    expected = brute.similar(odd_texts)
    assert tuples(similar_documents(odd_docs), "doc_id", "n_shingles", "component_id") == sorted(expected, key=str)
    assert len({r[2] for r in expected}) < len(expected)


def test_similar_repeats_and_nulls(spark, no_docs):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (5, "A b c\td e f"), (7, None)],
                                 "doc_id bigint, text string")
    assert tuples(similar_documents(docs), "doc_id", "n_shingles", "component_id") == sorted(
        [(1, 2, 1), (1, 2, 1), (None, 2, None), (5, 2, 1), (7, 0, 7)], key=str)
    assert similar_documents(no_docs).count() == 0


def test_links_between_others_than_the_first(spark):
    """A chain of near copies, whose ends and first member are not linked with each other."""
    words = [f"v{i}" for i in range(200)]
    docs = []
    for i in range(30):
        docs.append((i, " ".join(words)))
        words[(i * 7) % 200] = f"new{i}"
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert tuples(similar_documents(frame), "doc_id", "n_shingles", "component_id") == sorted(brute.similar(docs), key=str)


def test_similar_query(spark):
    docs = list(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    found = QUERIES["op5_ngram_jaccard_join"](spark, SMALL)
    assert tuples(found, "doc_id", "n_shingles", "component_id") == sorted(brute.similar(docs), key=str)


def near_passage(n, passage, own, sizes=1):
    """Documents that share a passage, each with words of its own before and after it."""
    shared = " ".join(f"p{i}" for i in range(passage))
    tail = lambda i: " ".join(f"d{i}w{k}" for k in range(own // 2 + i % sizes))
    return [(i, f"{' '.join(f'h{i}v{k}' for k in range(own // 2))} {shared} {tail(i)}") for i in range(n)]


@pytest.mark.parametrize("sizes", [1, 25])
def test_passage_below_the_bound_grows_with_its_holders(spark, monkeypatch, sizes):
    """A passage of 85 shingles in sets of 99 and more links nobody; what is compared at most doubles with twice the documents."""
    from kinfold.llm import jaccard

    compared = []
    remaining = jaccard._remaining_pairs
    monkeypatch.setattr(jaccard, "_remaining_pairs", lambda *a: (found := remaining(*a), compared.append((found, a[0])))[0])
    rows = []
    for n in (200, 400):
        docs = near_passage(n, 89, 15, sizes)
        frame = spark.createDataFrame(docs, "doc_id bigint, text string")
        assert all(r[2] == r[0] for r in tuples(similar_documents(frame), "doc_id", "n_shingles", "component_id"))
        found, mixed = compared.pop()
        rows.append((found.count(), mixed.count()))
    assert all(b <= 2 * a + 10 for a, b in zip(*rows))


def test_passage_beyond_the_bound_links_all(spark):
    docs = near_passage(150, 140, 8)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r[2] for r in tuples(similar_documents(frame), "doc_id", "n_shingles", "component_id")} == {0}


def test_near_copies_leave_fewer_pairs(spark, monkeypatch):
    """Copies of a text with edits about the bound: turns go on while a list's main component grows. One turn left 18,778 of 79,800 pairs."""
    from kinfold.llm import jaccard

    rng = np.random.default_rng(3)
    rates = rng.uniform(0.004, 0.016, 400)
    docs = [(i, " ".join(f"e{rng.integers(1 << 40)}" if rng.random() < r else f"w{k}" for k in range(300))) for i, r in enumerate(rates)]
    compared = []
    remaining = jaccard._remaining_pairs
    monkeypatch.setattr(jaccard, "_remaining_pairs", lambda *a: (found := remaining(*a), compared.append(found))[0])
    found = similar_documents(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert found.select("component_id").distinct().count() == 16
    assert compared[0].count() < 12_000


def test_lists_count_as_long_by_all_tasks(spark):
    """A passage that many documents share is in long lists, however few of them each task sees."""
    from kinfold.llm.jaccard import list_lengths

    docs = [(i, " ".join([*(f"p{k}" for k in range(9)), *(f"d{i}w{k}" for k in range(20))])) for i in range(40)]
    lengths = list_lengths(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(40, "doc_id"))
    assert sorted(lengths[lengths > 30].tolist()) == [32] * 5 and lengths.sum() < 250


def test_random_groups_against_brute_force(spark):
    """Copies with edits about the bound, in sizes that overlap, next to passages that many share."""
    rng = np.random.default_rng(6)
    docs = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(30, 120)))]
        for _ in range(25):
            words = [w if rng.random() > 0.025 * (g % 4) else f"e{rng.integers(1 << 30)}" for w in base]
            docs.append((len(docs), " ".join(words[: len(words) - int(rng.integers(0, 12))])))
    common = [f"c{i}" for i in range(40)]
    docs += [(len(docs) + i, " ".join([*common[: int(rng.integers(20, 41))], *(f"u{i}x{k}" for k in range(int(rng.integers(2, 30))))])) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    for most_turns in (1, 3):
        from kinfold.llm import jaccard

        kept = jaccard.MOST_TURNS, jaccard.PAIRS_PER_ENTRY
        jaccard.MOST_TURNS, jaccard.PAIRS_PER_ENTRY = most_turns, 0
        try:
            assert tuples(similar_documents(frame), "doc_id", "n_shingles", "component_id") == sorted(brute.similar(docs), key=str)
        finally:
            jaccard.MOST_TURNS, jaccard.PAIRS_PER_ENTRY = kept


def test_one_of_each_keeps_clean_texts_of_repeated_ids(spark):
    from kinfold.llm.jaccard import one_of_each

    a, b, c = ("a clean text of its own with some words", "b text that is a copy of another one here", "third text with other words in it again")
    rows = [(3, b, "x"), (5, a, "x"), (5, b, "x"), (6, a.upper(), "x"), (7, c, "y"), (7, c, "y"), (None, b, "x"), (None, b, "x"), (8, None, "x"),
            (8, None, "x"), (9, "", "x")]
    for n in range(4):
        frame = spark.createDataFrame(rows[n:] + rows[:n], "doc_id bigint, text string, source string").repartition(3)
        assert tuples(one_of_each(frame)) == sorted(
            [(3, b, "x"), (5, a, "x"), (7, c, "y"), (None, b, "x"), (None, b, "x"), (8, None, "x"), (9, "", "x")], key=str)

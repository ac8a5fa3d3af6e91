"""Encoders and counters against their libraries; files and trees by exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinfold.llm import bpe_tree, token_counts, token_files, tokens
from kinfold.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PARTS = ["a", " ", "b", "'s", "'", "ll", "\n", "  ", "\t", "1", "23", "é", "日", "本", "語", "!", "...", "\x1c", "\x85", "　",
         "hello", "The", "。", "😀", "‍", "ñ", "xxxxx", "▁", "▁▁", "<s>", "<|endoftext|>", "\xa0", "<0x0A>"]


def odd_strings(n, most=60):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS[:rng.randint(1, len(PARTS))]) for _ in range(rng.randint(0, most))) for _ in range(n)]


def read(spark):
    return sorted(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("sizes", [(8, 4, 2, 1), (16, 16, 4, 2), (4096, 2048, 64, 8)])
def test_tree_of_any_shape_encodes_like_the_library(sizes):
    own = bpe_tree.TreeEncoder(tokens.vocabulary_path(bpe_tree.VOCABULARY), *sizes)
    for text in [*odd_strings(1500), "a" * 3000, "日本語" * 800, " " * 2000 + "x", "ab" * 2000, "!?" * 1500]:
        ids = own.encode(text)
        assert ids == own.library.encode_ordinary(text)
        assert own.decode(np.array(ids, "<u4")) == text.encode()


def test_bpe_round_trip(spark, odd_docs, odd_texts, no_docs):
    library = tokens.rank_encoding(tokens.vocabulary_path(bpe_tree.VOCABULARY))
    rows = bpe_tree.decode(bpe_tree.encode(odd_docs)).select("doc_id", "n_tokens", "ids", "decoded").collect()
    found = {r[0]: (r[1], bytes(r[2]), bytes(r[3])) for r in rows}
    for i, text in odd_texts:
        ids = library.encode_ordinary(text or "")
        assert found[i] == (len(ids), packed(ids), (text or "").encode())
    assert bpe_tree.decode(bpe_tree.encode(no_docs)).count() == 0


def test_bpe_query(spark):
    library = tokens.rank_encoding(tokens.vocabulary_path(bpe_tree.VOCABULARY))
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_bpe_tree_round_trip"](spark, SMALL).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    for i, text in read(spark):
        ids = library.encode_ordinary(text or "")
        assert found[i] == (len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def file_rows(texts):
    tokenizer = tokens.fast_tokenizer(tokens.vocabulary_path(token_files.VOCABULARY))
    start = 0
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        yield i, start, len(ids), zlib.crc32(packed(ids))
        start += len(ids)


def test_pieces_of_odd_strings_encode_like_whole_ones():
    texts = odd_strings(4000) + sign_strings(6000)
    for vocabulary in (token_files.VOCABULARY, "word_bpe_49k.json"):
        path = tokens.vocabulary_path(vocabulary)
        whole = [tuple(e.ids) for e in tokens.fast_tokenizer(path).encode_batch(texts, add_special_tokens=False)]
        if vocabulary != token_files.VOCABULARY:
            # Not a byte-level vocabulary: only single words are the same in pieces, which shows whose answers are kept.
            texts, whole = zip(*[(t, w) for t, w in zip(texts, whole) if t.isalpha()])
        for dtype in ("<u2", "<u4", "<u2"):
            for low in range(0, len(texts), 500):
                ids, counts = token_files.encode_batch(pa.array(texts[low:low + 500]), path, np.dtype(dtype))
                ends = np.cumsum([0, *counts]).tolist()
                assert ids.dtype == dtype and [tuple(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])] == list(whole[low:low + 500])
    for texts in ([], [""], [None, "", None], ["<|endoftext|>"], [" ", "  ", " a"]):
        path = tokens.vocabulary_path(token_files.VOCABULARY)
        ids, counts = token_files.encode_batch(pa.array(texts, pa.string()), path, np.dtype("<u2"))
        expected = [tokens.fast_tokenizer(path).encode(t or "", add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(expected, []) and counts.tolist() == list(map(len, expected))


def sign_strings(n):
    """Words, signs, apostrophes, digits and line breaks in short runs."""
    rng = np.random.default_rng(12)
    parts = [" word", "word", " Über", "naïve", ",", ".", "...", '"', "'", "'s", "'ll", "n't", "!", "?)", " (", "\n", "\n\n", " ", "  ", "\t", "12",
             " 3", "-", "ǅ", "ɐ", "日", " 語", "ª", "\u180e", "\x1c", "\x85", "\u2028", "_", "@", " a", "I"]
    return ["".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(n)]


def test_finer_pieces_put_together_again():
    for text in sign_strings(4000):
        pieces = tokens.space_pieces(text)
        assert "".join("".join(tokens.finer_pieces(p)) for p in pieces) == text
    assert tokens.finer_pieces(" word,") == [" word", ","] and tokens.finer_pieces(" don't,") == [" don't,"]
    assert tokens.finer_pieces(" end.\nNext!") == [" end", ".", "\n", "Next", "!"] and tokens.finer_pieces("a \nb") == ["a \nb"]


def test_cache_drops_what_is_not_used():
    cache, asked = tokens.Cache(entries=100), []

    def answer(parts):
        asked.extend(parts)
        return [p.upper() for p in parts]

    for k in range(200):
        assert cache.lookup(["often", f"once{k}"], answer, "a") == ["OFTEN", f"ONCE{k}"]
        assert len(cache) + len(cache.older) <= 102
    assert asked.count("often") == 1
    # Another vocabulary, another cache.
    assert cache.lookup(["often"], lambda parts: ["other"], "b") == ["other"]
    assert cache.lookup(["often"], answer, "a") == ["OFTEN"] and asked.count("often") == 2
    other = tokens.Cache()
    other.lookup(["x"], answer)
    assert not cache and not cache.older


def test_fertility_of_other_vocabularies(spark):
    """Two vocabularies in one session, in the same workers."""
    from kinfold.llm import fertility

    docs = spark.createDataFrame([(1, "some plain words " * 10)], "doc_id bigint, text string").coalesce(1)
    first = fertility.measure(docs).head()
    other = fertility.measure(docs, ranks="byte_bpe_50k.tiktoken").head()
    again = fertility.measure(docs).head()
    assert first == again and first.chars_per_piece == other.chars_per_piece
    encoding = tokens.rank_encoding(tokens.vocabulary_path("byte_bpe_50k.tiktoken"))
    assert other.chars_per_rank_token == pytest.approx(140 / sum(len(encoding.encode_ordinary(" " + w)) for w in ("some plain words " * 10).split()))


def test_token_files(spark, odd_docs, odd_texts, no_docs):
    digest = lambda df: sorted(map(tuple, df.select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()))
    assert digest(token_files.round_trip(spark, odd_docs)) == list(file_rows(odd_texts))
    assert token_files.round_trip(spark, no_docs).count() == 0


def test_token_files_in_many_ranges(spark, odd_docs, odd_texts):
    folder = token_files.new_folder(spark, "tokens")
    manifest = token_files.cut_lineage(token_files.write_tokens(odd_docs, folder, range_bytes=50_000))
    assert manifest.count() > 3
    found = token_files.read_tokens(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    assert sorted(map(tuple, found)) == list(file_rows(odd_texts))


def test_token_files_of_the_least_id_and_of_many_equal_rows(spark):
    least = -(1 << 63)
    docs = spark.createDataFrame([(least, "x"), (None, "y"), (0, "z")] + [(5, "same")] * 400, "doc_id bigint, text string").repartition(4)
    folder = token_files.new_folder(spark, "tokens")
    manifest = token_files.cut_lineage(token_files.write_tokens(docs, folder, range_bytes=200))
    found = token_files.read_tokens(manifest, folder).select("doc_id", "start", "n_tokens").collect()
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == [None, least, 0] + [5] * 400
    # Rows of one id and one text stand in several files.
    assert manifest.count() > 3 and manifest.selectExpr("max(n_docs)").head()[0] < 300


def test_token_files_of_repeats_and_nulls(spark):
    docs = spark.createDataFrame([(2, "b"), (2, "b"), (None, "no id"), (1, None)], "doc_id bigint, text string").repartition(3)
    found = token_files.round_trip(spark, docs).select("doc_id", "start", "n_tokens").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == [(None, 0, 3), (1, 3, 1), (2, 4, 2), (2, 6, 2)]


def test_token_file_query(spark):
    found = QUERIES["op6_token_id_files"](spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == list(file_rows(read(spark)))


def test_lengths_of_pre_tokens_add_up():
    path = tokens.vocabulary_path(token_counts.VOCABULARY)
    texts = odd_strings(4000)
    expected = [len(ids) for ids in tokens.piece_model(path).encode(texts)]
    assert [sum(token_counts.lengths(p, path)) if (p := token_counts.pre_tokens(t, path)) else 0 for t in texts] == expected


def test_token_counts(spark, odd_docs, odd_texts, no_docs):
    model = tokens.piece_model(tokens.vocabulary_path(token_counts.VOCABULARY))
    expected = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in odd_texts]
    assert sorted(map(tuple, token_counts.count_tokens(odd_docs).collect())) == expected
    assert token_counts.count_tokens(no_docs).count() == 0


def test_token_count_query(spark):
    model = tokens.piece_model(tokens.vocabulary_path(token_counts.VOCABULARY))
    found = QUERIES["op9_two_tier_token_counts"](spark, SMALL).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    expected = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in read(spark)]
    assert sorted(map(tuple, found)) == expected

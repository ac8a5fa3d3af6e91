"""Shards, archives, toxicity, quality rules and personal data against plain versions or laws they must keep."""

import base64
import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinfold.llm import disclosure, fertility, sharding, toxicity, warc, words
from kinfold.llm.queries import QUERIES
from tests.llm import brute

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def tuples(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=str)


# Shards.

def check_shards(rows, texts, shards, slack=0.02):
    by_shard = {}
    for r in rows:
        text = texts[r["doc_id"]] if not isinstance(texts[r["doc_id"]], list) else None
        assert r["size"] == len((text or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text or "").encode())
        by_shard.setdefault(r["shard"], []).append(r)
    total, largest = sum(r["size"] for r in rows), max((r["size"] for r in rows), default=0)
    for shard, own in by_shard.items():
        assert 0 <= shard < shards
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= largest + slack * total / shards


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_shard_query(spark, folder):
    texts = dict(map(tuple, spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op4_histogram_sort_shards"](spark, folder).collect()
    assert len(rows) == len(texts) and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    check_shards(rows, texts, 8)


def test_shards_of_odd_texts(spark, odd_docs, odd_texts, no_docs):
    rows = sharding.shard_by_bytes(odd_docs, shards=3).collect()
    assert len(rows) == len(odd_texts)
    check_shards(rows, dict(odd_texts), 3)
    assert sharding.shard_by_bytes(no_docs).count() == 0


def test_a_hot_text_is_split_and_others_stay_together(spark):
    rng = random.Random(3)
    texts = {i: "hot text" if i % 3 else f"text {i} " + "x" * rng.randint(0, 30) for i in range(-1500, 1500)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    for range_bytes in (1 << 30, 1000):
        rows = sharding.shard_by_bytes(docs, shards=8, range_bytes=range_bytes).collect()
        assert len(rows) == len(texts)
        check_shards(rows, texts, 8)
    copies = spark.createDataFrame([(i, f"t{i % 40} " + "y" * (i % 40)) for i in range(4000)], "doc_id bigint, text string")
    assert copies.count() == sharding.shard_by_bytes(copies, tolerance=0.2).count()


def test_shards_with_repeats_and_nulls(spark):
    docs = spark.createDataFrame([(1, "same")] * 50 + [(None, None)] * 20 + [(2**62, "far"), (-2**62, "far")] * 10,
                                 "doc_id bigint, text string").repartition(4)
    rows = sharding.shard_by_bytes(docs, shards=4).collect()
    assert len(rows) == 90
    for shard in {r["shard"] for r in rows}:
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_shards_run_without_python(spark):
    plan = sharding.shard_by_bytes(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Archives.

def captures(pages):
    first = {}
    for page, _, html in pages:
        payload = (html or "").encode()
        if page is not None:
            first[payload] = min(first.get(payload, page), page)
    for page, _, html in pages:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        seen = first.get(payload)
        again = seen is not None and page != seen
        yield page, len(payload), digest, "revisit" if again else "response", seen if again else None


def test_capture_query(spark, tmp_path):
    pages = [(1, "http://a/é?q=1 2", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://c\r\nX: y", ""),
             (5, "u", "ü" * 70000), (5, "u", "ü" * 70000), (7, "v", "WARC/1.1\r\n\r\nWARC-Type: response"), (None, "w", "<p>x</p>"),
             (None, "w", "alone"), (9, "", "\r\n\r\n"), *[(100 + i, f"h{i}", "hot") for i in range(500)]]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("copy", F.lit("clash")).write.parquet(
        f"{tmp_path}/pages.parquet")
    found = QUERIES["op10_warc_assembly"](spark, str(tmp_path))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert tuples(found, *columns) == sorted(captures(pages), key=str)
    table = list(map(tuple, spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()))
    assert tuples(QUERIES["op10_warc_assembly"](spark, SMALL), *columns) == sorted(captures(table), key=str)


def test_archives_hold_payloads_and_nest_their_records(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i % 4} " * 50) for i in range(20)],
                                  "page_id bigint, url string, html string")
    folder = warc.new_folder(spark, "warc")
    archives = warc.write_archives(pages, folder, archive_bytes=2000)
    assert archives.count() > 1
    rows = warc.assemble(warc.read_records(archives, folder)).collect()
    assert len(rows) == 20
    for r in rows:
        page = int(r.metadata.fields["pageid"])
        assert r.request.concurrent_to == r.metadata.concurrent_to == r.capture.record_id
        payload = r.capture.payload if r.capture.kind == "response" else r.revisited.capture.payload
        assert bytes(payload).decode() == f"page {page % 4} " * 50
    empty = warc.write_archives(pages.limit(0), warc.new_folder(spark, "warc"))
    assert warc.assemble(warc.read_records(empty, folder)).count() == 0


def test_small_payloads_are_never_revisited(spark):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxxx"), (4, "d", "xxxx")],
                                  "page_id bigint, url string, html string")
    found = warc.round_trip(spark, pages, least_bytes=3)
    assert tuples(found, "capture.kind") == [("response",), ("response",), ("response",), ("revisit",)]


# Toxicity.

def test_maximal_segments():
    rng = random.Random(4)
    for _ in range(300):
        scores = [round(rng.uniform(-2, 1.5), 2) + rng.random() * 1e-4 for _ in range(rng.randint(0, 40))]
        total = np.concatenate([[0.0], np.cumsum(scores)])
        places = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.maximal_segments([total[i] for i in places], [total[i + 1] for i in places])
        got = sorted((places[a], places[b], round(s, 6)) for a, b, s in found)
        assert got == sorted((a, b, round(s, 6)) for a, b, s in brute.segments(scores))


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op2_toxic_segments"](spark, folder)
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    judged = found.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select(
        "predicted", "toxic", "score").collect()
    hits = sum(r.predicted and r.toxic for r in judged)
    assert all(0 <= r.score <= 1 for r in judged)
    assert hits / sum(r.predicted for r in judged) > 0.8 and hits / sum(r.toxic for r in judged) > 0.6


def test_toxicity_of_odd_inputs(spark, odd_docs, odd_texts, no_docs):
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in odd_texts] + [(None, 1, 1), (3, 0, None)],
                                   "doc_id bigint, quality int, toxic int")
    model = toxicity.train(odd_docs, labels)
    assert toxicity.score(odd_docs, model).count() == len(odd_texts)
    assert toxicity.score(no_docs, model).count() == 0
    blank = toxicity.train(odd_docs, labels.limit(0))
    assert toxicity.score(odd_docs, blank).filter("score between 0 and 0.5").count() == len(odd_texts)


def test_passages_hold_the_toxic_words(spark):
    docs, labels = [], []
    rng = random.Random(6)
    for i in range(400):
        words = [f"word{rng.randint(0, 200)}" for _ in range(60)]
        if i % 4 == 0:
            words[20:20] = ["vile", "nasty", "é", "brute"]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    rows = docs.join(toxicity.score(docs, model), "doc_id").collect()
    for r in rows:
        assert (r.score >= 0.3) == (r.doc_id % 4 == 0)
        if r.doc_id % 4 == 0:
            assert "vile nasty é brute" in " | ".join(r.text[p.start:p.end] for p in r.passages)


# Quality rules.

def test_base_counts(spark, odd_docs, odd_texts, no_docs):
    texts = [*odd_texts, (2000, "a b c d e f g h i " * 9), (2001, "x y\nx y\n\n \n x y\nx y"), (2002, "### $5 é<b>|&%*")]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, 1) for i, t in texts],
                                 "doc_id bigint, text string, lang string, kept int")
    found = {r.doc_id: r for r in fertility.measure(docs).collect()}
    for i, text in texts:
        r, expected = found[i], brute.quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r.kept and r.base_failed)
    assert fertility.measure(no_docs).count() == 0
    kept = fertility.keep(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}


def test_quality_query_keeps_prose(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").join(
        spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id", "left").select("doc_id", "text", "quality").collect()
    found = {r.doc_id: r for r in QUERIES["op7_tokeniser_fertility"](spark, MIDDLE).collect()}
    for d in docs:
        r = found[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(d.text)
        if d.quality == 1 and not r.base_failed:
            assert r.kept


def test_noise_is_rejected(spark):
    rng = random.Random(8)
    noise = " ".join("".join(rng.choice("0123456789abcdefXYZ+/=_^~") for _ in range(30)) for _ in range(60))
    prose = ("The council met on Tuesday to discuss the new bridge over the river, which will connect both parts of the old "
             "town and shorten the way to school for many children who live on the other side.")
    runes = " ".join("".join(chr(rng.randint(0x12000, 0x12300)) for _ in range(6)) for _ in range(40))
    docs = spark.createDataFrame([(1, noise, "en"), (2, prose, "en"), (3, runes, "en"), (4, prose, None)],
                                 "doc_id bigint, text string, lang string")
    assert {r.doc_id: r.kept for r in fertility.measure(docs).collect()} == {1: False, 2: True, 3: False, 4: True}


def test_bands_reject_what_the_base_rules_let_pass(spark):
    """Words strewn with signs, and a few words over and over, in every language; prose of the language stays."""
    rng = random.Random(14)
    prose = {
        "en": "The council met on Tuesday to discuss the new bridge over the river, which will connect both parts of the old town at last.",
        "de": "Der Rat traf sich am Dienstag, um über die neue Brücke zu sprechen, die beide Teile der alten Stadt bald verbinden soll.",
        "fr": "Le conseil s'est réuni mardi pour parler du nouveau pont sur la rivière, qui doit bientôt relier les deux parties de la ville.",
        "es": "El consejo se reunió el martes para hablar del nuevo puente sobre el río, que pronto debe unir las dos partes de la ciudad."}
    rows = []
    for k, (lang, text) in enumerate(prose.items()):
        own = text.split()
        strewn = " ".join("".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 6))) + rng.choice(["&&&", "###", "%%%", "***"])
                          for _ in range(80))
        few = " ".join(rng.choice(own[:7]) for _ in range(60))
        rows += [(10 * k, text, lang), (10 * k + 1, strewn, lang), (10 * k + 2, few, lang), (10 * k + 3, text, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in fertility.measure(docs).collect()}
    assert not any(r.base_failed for r in found.values())
    assert {i for i, r in found.items() if r.kept} == {10 * k + d for k in range(4) for d in (0, 3)}


# Personal data.

WORD = re.compile(r"(?<![^\W_])[^\W\d_]{3,}+(?![0-9])")
PRIVATE = [
    None, "", "mail a.b@c.de, x@y and q@r.s.t.", "a@b.c_d@e.f", "@x.y a@@b.c a@b..c", "1.2.3.4.5.6.7.8 999.1.2.3.4 0255.1.2.3 256.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 5 4111  1111", "+1 (377) 555-0271 +12 345 +1234567890123456",
    "é" * 30 + " +49 30 1234567 日本 a@b.co", "x" * 20000 + "@y", "a." * 5000 + "@b" + ".c" * 5000, "1" * 5000, "1.1." * 3000,
    "+1" * 3000, "+" + "1 " * 3000, "multi\nline a@b.c\n1.2.3.4\r\n+1 222 333 4444\n",
]


def test_base_spans(spark, no_docs):
    rng = random.Random(9)
    alphabet = ["a", "@", ".", "1", "23", "255", " ", "-", "+", "(", ")", "_", "%", "é", "\n", "4111111111111111", "b.c", "0"]
    texts = PRIVATE + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, email string")
    rows = disclosure.find_personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = brute.personal_data(texts[r.doc_id])
        for kind in disclosure.KINDS:
            assert [(s.start, s.end) for s in r[kind]] == expected[kind], texts[r.doc_id][:100]
            assert all(texts[r.doc_id][s.start:s.end] == s.value for s in r[kind])
    assert disclosure.find_personal_data(no_docs).count() == 0


def test_addresses_with_zero_parts(spark):
    texts = ["10.0.0.1", "at 127.0.0.1, 192.168.0.1.", "0.0.0.0", "00.000.1.2", "000.0255.00099.010", "0.0.0.256", "0300.0.0.1",
             "0" * 4000 + ".0.0.0", "0.0.0." + "0" * 4000 + "x", "255.249.199.99 260.0.0.0 100.200.20.0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = disclosure.find_personal_data(docs).collect()
    assert {r.doc_id: [(s.start, s.end) for s in r.ip] for r in rows} == {
        i: brute.personal_data(t)["ip"] for i, t in enumerate(texts)}
    assert sum(len(r.ip) for r in rows) == 10


def test_personal_data_query(spark):
    docs = dict(map(tuple, spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()))
    for r in QUERIES["op8_disclosure_sanitise"](spark, MIDDLE).collect():
        expected = brute.personal_data(docs[r.doc_id])
        base = ",".join(f"{k}:{a}:{b}" for k in disclosure.KINDS for a, b in expected[k])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(expected[k]) for k in disclosure.KINDS)
        assert r.spans.startswith(base)


def test_disclosing_terms(spark):
    """A nickname that stands by one address only gives it away; words that stand anywhere do not."""
    rows = [(i, f"today we asked Zorblax {'again ' * (i % 5)}at zor@x.org about item {i}") for i in range(6)]
    rows += [(100 + i, f"today we asked about item {i} and again, nobody knew anything at all") for i in range(60)]
    rows += [(200 + i, f"today the number +1 222 333 44{i:02d} was called again about item") for i in range(20)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (None, rows[1][1]), (301, None)]
    docs = spark.createDataFrame([(i, t, len(t or ""), "k") for i, t in rows],
                                 "doc_id bigint, text string, n_chars bigint, terms string").repartition(4)
    found = disclosure.find_personal_data(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        named = "email" if r.email else None
        assert len(r.terms) == (1 if named else 0)
    clean = {r.doc_id: r for r in disclosure.sanitise(docs).collect()}
    assert disclosure.sanitise(docs).columns == docs.columns
    assert clean[0].text == "today we asked  at [EMAIL] about item 0" and clean[0].n_chars == len(clean[0].text)
    assert clean[200].text == "today the number [PHONE] was called again about item"
    assert clean[100].text == rows[6][1] and clean[301].text is None


def test_no_part_of_an_overlapping_entity_stays(spark):
    rng = random.Random(12)
    parts = ["+49 151 12345678", ".john@x.com", "4111 1111 1111 1111", "@x.com", "10.0.0.1", " ", "é", "+1 (377) 555-0271", "-", "a.b@c.de"]
    texts = ["é +49 151 12345678.john@x.com é", "4111 1111 1111 1111@x.com", "1.2.3.4@x.com", "+4111111111111111@x.com", "+1 222 333 4444 10.0.0.1@a.b!"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in disclosure.sanitise(docs).collect()}
    assert clean[0] == "é [PHONE] é" and clean[1] == "[CARD]"
    for i, text in enumerate(texts):
        spans = [(a, b) for own in brute.personal_data(text).values() for a, b in own]
        covered = {k for a, b in spans for k in range(a, b)}
        left = re.sub(r"\[(EMAIL|IP|CARD|PHONE)\]", "", clean[i])
        assert left == "".join(c for k, c in enumerate(text) if k not in covered), text


def test_terms_of_an_entity_met_once(spark):
    """Far from the only mention of an address, a name that stands nowhere else; words of other texts stay."""
    filler = "today we asked about the item again and nobody knew anything at all, " * 5
    rows = [(i, f"{filler} {i}") for i in range(40)]
    rows += [(100, f"Zorblax wrote. {filler} mail a.b@c.de, été-a@b.c-été or ünal@x.org, said ZORBLAX"), (None, f"{filler} q@r.s"), (101, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    text = dict(rows)[100]
    found = {r.doc_id: r for r in disclosure.find_personal_data(docs).collect()}
    assert len(found) == len(rows) and {i for i, r in found.items() if r.terms} == {100}
    terms = [text[s.start:s.end] for s in found[100].terms]
    assert terms[0] == "Zorblax" and terms[-1] == "ZORBLAX" and "item" not in terms and "ünal" not in terms
    assert terms.count("été") == 2
    clean = {r.doc_id: r.text for r in disclosure.sanitise(docs).collect()}
    assert "orblax" not in clean[100].lower() and filler in clean[100] and clean[3] == rows[3][1] and clean[None] == f"{filler} [EMAIL]"


def test_disclosing_terms_of_the_given_tables(spark):
    """Shares counted one pair at a time give the same terms as the operator."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text")
    texts = dict(map(tuple, docs.collect()))
    found = disclosure.find_personal_data(docs).collect()
    names, terms, free = {}, {}, {}
    for r in found:
        text = list(texts[r.doc_id] or "")
        all_terms = {m.group().lower() for m in WORD.finditer(texts[r.doc_id] or "")}
        for value in all_terms:
            terms.setdefault(value, set()).add(r.doc_id)
        for kind in disclosure.KINDS:
            for s in r[kind]:
                name = s.value.lower() if kind in ("email", "ip") else "".join(c for c in s.value if c in "0123456789")
                names.setdefault((kind, name), set()).add(r.doc_id)
                text[s.start:s.end] = ["0" if c.isalpha() else c for c in text[s.start:s.end]]
        free[r.doc_id] = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer("".join(text))]
    expected = {i: set() for i in texts}
    for ids in names.values():
        near = {}
        for i in ids:
            for value in {v for v, _, _ in free[i]}:
                near.setdefault(value, []).append(i)
        for value, at in near.items():
            support = len({texts[i] for i in at})
            share = len(at) / (len(terms[value]) + 0.5) * support / (support + 0.5)
            if share >= disclosure.GENERALISE:
                for i in at:
                    expected[i] |= {(a, b) for v, a, b in free[i] if v == value}
    assert {r.doc_id: {(s.start, s.end) for s in r.terms} for r in found} == expected
    assert sum(map(len, expected.values())) > 0


def test_personal_data_runs_without_python(spark):
    plan = disclosure.find_personal_data(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_directory_costs_its_length(spark, monkeypatch):
    """Very many addresses and rare words in one text, in its copy, and some of both elsewhere."""
    made = []
    cut = disclosure.cut_lineage
    monkeypatch.setattr(disclosure, "cut_lineage", lambda df: made.append(written := cut(df)) or written)
    letters = "abcdefghij"
    spell = lambda i: "".join(letters[int(d)] for d in f"{i:05d}")
    most = []
    for n in (200, 400):
        made.clear()
        page = " ".join(f"Name{spell(i)} p{i}@x.org" for i in range(n))
        docs = [(1, page), (2, page), (3, "Namebbbbb wrote to p9999@y.org"), (4, f"p7@x.org is Name{spell(7)}")]
        docs += [(10 + i, f"plain words number {i} about nothing at all") for i in range(50)]
        found = {r.doc_id: r for r in disclosure.find_personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
        assert [len(found[i].email) for i in (1, 2, 3, 4)] == [n, n, 1, 1]
        # Two copies of one text: p = 2 / 2.5 / 1.5; two texts with both, three rows: p = 3 / 3.5 * 2 / 2.5.
        assert [len(found[i].terms) for i in (1, 2, 4)] == [n, n, 1] and [t.start for t in found[4].terms] == [12]
        most.append(max(t.count() for t in made))
    assert most[1] <= 2 * most[0] + 60


def test_very_many_matches_in_one_text(spark):
    n = 20_000
    text = " ".join(f"p{i}@x.org wordy" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "short a@b.c")], "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in disclosure.sanitise(docs).collect()}
    assert clean[1] == " ".join(["[EMAIL] [TERM]"] * n) and clean[2] == "[TERM] [EMAIL]"


def planted(n_filler, n_groups, texts_each):
    """Addresses that each stand in some texts with a name that only these have, and a harmless word of two other texts."""
    rng = random.Random(texts_each)
    common = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("rin", "lot", "mas", "ten")]
    word = lambda i, stem: stem + "".join("abcdefghij"[int(d)] for d in f"{i:06d}")
    prose = lambda: " ".join(rng.choice(common) for _ in range(30))
    docs, names, harmless = [(i, prose()) for i in range(n_filler)], set(), set()
    for g in range(n_groups):
        names.add(word(g, "zor"))
        for _ in range(texts_each):
            own = word(len(docs), "qua")
            harmless.add(own)
            docs.append((len(docs), f"{prose()} {word(g, 'zor')} {own} {prose()} u{g}@mail.org {prose()}"))
            docs += [(len(docs) + k, f"{prose()} {own} {prose()}") for k in range(2)]
    return docs, names, harmless


@pytest.mark.parametrize("texts_each, generalised, removed", [(1, 1.0, 0.0), (2, 1.0, 0.0), (3, 1.0, 1.0), (5, 1.0, 1.0)])
def test_thresholds_hold_at_every_size(spark, texts_each, generalised, removed):
    """Shares of disclosing names that are generalised or removed, and of harmless rare words, in a small and a larger table."""
    for n_filler in (50, 3000):
        docs, names, harmless = planted(n_filler, 12, texts_each)
        texts = dict(docs)
        found = disclosure.find_personal_data(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)).collect()
        hit = {texts[r.doc_id][t.start:t.end]: t.removed for r in found for t in r.terms}
        assert len(names & set(hit)) / len(names) == generalised
        assert sum(hit.get(n, False) for n in names) / len(names) == removed
        assert not harmless & set(hit) and set(hit) <= names


# Plain versions of what the contracts leave to the method.

def test_shards_are_runs_of_one_order(spark, odd_docs):
    """Shards are consecutive runs of all rows in the order of (hash of the text, doc_id), numbered from 0."""
    copies = spark.createDataFrame([(5000 + i, "one text of very many copies " * 3) for i in range(700)]
                                   + [(9000 + i % 40, f"short {i % 90}") for i in range(400)], "doc_id bigint, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(copies)
    placed = sharding.shard_by_bytes(docs, shards=4, range_bytes=2000)
    texts = sharding.keyed(docs).select("doc_id", "text", "size", "key", "order_id", F.crc32("text").alias("crc")).collect()
    order = sorted((r.key, r.order_id, r.size) for r in texts)
    by_row = {}
    for r in texts:
        by_row.setdefault((r.doc_id, r.crc or 0), (r.key, r.order_id, r.size))
    got = sorted((r.shard, r.slot, by_row[r.doc_id, r.text_crc32]) for r in placed.collect())
    assert [row for _, _, row in got] == order
    assert [slot for _, slot, _ in got] == [i for _, n in sorted(Counter(s for s, _, _ in got).items()) for i in range(n)]
    total, group = sum(r.size for r in texts), Counter()
    for r in texts:
        group[r.key] += r.size
    shards = {}
    for shard, _, (key, _, _) in got:
        shards.setdefault(key, set()).add(shard)
    # Only what is larger than the tolerance may be cut.
    assert all(group[key] > total / 4 * sharding.TOLERANCE for key, own in shards.items() if len(own) > 1)


def plain_script(text):
    """By the first words of the characters' names."""
    names = {"LATIN": "latin", "GREEK": "greek", "CYRILLIC": "cyrillic", "HEBREW": "hebrew", "ARABIC": "arabic", "DEVANAGARI": "devanagari",
             "THAI": "thai", "HANGUL": "hangul", "CJK": "han", "HIRAGANA": "han", "KATAKANA": "han"}
    found = Counter(names.get(unicodedata.name(c, "?").split()[0], "other") for c in text if ord(c) > 127 or c.isalpha())
    return found.most_common(1)[0][0]


def test_prose_of_other_scripts_is_kept_and_noise_is_not(spark):
    """A sentence in each script, and the same letters strewn into words that no vocabulary knows."""
    prose = {
        "cyrillic": "Совет собрался во вторник, чтобы обсудить новый мост через реку, который скоро соединит обе части старого города. ",
        "greek": "Το συμβούλιο συνεδρίασε την Τρίτη για να συζητήσει τη νέα γέφυρα πάνω από το ποτάμι, που θα ενώσει σύντομα την παλιά πόλη. ",
        "arabic": "اجتمع المجلس يوم الثلاثاء لمناقشة الجسر الجديد فوق النهر الذي سيربط قريبا بين جزأي المدينة القديمة في وقت قصير. ",
        "hebrew": "המועצה התכנסה ביום שלישי כדי לדון בגשר החדש מעל הנהר, שיחבר בקרוב את שני חלקי העיר העתיקה זה לזה. ",
        "devanagari": "परिषद की बैठक मंगलवार को नदी पर बने नए पुल पर चर्चा करने के लिए हुई, जो जल्द ही पुराने शहर के दोनों हिस्सों को जोड़ेगा। ",
        "hangul": "위원회는 화요일에 모여 강을 건너는 새 다리에 대해 논의했으며 이 다리는 곧 오래된 도시의 두 부분을 연결할 것이다. "}
    rng, rows = random.Random(21), []
    for k, (script, text) in enumerate(prose.items()):
        assert fertility.script_of(text) == script == plain_script(text)
        rows.append((2 * k, text + " ".join(reversed(text.split())), None))
        rows.append((2 * k + 1, " ".join("".join(rng.choice("0123456789abcdefXYZ+/=_^~") for _ in range(30)) + "é日" * 8 for _ in range(60)), None))
    assert fertility.script_of("東京は日本の首都です") == "han" and fertility.script_of("𒀀𒀁𒀂") == "other"
    found = {r.doc_id: r for r in fertility.measure(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not any(r.base_failed for r in found.values())
    assert {i for i, r in found.items() if r.kept} == {2 * k for k in range(len(prose))}


def test_fertility_against_the_libraries(spark, odd_docs, odd_texts):
    """The four measures and the verdict, word by word with the libraries themselves."""
    from kinfold.llm import tokens

    pieces, ranks = tokens.piece_model(tokens.vocabulary_path(fertility.PIECES)), tokens.rank_encoding(tokens.vocabulary_path(fertility.RANKS))
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows += [(100_000 + i, t, "en" if i % 2 else None) for i, t in odd_texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    found = {r.doc_id: r for r in fertility.measure(docs).collect()}
    kept = 0
    for i, text, lang in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        ids = [x for w in own for x in pieces.encode(w)]
        by_ranks = sum(len(ranks.encode_ordinary(" " + w)) for w in own)
        chars, r = sum(map(len, own)), found[i]
        if not own:
            assert (r.chars_per_piece, r.chars_per_rank_token, r.byte_share, r.entropy, r.kept) == (0, 0, 0, 0, False)
            continue
        counts = Counter(ids)
        entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in counts.values())
        byte_share = sum(pieces.is_byte(x) for x in ids) / len(ids)
        assert (r.chars_per_piece, r.chars_per_rank_token, r.byte_share) == pytest.approx((chars / len(ids), chars / by_ranks, byte_share))
        assert r.entropy == pytest.approx(entropy, abs=1e-9)
        band = fertility.BANDS.get(lang) or fertility.BANDS["latin" if len(text.encode()) <= 1.4 * len(text) else plain_script(text)]
        inside = (band.least_pieces <= chars / len(ids) <= band.most_chars and band.least_ranks <= chars / by_ranks <= band.most_chars
                  and byte_share <= band.most_bytes and entropy >= band.least_entropy)
        n_words, _, _, _, repeated = brute.quality(text)
        assert r.kept == (inside and n_words >= 20 and 100 * repeated <= 30 * n_words)
        kept += r.kept
    assert 50 < kept < len(rows)


def test_toxicity_against_a_plain_version(spark):
    """Log-odds, the extreme-value law, features and scores with plain loops; the fit by its own condition."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text")
    long = spark.createDataFrame([(10**6 + i, " ".join(f"filler{k % 97}" for k in range(30_000))) for i in range(6)], "doc_id bigint, text string")
    docs = docs.unionByName(long)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "toxic").unionByName(
        spark.createDataFrame([(10**6 + i, i % 2) for i in range(6)], "doc_id bigint, toxic int"))
    model = toxicity.train(docs, labels)
    texts, known = dict(map(tuple, docs.collect())), dict(map(tuple, labels.filter("toxic IS NOT NULL").collect()))
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i in known}
    bins = {}
    for i, text in texts.items():
        groups = list(words.word_groups(pa.array([text or ""]), words.ALPHANUMERIC, lower=True))
        bins[i] = [int(b) for g in groups for b in toxicity._bins(g)]
    toxic, other, ordinary, n = Counter(), Counter(), Counter(), [0, 0]
    for i in known:
        if fold[i] in toxicity.WEIGHT_FOLDS and i in texts:
            (toxic if known[i] else other).update(set(bins[i]))
            n[0 if known[i] else 1] += 1
            if not known[i]:
                ordinary.update(bins[i])
    scores = {}
    for b in range(1 << toxicity.BINS):
        a, o = toxic[b], other[b]
        prior = toxicity.PRIOR * (a + o) / max(1, sum(n)) + 1e-3
        odds = lambda k, m: math.log((k + prior) / (m + toxicity.PRIOR - min(k + prior, m + toxicity.PRIOR - 1)))
        apart = odds(a, n[0]) - odds(o, n[1])
        doubt = toxicity.DOUBT * math.sqrt(1 / (a + prior) + 1 / (o + prior))
        scores[b] = math.copysign(max(0.0, abs(apart) - doubt), apart) - toxicity.WORD_COST
    assert max(abs(scores[b] - model.scores[b]) for b in scores) < 1e-9
    # The rate solves its equation over ordinary words.
    share = {b: ordinary[b] + 0.5 * (scores[b] > 0) for b in scores}
    whole = sum(share.values())
    assert sum(w / whole * math.exp(min(model.rate * scores[b], 50)) for b, w in share.items()) == pytest.approx(1, abs=1e-6)

    def segments(i):
        # In short texts every segment is found by trying all of them.
        own = [scores[b] for b in bins[i]]
        if len(own) <= 150:
            return [s for _, _, s in brute.segments(own)]
        total = np.concatenate([[0.0], np.cumsum(own)])
        at = [k for k, s in enumerate(own) if s > 0]
        return [s for _, _, s in toxicity.maximal_segments([total[k] for k in at], [total[k + 1] for k in at])]

    def features(i):
        found = segments(i)
        bits = [math.log1p(math.exp(min(700, model.rate * s - model.log_k - math.log(max(len(bins[i]), 1))))) for s in found]
        return (math.log1p(max(bits)), math.log1p(sum(bits)), math.log1p(sum(b > 0.7 for b in bits))) if bits else (0.0, 0.0, 0.0)

    calibration = [i for i in known if fold[i] == toxicity.CALIBRATION_FOLD and i in texts]
    best = [model.rate * max(found) - math.log(len(bins[i])) for i in calibration if not known[i] and (found := segments(i))]
    assert model.log_k == pytest.approx(sum(best) / len(best) - np.euler_gamma, abs=1e-6)
    x, y = np.array([features(i) for i in calibration]), np.array([float(known[i] > 0) for i in calibration])
    assert np.allclose(model.center, x.mean(0), atol=1e-6) and np.allclose(model.scale, np.maximum(x.std(0), 1e-9), atol=1e-6)
    design = np.column_stack([np.ones(len(x)), (x - model.center) / model.scale])
    p = 1 / (1 + np.exp(-design @ model.weights))
    assert np.abs(design.T @ (y - p) - np.array([1e-6, 1e-2, 1e-2, 1e-2]) * model.weights).max() < 1e-4
    some = sorted(texts)[:150] + [10**6]
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i in some:
        z = model.weights[0] + (np.array(features(i)) - model.center) / model.scale @ model.weights[1:]
        assert found[i] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-6)


def test_held_out_is_never_null(spark, tmp_path):
    rows = [(i, f"text {i} with a few words") for i in range(40)] + [(None, "no id")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = QUERIES["op2_toxic_segments"](spark, str(tmp_path)).collect()
    assert len(found) == 41 and {r.held_out for r in found if r.doc_id is None} == {False}
    assert {r.doc_id for r in found if r.held_out} == {i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2}

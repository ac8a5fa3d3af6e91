"""Information-theoretic sanitisation of personal data, in DataFrame operations only.

Patterns find the entities to protect: e-mail and network addresses, payment cards, phone numbers. Other words of an
entity's document may give it away as well. How strongly a term reveals an entity is taken from the whole corpus: the
information that co-occurrence over documents gives about the entity (Sanchez and Batet's C-sanitisation), stated as what is
left: with probability p whoever reads the term knows the entity, and log2(1 / p) bits remain. Both sides are
shrunk where little supports them, so p depends on how often the two were met and not on the size of the corpus.
Terms beyond a first threshold are generalised in the documents of their entity, those beyond a second one are removed.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import cut_lineage
from kinfold.operators.merge import join_on

KINDS = ("email", "ip", "card", "phone")
TERM_KIND = "term"
# Possessive quantifiers and looking back keep the patterns' matches as they are stated, in linear time.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a match to be possible that also passes.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
TERM = r"(?<![\p{L}\p{M}\p{N}])\p{L}[\p{L}\p{M}]{2,}+(?![\p{N}])"
# What co-occurrence is shrunk by in different texts, and how many more rows a term is taken to stand in than were seen
# (the half of Krichevsky and Trofimov, on both sides): what was met once is neither certain to go together nor to be rare.
PRIOR = 0.5
# An entity met once, with a word met nowhere else, has p = 1 / 1.5 / 1.5 = 0.44 and keeps 1.2 bits: the word is generalised.
# Together in three different texts and nowhere apart they have p = 0.73 and keep less than half a bit: it is removed.
GENERALISE, REMOVE = 0.4, 0.7
# Steps of one inner pass over the matches of a text.
STRETCH = 256
FOUND = "array<struct<value: string, start: int, end: int>>"


def _stretches(items: Column) -> Column:
    """An array cut into arrays of at most ``STRETCH``."""
    last = F.greatest(F.ceil(F.size(items) / F.lit(STRETCH)) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * STRETCH + 1, F.lit(STRETCH)))


def _scan(items: Column, state: Column, step, kind: str) -> Column:
    """What ``step(state, item) -> (state, result)`` gives for the items one after another, as an array of type ``kind``.

    Adding to an array copies it, so results are gathered by stretches, whose arrays stay short, and these are put together
    at the end: a text with very many matches costs their number.
    """
    none = F.array().cast(kind)

    def add(held: Column, item: Column) -> Column:
        then, result = step(held["state"], item)
        return F.struct(then.alias("state"), F.concat(held["done"], F.array(result)).cast(kind).alias("done"))

    def stretch(held: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(held["state"].alias("state"), none.alias("done")), add)
        # Through an array of one, so that the inner pass is made once.
        return F.transform(F.array(inner), lambda r: F.struct(
            r["state"].alias("state"), F.concat(held["done"], F.array(r["done"])).alias("done")))[0]

    start = F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("done"))
    return F.aggregate(_stretches(items), start, stretch, lambda held: F.flatten(held["done"]))


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern as (value, start, end) in code points, leftmost first, not overlapping.

    Each step of the expression takes the gap before a match and the match; \\G ties a step to the one before, so that
    the rest of a text without matches is looked at once.
    """
    steps = rf"(?s)\G(.*?)({pattern})"
    gaps = F.transform(F.regexp_extract_all(text, F.lit(steps), F.lit(1)), F.length)
    found = F.regexp_extract_all(text, F.lit(steps), F.lit(2))

    def step(at: Column, item: Column):
        low = at + item["gap"]
        high = low + F.length(item["value"])
        return high, F.struct(item["value"].alias("value"), low.alias("start"), high.alias("end"))

    return _scan(F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))), F.lit(0), step, FOUND)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum of the digits, every second one from the right doubled, is a multiple of 10."""
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when((size - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & _luhn(_digits(value))
    return F.length(_digits(value)).between(9, 15)


def entities(text: Column, kind: str) -> Column:
    """Matches of a kind that pass its test; an empty array for a null text or one without."""
    found = F.filter(matches(text, PATTERNS[kind]), lambda m: _passes(kind, m["value"]))
    return F.coalesce(F.when(text.rlike(_HINTS[kind]), found), F.array().cast(FOUND))


def _name(kind: str, value: Column) -> Column:
    """The entity a match stands for, however it is written."""
    return F.concat(F.lit(f"{kind}:"), F.lower(value) if kind in ("email", "ip") else _digits(value))


def _named(kind: str) -> Column:
    return F.transform(kind, lambda m: F.struct(_name(kind, m["value"]).alias("name"), m["start"].alias("start"),
                                                m["end"].alias("end")))


def _free(text: Column, spans: Column) -> Column:
    """The text with the letters of entities as digits, so that a term that is part of a match is none; as long as before."""
    def step(at: Column, s: Column):
        low, high = F.greatest(at, s["start"]), F.greatest(at, s["end"])
        own = F.regexp_replace(F.substring(text, low + 1, high - low), "[A-Za-z]", "0")
        return high, F.concat(F.substring(text, at + 1, low - at), own)

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    done = _scan(ordered, F.lit(0), step, "array<string>")
    return F.concat(F.array_join(done, ""), F.substring(text, F.coalesce(F.array_max(F.transform(ordered, lambda s: s["end"])), F.lit(0)) + 1,
                                                        F.length(text)))


def _terms(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def find_entities(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text), the matches of each kind; of texts with any, the entities' names and the text without them."""
    text = F.col("text")
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"), *[entities(text, k).alias(k) for k in KINDS])
    named = found.withColumn("named", F.concat(*[_named(k) for k in KINDS]))
    some = F.size("named") > 0
    named = named.withColumn("free", F.when(some, _free(text, F.col("named"))))
    return named.select("doc_id", "mark", *KINDS, F.when(some, F.array_distinct(F.transform("named", lambda m: m["name"]))).alias("names"),
                        "free")


def _most(generalise: float) -> Column:
    """Most rows that a term can stand in to reveal an entity with that probability, if it stands by all its mentions."""
    return F.col("with_name") / F.lit(generalise) - PRIOR + 1e-9


def _reveals(both, texts, with_term) -> Column:
    """The probability that a term reveals an entity: it stands in ``with_term`` rows, in ``both`` with the entity, of ``texts`` different texts."""
    return both / (with_term + F.lit(PRIOR)) * texts / (texts + F.lit(PRIOR))


def _classes(places: DataFrame, member: str) -> DataFrame:
    """(row, class, member's columns): members that stand in exactly the same rows become one class, kept once per row.

    A class is told by the number of its rows, two sums of 64-bit hashes of them, and the least and the greatest one.
    """
    hashed = lambda seed: F.sum(F.xxhash64("row", F.lit(seed)).cast("decimal(38,0)"))
    shape = places.groupBy(member).agg(
        F.xxhash64(F.count("*"), hashed(1), hashed(2), F.min("row"), F.max("row")).alias("first_half"),
        F.xxhash64(hashed(3), F.count("*"), hashed(4), F.max("row")).alias("second_half"), F.count("*").alias("in_rows"))
    return join_on(places, shape, member, "inner")


def disclosing_terms(docs: DataFrame, found: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """(doc_id, mark, value, share): terms of a text that reveal one of its entities, with the largest probability.

    Copies of one text say nothing about what goes with what, so co-occurrence is shrunk by the number of
    different texts. Frequencies are over all rows with a text, and added up before they are shuffled.

    An entity and a term that meet in one row only have a probability that depends on the term's frequency alone, so
    no pair is built for them: it is taken from the row. Pairs are built for what stands in several rows with entities, once
    the term is known to be rare enough, and for classes: entities that stand in the same rows are one, and so
    are terms of equal frequency. A text costs its entities and terms, not their product.
    """
    own = found.filter("names IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    own = cut_lineage(own.select("row", "doc_id", "mark", "names", _terms(F.col("free")).alias("terms")))
    mentions = own.select("row", F.explode("names").alias("name"))
    names = mentions.groupBy("name").agg(F.count("*").alias("with_name"))
    most = names.agg(F.max("with_name").alias("with_name")).select(_most(generalise).alias("most"))
    words = docs.select(F.explode(_terms(F.col("text"))).alias("value")).groupBy("value").agg(F.count("*").alias("with_term"))
    used = own.select(F.explode("terms").alias("value")).groupBy("value").agg(F.count("*").alias("near"))
    # At most as many rows as the most frequent entity allows; the limit is one number.
    rare = join_on(words.withColumn("most", most.scalar()).filter("with_term <= most").drop("most"), used, "value", "inner")
    near = cut_lineage(join_on(own.select("row", F.explode("terms").alias("value")), cut_lineage(rare), "value", "inner"))
    once = near.select("row", "value", _reveals(F.lit(1.0), F.lit(1.0), F.col("with_term")).alias("share"))

    # Entities and terms that stand in several of these rows may meet more than once.
    several = join_on(mentions, names.filter("with_name > 1"), "name", "inner")
    entities_ = _classes(several, "name").select("row", "first_half", "second_half", "with_name").distinct().withColumnsRenamed(
        {"first_half": "name1", "second_half": "name2"})
    terms_ = _classes(near.filter("near > 1"), "value").withColumnsRenamed({"first_half": "term1", "second_half": "term2"})
    terms_ = cut_lineage(terms_.select("row", "value", "term1", "term2", "with_term"))
    kinds = terms_.select("row", "term1", "term2", "with_term").distinct()
    pairs = join_on(entities_, kinds, "row", "inner").filter(F.col("with_term") <= _most(generalise))
    pairs = cut_lineage(join_on(pairs, own.select("row", "mark"), "row", "inner"))
    keys = ["name1", "name2", "term1", "term2", "with_term"]
    met = pairs.groupBy(*keys, "mark").agg(F.count("*").alias("rows")).groupBy(*keys).agg(
        F.sum("rows").alias("both"), F.count("*").alias("texts"))
    met = met.select(*keys, _reveals(F.col("both"), F.col("texts"), F.col("with_term")).alias("share")).filter(F.col("share") >= generalise)
    best = join_on(pairs, met, keys, "inner").groupBy("row", "term1", "term2", "with_term").agg(F.max("share").alias("share"))
    often = join_on(terms_, best, ["row", "term1", "term2", "with_term"], "inner").select("row", "value", "share")
    shares = once.filter(F.col("share") >= generalise).unionByName(often).groupBy("row", "value").agg(F.max("share").alias("share"))
    return join_on(shares, own.select("row", "doc_id", "mark"), "row", "inner").groupBy("doc_id", "mark", "value").agg(
        F.max("share").alias("share"))


def known_terms(terms: DataFrame, remove: float = REMOVE) -> DataFrame:
    """doc_id, mark, and known: the disclosing terms of a text, and whether they are removed; one row per text with any."""
    return terms.groupBy("doc_id", "mark").agg(F.map_from_entries(F.collect_list(F.struct(
        "value", (F.col("share") >= remove).alias("removed")))).alias("known"))


TERMS = "array<struct<start: int, end: int, removed: boolean>>"


def _places(free: Column, known: Column) -> Column:
    """(start, end, removed) of every mention of known terms; an empty array where there are none."""
    steps = rf"(?s)\G(.*?)({TERM})"
    gaps = F.transform(F.regexp_extract_all(free, F.lit(steps), F.lit(1)), F.length)
    words = F.regexp_extract_all(free, F.lit(steps), F.lit(2))
    def step(at: Column, item: Column):
        low = at + item["gap"]
        high = low + F.length(item["value"])
        return high, F.struct(low.alias("start"), high.alias("end"), F.element_at(known, F.lower(item["value"])).alias("removed"))

    every = _scan(F.zip_with(gaps, words, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))), F.lit(0), step, TERMS)
    found = F.filter(every, lambda t: t["removed"].isNotNull())
    return F.coalesce(F.when(known.isNotNull(), found), F.array().cast(TERMS))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, mark, the matches of each kind and the spans of disclosing terms of every row of ``docs``.

    Needs doc_id and text; other columns are ignored. A null or empty text has no matches. Rows that repeat an id
    and its text have the same spans; a null doc_id is treated like any other. An empty table gives no rows.
    """
    own = docs.select("doc_id", "text")
    found = cut_lineage(find_entities(own))
    known = known_terms(disclosing_terms(own, found))
    return join_on(found.drop("names"), known, ["doc_id", "mark"], null_safe=True).withColumn(
        "terms", _places(F.col("free"), F.col("known"))).drop("free", "known")


def span_text(kind: str, spans: str) -> Column:
    """Spans as kind:start:end, comma-joined; empty for none."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def joined_spans(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), ",")


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every entity replaced by its kind, and disclosing terms generalised or removed.

    Spans that overlap are replaced as one, by the word of the one that starts first, of those the longest.
    All columns stay; n_chars, where there is
    one, is set to the new length. Rows and their order of columns stay as well.
    """
    own = docs.select("doc_id", "text")
    spans = cut_lineage(known_terms(disclosing_terms(own, cut_lineage(find_entities(own)))))
    marked = docs.withColumns({"__mark": F.xxhash64("text"), "__id": F.col("doc_id")})
    spans = spans.withColumnsRenamed({"doc_id": "__id", "mark": "__mark", "known": "__known"})
    # Only texts that may hold an entity can have spans; the others stay where they are.
    possible = F.coalesce(reduce(or_, [F.col("text").rlike(hint) for hint in _HINTS.values()]), F.lit(False))
    rest = marked.filter(~possible).withColumn("__known", F.lit(None).cast(spans.schema["__known"].dataType))
    both = join_on(marked.filter(possible), spans, ["__id", "__mark"], null_safe=True).unionByName(rest)
    text = F.col("text")
    # Column by column: each holds a pass over the text or its spans, made once.
    kinds = {k: f"__{k}" for k in KINDS}
    both = both.withColumns({name: entities(text, k) for k, name in kinds.items()})
    base = F.concat(*[F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for name in kinds.values()])
    both = both.withColumn("__base", base)
    both = both.withColumn("__free", F.when(F.col("__known").isNotNull(), _free(text, F.col("__base"))))
    both = both.withColumn("__terms", _places(F.col("__free"), F.col("__known")))

    def replaced(spans: str, word) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), word(s).alias("word")))

    every = F.concat(
        *[replaced(name, lambda s, k=k: F.lit(f"[{k.upper()}]")) for k, name in kinds.items()],
        replaced("__terms", lambda s: F.when(s["removed"], F.lit("")).otherwise(F.lit("[TERM]"))))
    both = both.withColumn("__spans", F.array_sort(every))

    def step(at: Column, s: Column):
        piece = F.concat(F.substring(text, at + 1, s["start"] - at), s["word"])
        return F.greatest(at, -s["back"]), F.when(s["start"] >= at, piece).otherwise(F.lit(""))

    both = both.withColumn("__pieces", _scan(F.col("__spans"), F.lit(0), step, "array<string>"))
    end = F.array_max(F.transform("__spans", lambda s: -s["back"]))
    clean = F.concat(F.array_join("__pieces", ""), F.substring(text, end + 1, F.length(text)))
    out = both.withColumn("text", F.when(F.size("__spans") > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

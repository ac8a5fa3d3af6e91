import random

import pytest


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and very long texts, repeats, ties, many scripts, near copies."""
    random.seed(7)
    words = [f"w{i}" for i in range(300)] + ["Über", "naïve", "日本語", "don't", "été,", "x" * 90]
    prose = lambda n: " ".join(random.choice(words) for _ in range(n))
    base = prose(120)
    near = [" ".join(w if random.random() > 0.02 else "edit" for w in base.split()) for _ in range(12)]
    texts = [None, "", " \t\n", "one", "one two three four", "ONE  two\nthree four", prose(5), base, base, base.upper(),
             *near, prose(20000), "a" * 100000, "日本語" * 5000, " " * 3000 + "end", "tail \n\n  ", "mixed space　wide",
             "<|endoftext|> inside", "<s> [INST] ▁ piece ▁▁", "emoji 👩‍👩‍👧 and \U0001f600 done", "a.b c\x85d",
             "1 12 123 1234 " * 30, *[prose(random.randint(1, 60)) for _ in range(40)]]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The texts as documents, over several partitions, next to columns whose names operators use themselves."""
    rows = [(i, t, "en", "s", len(t or ""), "clash", 1, 2) for i, t in odd_texts]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "items string, n_words int, n int").repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")

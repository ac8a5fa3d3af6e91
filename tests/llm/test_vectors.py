"""Vector codes and whitening against plain versions."""

import hashlib
import math

import numpy as np
import pytest

from kinfold.llm.queries import QUERIES
from kinfold.llm.vector_codes import Bounds, codebooks_text, code_table, distances, encode_vectors, enough

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, n int"


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label) by comparing every part with every entry; and the codebooks."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v], label) for i, v, label in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    first = {}
    for i, v, _ in sorted((k for k in kept if k[0] is not None), key=lambda k: (k[0], k[1])):
        first.setdefault(i, v)
    width = len(next(iter(first.values()))) // parts
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    books = [[cut(first[i])[p] for i in sorted(first)[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (away(x, book[e]), e))
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for _, v, _ in kept:
                members.setdefault(nearest(cut(v)[p], book), []).append(cut(v)[p])
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else book[e] for e in range(len(book))]
    out = []
    for i, v, label in kept:
        code = [nearest(x, book) for x, book in zip(cut(v), books)]
        out.append((i, "".join(f"{e:02x}" for e in code), sum(away(x, b[e]) for x, b, e in zip(cut(v), books, code)), label))
    return out, books


def odd_vectors(n=150, length=32, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 0.2, length).astype(np.float32).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(n) * 2]
    rows += [(1, [0.1] * length, 1)] * 20 + [(3, [0.1] * length, 2), (3, [0.0] * length, 2)]  # ties and repeated ids
    rows += [(None, [0.3] * length, 0), (None, [0.3] * length, 0)]
    rows += [(7, None, 1), (9, [None] + [0.1] * (length - 1), 1), (11, [float("nan")] * length, 1), (13, [float("inf")] * length, 1)]
    return rows


def check_codes(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA).repartition(4)
    expected, books = plain_codes(rows, **{k: v for k, v in sizes.items() if k != "closest"})
    found, codebooks = encode_vectors(frame, **sizes)
    got = sorted(((r.vec_id, r.code, r.error, r.label) for r in found.collect()), key=str)
    assert got == sorted(expected, key=str)
    assert codebooks.tolist() == books


@pytest.mark.parametrize("closest", [0, 1, 4, 63])
def test_codes_with_any_list_length(spark, closest):
    check_codes(spark, odd_vectors(), closest=closest, rounds=3)


def test_codes_of_very_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(0, 10.0 ** (i % 5) / 4, 16)).astype(np.float32).tolist(), 1) for i in range(120)]
    check_codes(spark, rows, entries=30)


def test_codes_of_few_ids_and_one_entry(spark):
    check_codes(spark, odd_vectors(5), parts=4)
    check_codes(spark, odd_vectors(20), parts=32, entries=1)


def test_code_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected, books = plain_codes(rows)
    totals = {}
    for _, _, error, label in expected:
        totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(codebooks_text(np.array(books)).encode()).hexdigest()
    got = sorted(map(tuple, QUERIES["op11_vector_codes"](spark, SMALL).collect()))
    assert got == sorted((i, code, error, totals[label], digest) for i, code, error, label in expected)


def test_code_table_without_vectors_or_ids(spark):
    assert code_table(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, [0.5] * 16, 1, "", 0), (None, None, 1, "", 0)]
    assert [(r.vec_id, r.code, r.error) for r in code_table(spark.createDataFrame(rows, SCHEMA)).collect()] == [(None, None, None)]
    other = [(1, [0.5] * 16, None, "", 0), (2, [0.5] * 32, None, "", 0)]
    assert sorted((r.vec_id, r.code, r.label_error) for r in code_table(spark.createDataFrame(other, SCHEMA)).collect()) == [
        (1, "00" * 16, 0), (2, None, 0)]


def test_bounds_spare_distances():
    """After a small move few parts look at any entry, and lists shrink to what was needed."""
    rng = np.random.default_rng(1)
    x, book = rng.integers(-200, 200, (4000, 4)), rng.integers(-200, 200, (64, 4))
    bounds = Bounds.of(x, book, 8)
    moved = book + rng.integers(-3, 4, book.shape)
    bounds.moved(np.sqrt(((moved - book) ** 2).sum(1)))
    looked = bounds.settle(x, moved)
    assert (bounds.assigned == distances(x, moved).argmin(1)).all()
    assert (looked == 0).mean() > 0.7 and (looked > 8).mean() < 0.01
    assert enough(looked, 8) < 8
    exact = np.sqrt(distances(x, moved))
    assert (np.take_along_axis(exact, bounds.closest, 1) >= bounds.lower).all()
    bounds.shortened(2)
    rest = exact.copy()
    np.put_along_axis(rest, np.column_stack([bounds.assigned, bounds.closest]), np.inf, 1)
    assert (rest.min(1) >= bounds.outer).all()


def plain_whitening(rows, components=32):
    """Eigenvalues and unit vectors by LAPACK, deviations in whole numbers."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, *_ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(kept), [sum(c) for c in zip(*[v for _, v in kept])]
    centred = np.array([[n * x - s for x, s in zip(v, sums)] for _, v in kept], object)
    deviations = [(i, int((d * d).sum())) for (i, _), d in zip(kept, centred)]
    centred = centred.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviations, centred, values, vectors


def check_whitening(found, rows, components, tolerance=1e-9):
    n, deviations, centred, values, vectors = plain_whitening(rows, components)
    got = found.collect()
    assert {r.component for r in got} == set(range(1, components + 1)) and {r.n for r in got} == {n}
    assert len(got) == n * components
    assert sorted(((r.vec_id, int(r.deviation)) for r in got if r.component == 1), key=str) == sorted(deviations, key=str)
    assert 0 <= got[0].identity_error < 1e-9 and len({r.identity_error for r in got}) == 1
    explained = {r.component: r.explained for r in got}
    trace = (centred ** 2).sum() / n
    assert np.allclose([explained[k + 1] for k in range(components)], values / trace, rtol=1e-9)
    for k in range(components):
        expected = centred @ vectors[:, k] / np.sqrt(values[k])
        own = sorted(((r.vec_id, r.whitened) for r in got if r.component == k + 1), key=str)
        signs = [sorted(((i, s * w) for (i, _), w in zip(deviations, expected)), key=str) for s in (1, -1)]
        close = [np.allclose([w for _, w in own], [w for _, w in side], atol=tolerance) for side in signs]
        assert any(close), k


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op13_embedding_whitening"](spark, SMALL), rows, 32, 1e-6)


def whitening_frame(spark, rows):
    return spark.createDataFrame([(*r[:2], 1, "clash", 5) for r in rows], SCHEMA).repartition(3)


def test_whitening_of_odd_rows(spark):
    from kinfold.llm.whitening import whiten

    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, [3, 2, 1, 0.5, 0.3]) + 1e4).astype(np.float32).tolist()) for i in range(60)]
    rows += [(60, None), (61, [None] * 5), (62, [float("nan")] * 5), (63, [float("-inf")] + [0.0] * 4)]
    check_whitening(whiten(whitening_frame(spark, rows)), rows, 5)
    check_whitening(whiten(whitening_frame(spark, rows), components=2), rows, 2)
    # Vectors of another length take no part, and rows of one id are rows of their own.
    longer = whiten(whitening_frame(spark, rows + [(64, [1.0] * 6)]))
    assert longer.select("n").head().n == 60
    repeated = whiten(whitening_frame(spark, [(1, v) for _, v in rows[:60]] * 2))
    assert repeated.count() == 600 and repeated.select("n").head().n == 120


def test_whitening_without_variation(spark):
    from kinfold.llm.whitening import whiten

    for rows in ([], [(1, [0.5] * 4)], [(i, [0.5] * 4) for i in range(9)], [(1, [])], [(1, None)]):
        assert whiten(whitening_frame(spark, rows)).count() == 0
    # Two dimensions of four vary, one is a copy.
    rows = [(i, [i / 4, 2.0, i / 4, (i * i % 7) / 2]) for i in range(30)]
    got = whiten(whitening_frame(spark, rows))
    assert {r.component for r in got.collect()} == {1, 2} and got.head().identity_error < 1e-9


def test_whitening_of_equal_eigenvalues(spark):
    from kinfold.llm.whitening import whiten

    corners = [(i, [float(s) if k == j else 0.0 for j in range(6)]) for i, (k, s) in enumerate((k, s) for k in range(6) for s in (2, -2))]
    got = whiten(whitening_frame(spark, corners)).collect()
    assert {r.component for r in got} == set(range(1, 7)) and got[0].identity_error < 1e-12
    assert all(math.isclose(r.explained, 1 / 6) for r in got)


def test_characteristic_polynomial(spark):
    from fractions import Fraction

    from kinfold.llm.whitening import characteristic_polynomial, isolate, refine, roots_above

    rng = np.random.default_rng(2)
    for d, rank in [(1, 1), (2, 2), (5, 3), (9, 9)]:
        a = rng.integers(-9, 10, (d, rank)) * 10 ** 7
        matrix = [[int(v) for v in row] for row in a.astype(object) @ a.T.astype(object)]
        # Faddeev-LeVerrier in whole numbers.
        power, expected = [[0] * d for _ in range(d)], [1]
        for k in range(1, d + 1):
            power = [[sum(matrix[i][t] * power[t][j] for t in range(d)) + (expected[-1] * matrix[i][j]) for j in range(d)] for i in range(d)]
            expected.append(-sum(power[i][i] for i in range(d)) // k)
        polynomial = characteristic_polynomial(spark, matrix)
        assert polynomial == expected
        values = np.sort(np.linalg.eigvalsh(a @ a.T / 1e14))[::-1] * 1e14
        found = [Fraction(m, 1 << s) for low, high, s, _ in isolate(polynomial, d) for m, s in [refine(polynomial, low, high, s)]]
        assert len(found) == rank and np.allclose([float(f) for f in found], values[:rank], rtol=1e-9)
        assert roots_above(polynomial, 0) == rank and roots_above(polynomial, polynomial[1] * -1) <= 1

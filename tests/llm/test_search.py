"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from claimsieve.llm import hilbert_search

SCHEMA = "vec_id long, embedding array<float>, point long, score double, curve string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, "?") for i, v in rows], SCHEMA)


def brute_force(rows, k, step):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(c is None or not np.isfinite(c) for c in vector) or not any(vector):
            continue
        usable[vec_id] = np.array(vector, np.float32).astype(float)
    found = {}
    for query in (i for i in usable if i % step == 0):
        scores = sorted((-(usable[query] * v).sum(), i) for i, v in usable.items() if i != query)
        found[query] = [(i, -s) for s, i in scores[:k]]
    return found


def answers(df):
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        assert row.rank == len(found.setdefault(row.query_id, [])) + 1
        found[row.query_id].append((row.vec_id, row.score))
    return found


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    return [(i, [float(c) for c in rng.normal(size=16)]) for i in range(3000)]


def test_recall(spark, vectors):
    found = answers(hilbert_search.nearest(table(spark, vectors), block_rows=128))
    expected = brute_force(vectors, 20, 20)
    assert found.keys() == expected.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * 20 * len(expected)
    for query, listed in found.items():
        exact = dict(brute_force([(query, vectors[query][1]), *(vectors[i] for i, _ in listed)], 20, query or 20)[query])
        assert all(score == exact[i] for i, score in listed)
        assert listed == sorted(listed, key=lambda hit: (-hit[1], hit[0]))


def test_recall_of_uneven_lengths(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in rng.normal(size=64) * np.exp(rng.normal())]) for i in range(3000)]
    found = answers(hilbert_search.nearest(table(spark, rows), block_rows=32))
    expected = brute_force(rows, 20, 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.95 * 20 * len(expected)


def test_whole_windows_find_everything(spark, vectors):
    some = vectors[:400] + [(1000 + i, vectors[7][1]) for i in range(50)] + [(2000, None), (None, vectors[1][1])]
    some += [(2020, []), (2040, [0.0] * 16), (2060, [float("nan")] * 16), (2080, [None] * 16), (2100, [float("inf")] * 16)]
    some += vectors[:3]
    found = answers(hilbert_search.nearest(table(spark, some), window=2.0, block_rows=64))
    expected = brute_force(some, 20, 20)
    assert found.keys() == expected.keys()
    for query, listed in expected.items():
        assert [i for i, _ in found[query]] == [i for i, _ in listed]


def test_small_tables(spark, vectors):
    assert answers(hilbert_search.nearest(table(spark, vectors[:3]))) == brute_force(vectors[:3], 20, 20)
    assert hilbert_search.nearest(table(spark, [])).count() == 0
    assert hilbert_search.nearest(table(spark, vectors[:1])).count() == 0


def test_hilbert_curve_visits_neighbouring_cells():
    for directions, bits in ((2, 4), (3, 3)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * directions, indexing="ij")
        cells = np.stack([a.ravel() for a in axes], axis=1)
        keys = hilbert_search.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()

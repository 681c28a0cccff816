"""Classes against a brute-force comparison of all pairs."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from claimsieve.llm import near_duplicates
from tests.llm.cases import ODD, bag, documents


def weights(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def jaccard(x, y):
    """By the definition, with every pair of shingles."""
    total = 0.0
    for i in x.keys() & y.keys():
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    return total


def brute_force(rows):
    shingles = [weights(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if shingles[a] and shingles[b] and root(a) != root(b):
            if shingles[a] == shingles[b] or jaccard(shingles[a], shingles[b]) >= 0.8:
                parent[root(b)] = root(a)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc_id)
    smallest = {r: min((d for d in members if d is not None), default=None) for r, members in ids.items()}
    return sorted(((doc_id, smallest[root(i)]) for i, (doc_id, _) in enumerate(rows)), key=str)


def copies(count, length=60, seed=4):
    """Chains and clouds of near copies, far texts, and texts that share a long passage."""
    rnd = random.Random(seed)
    fresh = iter(range(10**6))
    rows, passage = [], [f"p{i}" for i in range(40)]
    for group in range(6):
        base = [f"g{group}w{rnd.randrange(500)}" for _ in range(length)]
        for _ in range(count):
            changed = list(base)
            for _ in range(rnd.randrange(3)):
                changed[rnd.randrange(length)] = f"n{next(fresh)}"
            rows.append(" ".join(changed))
            if group % 2:
                base = changed  # a chain: the ends are far apart
    for _ in range(count):
        rows.append(" ".join(passage + [f"s{next(fresh)}" for _ in range(40)]))
        rows.append(" ".join(f"u{next(fresh)}" for _ in range(30)))
    rnd.shuffle(rows)
    return [(i, text) for i, text in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return copies(12)


@pytest.mark.parametrize("limits", [{"CHUNK": 4}, {"CHUNK_BYTES": 3000}])
def test_buckets_in_parts_give_the_same_classes(spark, rows, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(near_duplicates, name, value)
    assert bag(near_duplicates.classes(documents(spark, rows))) == brute_force(rows)


def test_a_bucket_of_unlike_texts_sends_few_pairs(spark):
    """Texts that share a passage are alike in many bands and not alike: members grow, edges do not."""
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"s{i}x{j}" for j in range(22)]) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in near_duplicates.classes(docs).collect()} == set(range(400))
    rows = []
    for number, text in enumerate(texts):
        key, _, shingle, weight = near_duplicates.shingles([text])
        sketch = near_duplicates.prob_min_hash(1, np.zeros(len(shingle), int), shingle, weight, 252).astype(np.uint8)
        rows.append({"bucket": 1, "p": 0, "q": 0, "side": 0, "content_key": key[0], "component": key[0],
                     "sketch": sketch[0].tobytes(), "shingles": shingle.tobytes(),
                     "weights": weight.astype("<u4").tobytes()})
    assert near_duplicates.Group(rows, True, 0.8).forest() == []
    assert len(near_duplicates.Group(rows, False, 0.8).forest()) < 20


def test_classes(spark, rows):
    assert bag(near_duplicates.classes(documents(spark, rows))) == brute_force(rows)


def test_one_row_of_each_class_stays(spark, rows):
    kept = near_duplicates.one_per_class(documents(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute_force(rows)})
    assert kept.columns == documents(spark, []).columns


def shuffled_texts(df):
    """The rows with a text that went through a shuffle when `df` was collected, without adaptive execution."""
    moved, steps = 0, [df._jdf.queryExecution().executedPlan()]
    while steps:
        step = steps.pop()
        children = step.children()
        steps += [children.apply(i) for i in range(children.size())]
        if step.nodeName() == "Exchange" and "text#" in step.output().mkString(" "):
            moved += step.metrics().apply("shuffleRecordsWritten").value()
    return moved


def test_only_rows_of_classes_of_several_documents_are_shuffled(spark):
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(20))) for i in range(400)]
    words = [f"w{j}" for j in range(60)]
    rows += [(900 + i, " ".join([*words[:59], f"n{i}"])) for i in range(3)]
    rows += [(910, " ".join(words)), (None, " ".join(words)), (911, None), (912, None)]
    rows += [(920, "the same words"), (919, "The same  words"), (919, "The same  words")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = near_duplicates.one_per_class(spark.createDataFrame(rows, "doc_id long, text string"))
        ids = sorted(r.doc_id for r in kept.collect())
        moved = shuffled_texts(kept)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert ids == [*range(400), 900, 911, 912, 919]
    assert 0 < moved < 40


def test_unlike_rows_that_hit_a_mark_stay(spark, rows, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CONTESTED_BITS", 1)
    kept = near_duplicates.one_per_class(documents(spark, ODD + rows))
    expected = {c for _, c in brute_force(rows)} | {1, 2, 3, 4, 5, 6, None, 8, 9, 9007199254740993}
    assert {r.doc_id for r in kept.collect()} == expected
    assert kept.count() == len({c for _, c in brute_force(rows)}) + 10


def test_odd_rows(spark):
    short = [(20, "four words are here"), (21, "Four words  are here"), (22, "four words are there")]
    assert bag(near_duplicates.classes(documents(spark, ODD + short))) == brute_force(ODD + short)
    assert near_duplicates.classes(documents(spark, [])).count() == 0
    kept = bag(near_duplicates.one_per_class(documents(spark, ODD)).select("doc_id"))
    assert kept == sorted([(1,), (2,), (3,), (4,), (5,), (6,), (None,), (8,), (9,), (9007199254740993,)], key=str)


def test_probability_jaccard():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        x, y = ({int(k): int(rnd.integers(1, 9)) for k in rnd.integers(0, 30, 20)} for _ in range(2))
        a, b = np.array(sorted(x)), np.array(sorted(y))
        fast = near_duplicates.probability_jaccard(a, np.array([x[k] for k in a]), b, np.array([y[k] for k in b]))
        assert abs(fast - jaccard(x, y)) < 1e-12


def test_sketches_estimate_probability_jaccard():
    first, second = "a b c d e f g h i j " * 30 + "x y z", "a b c d e f g h i j " * 20 + "k l m n"
    keys, text, shingle, weight = near_duplicates.shingles([first, second, first])
    sketch = near_duplicates.prob_min_hash(3, text, shingle, weight, 4096)
    assert (sketch[0] == sketch[2]).all() and keys[0] == keys[2]
    agree = (sketch[0] == sketch[1]).mean()
    assert abs(agree - jaccard(weights(first), weights(second))) < 0.03


def python_steps(df):
    """The plan's Python nodes; each that a task passes through holds a Python worker."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line.split("[")[0].strip(" :+-*") for line in lines if "EvalPython" in line or "MapIn" in line]


def test_a_task_works_the_key_out_once(spark, monkeypatch):
    docs = documents(spark, [(1, "a b c d e f"), (2, None), (3, " ")])
    nodes = spark.createDataFrame([(bytes(16), bytes(16))], "content_key binary, component binary")
    sets = near_duplicates.shingle_sets(docs, nodes, 252)
    assert sum("ArrowEvalPython" in step for step in python_steps(sets)) == 1
    monkeypatch.setattr(near_duplicates, "content_classes", lambda *_: (None, nodes))
    kept = near_duplicates.one_per_class(docs)
    # one for the documents with words, one for those without, in tasks of their own
    assert sum("ArrowEvalPython" in step for step in python_steps(kept)) == 2
    assert sorted(row["doc_id"] for row in kept.collect()) == [1, 2, 3]

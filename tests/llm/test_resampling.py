"""Importance resampling against a plain version, run by run."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from claimsieve.llm import importance_resampling as ir
from tests.llm.cases import ODD, bag, documents, random_texts

TARGET = "The river and the crow were here before the town. One crow said: 'the river's mine' — Übergröße 42."


def runs_of(text, runs):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, runs, buckets, least, percent, seed):
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    raw = Counter(bucket(run) for _, text in docs for run in runs_of(text, runs)[1])
    aim = Counter(bucket(run) for text in target for run in runs_of(text, runs)[1])
    s, t = sum(raw.values()), sum(aim.values())
    rows = []
    for doc_id, text in docs:
        words, found = runs_of(text, runs)
        gain = [
            math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
            for b in map(bucket, found)
        ]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(words), len(found), weight, weight + noise, None])
    able = [row for row in rows if row[1] >= least]
    able.sort(key=lambda row: (-row[4], row[0] is None, row[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted((tuple(row) for row in rows), key=str)


@pytest.mark.parametrize("runs, percent, least", [(1, 10, 20), (2, 50, 1), (3, 100, 0)])
def test_like_plain_version(spark, runs, percent, least):
    rows = ODD + random_texts(300) + [(5000 + i, f"the crow {i} " * (i % 40)) for i in range(200)]
    target = spark.createDataFrame([(1, TARGET), (2, None), (3, "")], "item_id long, text string")
    options = {"runs": runs, "buckets": 500, "least_words": least, "percent": percent, "seed": 7}
    found = ir.resample(documents(spark, rows).repartition(5), target, **options)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert bag(found) == plain(rows, [TARGET, "", ""], runs, 500, least, percent, 7)


def test_empty_tables_and_small_quota(spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert ir.resample(documents(spark, []), target).count() == 0
    few = ir.resample(documents(spark, ODD), target)
    assert bag(few) == plain(ODD, [], 1, ir.BUCKETS, ir.LEAST_WORDS, ir.PERCENT, ir.SEED)


@pytest.mark.parametrize("runs", [1, 2, 3])
def test_stretches_change_nothing(monkeypatch, runs):
    texts = [b"", b"one two\x00three FOUR", "é日 x".encode() * 50, b"...", b"a" * 300 + b" b c d", b""]

    def counted():
        found = Counter()
        for length, text, crc in ir.features(texts, runs):
            found.update((length, int(t), int(c)) for t, c in zip(text, crc, strict=True))
        return found

    whole = counted()
    assert sum(whole.values()) == sum(len(runs_of(t.decode(), runs)[1]) for t in texts)
    for stretch in (1, 5, 37):
        monkeypatch.setattr(ir, "STRETCH", stretch)
        assert counted() == whole

"""Rules against plain Python, classifiers on held-out rows of the test tables."""

import random
import re
import zlib
from collections import Counter

import pytest

from claimsieve.llm import quality_cnn, quality_rules, toxicity
from claimsieve.llm.queries import QUERIES
from tests.comparing import SF_DIR
from tests.llm.cases import ODD, WORDY, bag, documents, random_texts


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(spark):
    repeats = [(100 + i, text) for i, text in enumerate(["a b c d a b c", "a a a a a", "x y z " * 60, "l\nl\n\nm\nl"])]
    rows = ODD + repeats + random_texts(100, alphabet="ab #|\n")
    names = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    judged = quality_rules.judge(documents(spark, rows))
    assert bag(judged.select(*names)) == sorted(((i, *base_counts(t)) for i, t in rows), key=str)
    assert judged.filter("base_failed AND kept").count() == 0
    assert quality_rules.judge(documents(spark, [])).count() == 0


def test_clean_prose_is_kept_and_junk_is_not(spark):
    words = WORDY.replace(".", "").split() + [f"thing{chr(97 + i)}" for i in range(26)]
    prose = " ".join(random.Random(1).choices(words, k=150)) + "."
    table = " | ".join(f"cell{i}" for i in range(200))
    shouting = " ".join(f"WORD{i} THE!!" for i in range(80))
    kept = {r.doc_id: r.kept for r in quality_rules.judge(documents(spark, [(1, prose), (2, table), (3, shouting)])).collect()}
    assert kept == {1: True, 2: False, 3: False}


@pytest.mark.parametrize(
    ("query", "label", "part", "rest"),
    [("op5_byte_cnn_quality", "quality", 3, 1), ("op8_ngram_toxicity", "toxic", 5, 0)],
)
def test_held_out_accuracy(spark, query, label, part, rest):
    scored = QUERIES[query](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = scored.join(labels, "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % part == rest) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 50
    assert sum(r.predicted == r[label] for r in unseen) >= 0.9 * len(unseen)


@pytest.mark.parametrize("classifier", [quality_cnn, toxicity])
def test_classifiers_on_odd_rows(spark, classifier):
    labels = spark.createDataFrame(
        [(1, 0, 0, "?"), (6, 1, 1, "?"), (6, 1, 1, "?"), (7, 0, None, "?"), (None, 1, 1, "?"), (8, 1, 0, "?"), (8, 0, 1, "?")],
        "doc_id long, quality int, toxic int, text string",
    )
    df = documents(spark)
    scored = classifier.score_documents(df, labels).collect()
    assert sorted((r.doc_id or -1) for r in scored) == sorted((i or -1) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in scored)
    same = {r.score for r in scored if r.doc_id in (6, 7)}
    assert len(same) == 1
    none = classifier.score_documents(df, labels.limit(0)).collect()
    assert len(none) == len(ODD)
    assert classifier.score_documents(df.limit(0), labels).count() == 0


@pytest.mark.parametrize("label", [None, 0, 1])
@pytest.mark.parametrize(("classifier", "kept"), [(quality_cnn, 1), (toxicity, 0)])
def test_labels_without_both_classes_reject_nothing(spark, classifier, kept, label):
    rows = ODD + random_texts(60)
    labelled = [] if label is None else [(i, label, label) for i in range(300, 360)]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    scored = classifier.score_documents(documents(spark, rows), labels).collect()
    assert len(scored) == len(rows) and {r.predicted for r in scored} == {kept}


def test_texts_that_no_ngram_tells_apart_are_not_toxic(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    scored = toxicity.score_documents(documents(spark, [(i, None) for i in range(40)]), labels).collect()
    assert {r.predicted for r in scored} == {0}


def test_chunks_cover_the_whole_text():
    settings = quality_cnn.Settings()
    text = "".join(chr(33 + i % 90) for i in range(5000))
    chunks = quality_cnn.cut_chunks(text, settings)
    covered = set()
    for start in [*range(0, 5000 - settings.chunk, settings.step), 5000 - settings.chunk]:
        covered |= set(range(start, start + settings.chunk))
    assert covered == set(range(5000)) and len(chunks) == len(range(0, 5000 - settings.chunk, settings.step)) + 1

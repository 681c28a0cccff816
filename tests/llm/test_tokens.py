"""Counts, ids and packing against the tokenizer libraries."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from claimsieve.llm import global_bpe, pattern_packing, prefix_tokens
from tests.llm.cases import ODD, bag, documents, random_texts

ROWS = ODD + random_texts(150)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(prefix_tokens.MODEL))


def test_totals_and_limits(spark, pieces):
    tables = prefix_tokens.prefix_tables(documents(spark, ROWS))
    expected = []
    for doc_id, text in ROWS:
        text = text or ""
        n = len(pieces.encode(text))
        fit = max(i for i in range(min(len(text), 400) + 1) if len(pieces.encode(text[:i])) <= 20) if text else 0
        expected.append((doc_id, len(text.encode()), n, n > 20, fit if n > 20 else len(text)))
    assert bag(prefix_tokens.budgets(tables, 20)) == sorted(expected, key=str)
    assert prefix_tokens.budgets(tables.limit(0), 20).count() == 0


def test_every_prefix_is_exact(pieces):
    made = prefix_tokens.counter(public_tokenizers.path(prefix_tokens.MODEL))
    texts = [text[:80] for _, text in ROWS if text]
    for text, table in zip(texts, made.tables(texts), strict=True):
        counts = prefix_tokens.prefix_counts(table)
        assert counts.tolist() == [len(pieces.encode(text[:i])) for i in range(len(text) + 1)]


def test_counts_are_the_same_with_full_memos(pieces, monkeypatch):
    monkeypatch.setattr(prefix_tokens, "MEMO_BYTES", 2_000)
    monkeypatch.setattr(prefix_tokens, "MEMO_STEPS", 20)
    made = prefix_tokens.PrefixCounter(public_tokenizers.path(prefix_tokens.MODEL))
    texts = [text or "" for _, text in ROWS] + [text for _, text in random_texts(300)]
    for _ in range(2):
        for start in range(0, len(texts), 7):
            some = texts[start : start + 7]
            totals = [int(prefix_tokens.prefix_counts(table)[-1]) for table in made.tables(some)]
            assert totals == [len(pieces.encode(text)) for text in some]


def test_budget_cuts_stay_within_the_budget():
    counts = np.array([0, 1, 2, 2, 3, 2, 3, 4, 5, 9, 10])
    cuts = prefix_tokens.budget_cuts(counts, 3)
    assert cuts == [6, 8, 9, 10]
    assert prefix_tokens.prefix_within(counts, 2) == 5


def encoding():
    path = public_tokenizers.path(global_bpe.RANKS)
    return tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=global_bpe.rank_table(path), special_tokens={}
    )


def test_ids_and_decoding(spark):
    library, expected = encoding(), []
    for doc_id, text in ROWS:
        ids = library.encode_ordinary(text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    df = documents(spark, ROWS)
    assert bag(global_bpe.digests(df)) == sorted(expected, key=str)
    decoded = bag(global_bpe.decode(global_bpe.encode(df)))
    assert decoded == sorted(((i, bytearray((t or "").encode())) for i, t in ROWS), key=str)
    assert global_bpe.digests(df.limit(0)).count() == 0


def test_number_streams_round_trip():
    numbers = np.array([0, 159, 160, 161, 16543, 16544, 2**31, 2**32 - 1] * 3)
    assert (global_bpe.expand_numbers(global_bpe.squeeze_numbers(numbers)) == numbers).all()
    assert len(global_bpe.expand_numbers(global_bpe.squeeze_numbers(np.zeros(0)))) == 0


def check_packing(rows, texts, length):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(pattern_packing.TOKENIZER))
    expected = []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), length)):
            part = ids[start : start + length]
            expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(row)[:5] for row in rows), key=str) == sorted(expected, key=str)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for spans in sequences.values():
        spans.sort()
        assert [start for start, _ in spans] == np.cumsum([0, *(n for _, n in spans[:-1])]).tolist()
        assert sum(n for _, n in spans) <= length
    return len(sequences), sum(row.length for row in rows)


def test_packing(spark):
    rows = pattern_packing.pack(documents(spark, ROWS), length=256).collect()
    n, tokens = check_packing(rows, ROWS, 256)
    assert n <= tokens / 256 * 1.02 + 2
    assert pattern_packing.pack(documents(spark, ROWS).limit(0)).count() == 0


def test_hot_bin_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(pattern_packing, "PART_ROWS", 7)
    texts = [(i, "same words again") for i in range(100)] + random_texts(40)
    rows = pattern_packing.pack(documents(spark, texts), length=64).collect()
    check_packing(rows, texts, 64)


def test_pieces_that_fit_by_tokens_share_a_sequence(spark):
    texts = [(i, None) for i in range(64)]
    assert check_packing(pattern_packing.pack(documents(spark, texts), length=64).collect(), texts, 64)[0] == 1
    texts = [(i, "word " * 20) for i in range(30)]  # 20 tokens and an end id: three make 63
    assert check_packing(pattern_packing.pack(documents(spark, texts), length=64).collect(), texts, 64)[0] == 10
    # the default bins, at full length: three pieces of 682, and 1026 with 1022
    size = pattern_packing.LENGTH // pattern_packing.WIDTH
    for lengths in ([682] * 300, [1026, 1022] * 50):
        histogram = np.bincount([-(-n // pattern_packing.WIDTH) for n in lengths], minlength=size + 1)
        assert pattern_packing.plan(histogram).sequences == -(-sum(lengths) // pattern_packing.LENGTH)


def test_repeats_below_one_are_not_all_lost():
    lengths = np.random.default_rng(2).integers(1, 129, 2_000)
    histogram = np.bincount(lengths, minlength=129)
    found = pattern_packing.patterns_of(128, np.flatnonzero(histogram))
    used = np.zeros(129, np.int64)
    for pattern, times in pattern_packing.rounded(found, pattern_packing.repeats(found, histogram), histogram):
        assert sum(pattern) == 128
        np.add.at(used, pattern, times)
    assert (used <= histogram).all() and used.sum() >= 0.8 * len(lengths)


def test_plan_covers_the_histogram_with_few_sequences():
    lengths = np.random.default_rng(1).integers(1, 513, 20_000)
    histogram = np.bincount(lengths, minlength=513)
    made = pattern_packing.plan(histogram)
    used = np.zeros(513, np.int64)
    for b, _, times, _, _ in made.rows:
        used[b] += times
    assert (used == histogram).all()
    assert made.sequences <= lengths.sum() / 512 * 1.02

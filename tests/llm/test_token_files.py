"""Token files: round trip against the tokenizers library, order, pruning."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimsieve.llm import latin_tokens as lt
from claimsieve.llm import token_files as tf
from claimsieve.session import scratch_folder
from tests.llm.cases import ODD, bag, documents, random_texts

HOSTILE = [
    (700, "don't I'LL we'Ve 'tis it's''s 1²³ ½x"),
    (701, "<|endoftext|> <|startoftext|>mid<|endoftext|>"),
    (702, "tab\tnew\nline\x0bform\x0cret\r nbsp\xa0nel\x85 \x1c\x1d\x1e\x1f nul\x00 del\x7f soft\xadhyphen"),
    (703, "İstanbul ẞ ß ŉ ǆ Å Å é İ"),
    (704, "ＦＵＬＬ ﬁ ½ Ⅳ ٣ 日本語 한국어 \U0001f600"),
    (705, "</w> a</w>b ▁ Ġword Ċ"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tf.TOKENIZER))


def expected(library, rows):
    def ids(text):
        return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")

    done = [(doc_id, ids(text)) for doc_id, text in rows]
    done.sort(key=lambda d: (d[0] is None, d[0] or 0, len(d[1]), zlib.crc32(d[1].tobytes())))
    result, start = [], 0
    for doc_id, found in done:
        result.append((doc_id, start, len(found), zlib.crc32(found.tobytes())))
        start += len(found)
    return sorted(result, key=str)


def some_rows():
    rnd = random.Random(9)
    pieces = ["word", "Word,", "it's", "'RE", "''ve", "'d't", "averylongwordindeed" * 2, "ÿ", "é", "Ü", "3", "...", "\x1f", " ", "<|", "日", "á", "ͅ", " ", "\n"]
    mixed = [(1000 + i, "".join(rnd.choices(pieces, k=rnd.randrange(30)))) for i in range(400)]
    return ODD + HOSTILE + mixed + random_texts(200, first=2000)


def test_every_latin_character(library):
    made = tf.encoder(public_tokenizers.path(tf.TOKENIZER))
    forms = "{0}", "a{0}", "{0}A", ".{0}.", "{0}1{0}", "{0}\u0301", "'s{0}", "it'{0}", "{0}'ll{0}"
    texts = [form.format(c) for c in map(chr, range(0x260)) for form in forms]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in made.encode(texts)]
    assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_small_table_and_blocks_change_nothing(library, monkeypatch):
    monkeypatch.setattr(lt, "SLOTS", 256)
    monkeypatch.setattr(lt, "BLOCK", 60)
    monkeypatch.setattr(lt, "LONGEST", 128)
    texts = [text or "" for _, text in some_rows() if len(text or "") < 5000]
    made = lt.LatinEncoder(public_tokenizers.path(tf.TOKENIZER))
    found = [np.frombuffer(ids, "<u4").tolist() for ids in made.encode(texts)]
    assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.mark.parametrize("partitions", [1, 6])
def test_round_trip(spark, library, partitions):
    rows = some_rows()
    found = tf.file_round_trip(documents(spark, rows).repartition(partitions), scratch_folder(spark))
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert bag(found) == expected(library, rows)


def test_empty_table(spark):
    assert tf.file_round_trip(documents(spark, []), scratch_folder(spark)).count() == 0


def test_files_are_in_order_and_hold_the_ids(spark, library):
    rows = some_rows()
    folder = scratch_folder(spark)
    tf.write_files(tf.encoded(documents(spark, rows)), folder)
    files = tf.open_files(spark, folder)
    read = sorted(files.collect(), key=lambda r: (r.file, r.start))
    ids = [r.doc_id for r in read]
    assert ids == sorted((i for i, _ in rows), key=lambda i: (i is None, i or 0))
    assert len({r.file for r in read}) > 1
    for row in read:
        if row.doc_id is not None and row.doc_id >= 700:
            text = dict(rows)[row.doc_id]
            assert row.ids == [*library.encode(text, add_special_tokens=False).ids, 1]


def scanned(df):
    """Rows that the scan handed on, after statistics, row indexes and Bloom filters."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_scan_skips_what_it_need_not_read(spark):
    # even ids only: an odd id lies inside the ranges of all statistics, and only the Bloom filters rule it out
    rows = spark.range(0, 60_000, 2).selectExpr("id AS doc_id", "'one two' AS text")
    folder = scratch_folder(spark)
    tf.write_files(tf.encoded(rows), folder)
    files = tf.open_files(spark, folder)
    assert "PushedFilters: [In(doc_id" in tf.read_documents(files, [5, 7])._jdf.queryExecution().toString()
    assert scanned(tf.read_documents(files, [30_000])) <= 2 * tf.ROW_GROUP
    assert scanned(tf.read_documents(files, [30_001])) <= tf.ROW_GROUP
    listing = tf.manifest(files)
    whole = {r.doc_id: r.start for r in tf.in_corpus(files, listing).collect()}
    assert whole == {i: 3 * i // 2 for i in range(0, 60_000, 2)}
    span = tf.read_span(files, listing, 30_001, 30_010)
    assert sorted(r.doc_id for r in span.collect()) == [20_000, 20_002, 20_004, 20_006]
    assert tf.read_span(files, listing, 90_000, 90_001).count() == 0

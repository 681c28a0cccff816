"""Byte-level BPE over a whole corpus: every distinct pre-token is encoded once per hash bucket, not once per place.

1. Texts are read in blocks of a task. A block explodes into pre-tokens with positions: its distinct pre-tokens are
   numbered by falling frequency, and its positions are the sequence of these numbers. Blocks are stored as a table in
   the shared folder, so that numbers and positions never part, whichever executor is lost.
2. The distinct pre-tokens of all blocks are shuffled by bucket, the hash of the pre-token. A bucket sees each
   pre-token of the corpus that belongs to it, encodes it once and sends the ids back to the blocks that asked. A
   pre-token in a third of all places is one entry per block, so no key is hot.
3. Per block the ids join the positions and the documents are put together in order.

Decoding joins the token-byte table: the ids of a block meet the bytes of each id, a table of the vocabulary's fixed
size.

Lists travel compressed, a row per (block, bucket), so that the shuffles stay well below the size of the texts.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.shared import blocks, stored

RANKS = "byte_bpe_multi_50k.tiktoken"
BLOCK_CHARS = 24_000_000
READ_CHARS = 2_000_000
BUCKETS = 256
SMALL = 160
MIDDLE = SMALL + 64 * 256
MEMO_WORDS = 400_000
MEMO_STRETCHES = 300_000

split_all = regex.compile(public_tokenizers.PATTERN).findall
two_blanks = re.compile(r"\s\s").search


def rank_table(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


def squeeze_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, mostly small, in three streams: a leading byte that is the number if below SMALL, names its
    upper part if below MIDDLE, or says that four bytes follow; the lower bytes of the second kind; the third kind."""
    numbers = np.asarray(numbers, np.int64)
    middle, large = (numbers >= SMALL) & (numbers < MIDDLE), numbers >= MIDDLE
    lead = np.where(middle, SMALL + ((numbers - SMALL) >> 8), np.where(large, 255, numbers)).astype(np.uint8)
    planes = np.ascontiguousarray(numbers[large].astype("<u4")).view(np.uint8).reshape(-1, 4).T
    streams = [lead.tobytes(), ((numbers[middle] - SMALL) & 255).astype(np.uint8).tobytes(), planes.tobytes()]
    packed = [squeeze(stream) for stream in streams]
    return struct.pack("<2I", len(packed[0]), len(packed[1])) + b"".join(packed)


def expand_numbers(data: bytes) -> np.ndarray:
    first, second = struct.unpack_from("<2I", data)
    ends = [8, 8 + first, 8 + first + second, len(data)]
    lead, low, tail = (
        np.frombuffer(zstandard.decompress(data[a:b]), np.uint8) for a, b in zip(ends, ends[1:], strict=False)
    )
    numbers = lead.astype(np.int64)
    middle, large = (lead >= SMALL) & (lead < 255), lead == 255
    numbers[middle] = ((numbers[middle] - SMALL) << 8) + low + SMALL
    numbers[large] = np.ascontiguousarray(tail.reshape(4, -1).T).view("<u4").ravel()
    return numbers


def squeeze_words(words: list[bytes]) -> tuple[bytes, bytes]:
    return squeeze(b"".join(words)), squeeze_numbers(np.array([len(w) for w in words]))


def expand_words(data: bytes, sizes: bytes) -> list[bytes]:
    joined, ends = zstandard.decompress(data), np.cumsum(expand_numbers(sizes)).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class BlockTable:
    """Distinct pre-tokens of one block and the positions at which they stand."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict(lambda: len(self.numbers))
        self.stretches: dict[str, bytes] = {}
        self.positions: list[bytes] = []
        self.doc_ids: list[str | None] = []
        self.chars = 0

    def _numbered(self, text: str) -> bytes:
        return np.array([self.numbers[word] for word in split_all(text)], "<u4").tobytes()

    def add(self, doc_id: str | None, text: str) -> None:
        """A single blank between two other characters always starts a pre-token, so the stretches between such blanks
        can be split one by one, and each distinct stretch of a block only once."""
        self.doc_ids.append(doc_id)
        self.chars += len(text)
        if two_blanks(text):
            self.positions.append(self._numbered(text))
            return
        first, *others = text.split(" ")
        known, out = self.stretches, [self._numbered(first)]
        for stretch in others:
            numbers = known.get(stretch)
            if numbers is None:
                numbers = self._numbered(" " + stretch)
                if len(known) < MEMO_STRETCHES:
                    known[stretch] = numbers
            out.append(numbers)
        self.positions.append(b"".join(out))

    def rows(self, block: int) -> Iterator[tuple]:
        """(block, bucket, words, sizes, positions, lengths, doc ids, buckets): the row of bucket -1 holds the
        positions, the others the distinct pre-tokens of a bucket, most frequent first."""
        places = np.frombuffer(b"".join(self.positions), "<u4")
        counts = np.bincount(places, minlength=len(self.numbers))
        order = np.argsort(-counts, kind="stable")
        place_of = np.empty(len(order), np.int64)
        place_of[order] = np.arange(len(order))
        words = [word.encode() for word in self.numbers]
        by_rank = [words[i] for i in order.tolist()]
        buckets = np.array([xxhash.xxh3_64_intdigest(word) % BUCKETS for word in by_rank], np.int64)
        lengths = np.array([len(p) // 4 for p in self.positions])
        yield (
            block, -1, None, None, squeeze_numbers(place_of[places]), squeeze_numbers(lengths), self.doc_ids,
            squeeze_numbers(buckets),
        )
        for bucket in np.unique(buckets).tolist():
            data, sizes = squeeze_words([by_rank[i] for i in np.flatnonzero(buckets == bucket).tolist()])
            yield block, bucket, data, sizes, None, None, None, None


BLOCK = (
    "block long, bucket int, words binary, sizes binary, positions binary, lengths binary, doc_ids array<string>, "
    "buckets binary"
)


def block_tables(docs: DataFrame) -> DataFrame:
    """The stored blocks: one row of positions per block and one row per bucket of its distinct pre-tokens."""
    names = [field.split(" ")[0] for field in BLOCK.split(", ")]

    def explode(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made, number = TaskContext.get().partitionId(), BlockTable(), 0

        def finished() -> pd.DataFrame:
            return pd.DataFrame(list(made.rows((task << 24) + number)), columns=names)

        for pdf in blocks(pdfs, "text", READ_CHARS):
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                made.add(doc_id, text)
            if made.chars >= BLOCK_CHARS:
                yield finished()
                made, number = BlockTable(), number + 1
        if made.doc_ids:
            yield finished()

    # ids travel as text: pandas would turn long ids beside a null into inexact doubles
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(texts.mapInPandas(explode, BLOCK))


def encode_distinct(tables: DataFrame, path: str) -> DataFrame:
    """block, bucket, ids and sizes: the ids of the distinct pre-tokens, in the order in which they were sent."""

    def encode(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        core = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank_table(path), special_tokens={}
        )
        ranks, merge = core._mergeable_ranks, core._encode_single_piece
        known: dict[bytes, bytes] = {}

        def ids_of(word: bytes) -> bytes:
            ids = known.get(word)
            if ids is None:
                ids = np.array([ranks[word]] if word in ranks else merge(word), "<u4").tobytes()
                if len(known) >= MEMO_WORDS:
                    known.clear()
                known[word] = ids
            return ids

        for pdf in pdfs:
            rows = []
            for row in pdf.itertuples(index=False):
                ids = [ids_of(word) for word in expand_words(row.words, row.sizes)]
                counts = np.array([len(i) // 4 for i in ids])
                rows.append((row.block, row.bucket, squeeze_numbers(np.frombuffer(b"".join(ids), "<u4")), counts))
            yield pd.DataFrame(
                [(block, bucket, ids, squeeze_numbers(counts)) for block, bucket, ids, counts in rows],
                columns=["block", "bucket", "ids", "sizes"],
            )

    asked = tables.filter(F.col("bucket") >= 0).select("block", "bucket", "words", "sizes")
    by_bucket = asked.repartition("bucket").sortWithinPartitions("bucket", "block")
    return by_bucket.mapInPandas(encode, "block long, bucket int, ids binary, sizes binary")


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices flat[start : start + size] one after the other."""
    ends = np.cumsum(sizes)
    steps = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    some = sizes > 0
    starts, sizes = starts[some], sizes[some]
    if not len(starts):
        return flat[:0]
    steps[0] = starts[0]
    steps[np.cumsum(sizes)[:-1]] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
    return flat[np.cumsum(steps)]


def assembled(tables: DataFrame, encoded: DataFrame, result: Callable, schema: str) -> DataFrame:
    """`result(doc_id, ids)` of every document, from the blocks' positions and the ids of their pre-tokens.

    `schema` has the id as text; it becomes a number again in the result.
    """
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def put_together(positions: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for block in positions.itertuples(index=False):
            buckets = expand_numbers(block.buckets)
            flat, sizes, total = [], np.zeros(len(buckets), np.int64), 0
            starts = np.zeros(len(buckets), np.int64)
            for part in lists.itertuples(index=False):
                own = np.flatnonzero(buckets == part.bucket)
                counts = expand_numbers(part.sizes)
                sizes[own], starts[own] = counts, total + np.cumsum(counts) - counts
                flat.append(expand_numbers(part.ids))
                total += len(flat[-1])
            flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
            places, ends = expand_numbers(block.positions), np.cumsum(expand_numbers(block.lengths))
            for doc_id, begin, end in zip(block.doc_ids, [0, *ends[:-1]], ends, strict=True):
                own = places[begin:end]
                rows.append(result(doc_id, gather(flat, starts[own], sizes[own])))
        return pd.DataFrame(rows, columns=names)

    positions = tables.filter(F.col("bucket") < 0).select("block", "positions", "lengths", "doc_ids", "buckets")
    both = positions.groupBy("block").cogroup(encoded.groupBy("block"))
    return both.applyInPandas(put_together, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and `ids` (array<int>) of every document.

    A null text counts as empty and has no ids. Repeated rows and null ids give a row each; further columns are ignored
    whatever their names. A text longer than a block is a block of its own.
    """
    path = path or public_tokenizers.path(RANKS)
    tables = block_tables(docs)
    return assembled(
        tables, encode_distinct(tables, path), lambda doc_id, ids: (doc_id, ids), "doc_id string, ids array<int>"
    )


class TokenBytes:
    """The token-byte table as one array of bytes with the place and size of each id."""

    def __init__(self, path: str):
        ranks = rank_table(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.starts[ids], self.sizes[ids]).tobytes()


_tables: dict[str, TokenBytes] = {}


def token_bytes(path: str) -> TokenBytes:
    if path not in _tables:
        _tables[path] = TokenBytes(path)
    return _tables[path]


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and `text_bytes` (binary) of rows with `ids`; null ids decode to nothing."""
    path = path or public_tokenizers.path(RANKS)

    def join(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = token_bytes(path)
        for pdf in pdfs:
            joined = [table.join(np.asarray([] if i is None else i, np.int64)) for i in pdf["ids"]]
            yield pdf[["doc_id"]].assign(text_bytes=joined)

    slim = encoded.select(F.col("doc_id").cast("string"), "ids").mapInPandas(join, "doc_id string, text_bytes binary")
    return slim.select(F.col("doc_id").cast("long"), "text_bytes")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, decoded again, and both summed up."""
    path = path or public_tokenizers.path(RANKS)

    def digest(doc_id, ids: np.ndarray) -> tuple:
        listed = ",".join(map(str, ids.tolist())).encode()
        decoded = token_bytes(path).join(ids)
        return doc_id, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest()

    tables = block_tables(docs)
    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return assembled(tables, encode_distinct(tables, path), digest, schema)

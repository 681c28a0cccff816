"""Packing documents into sequences of a fixed length by patterns fitted to the length histogram.

1. Every document becomes its token ids and an end id; only longer ones are cut. A piece is known by its length.
2. Lengths fall into bins of `WIDTH` tokens, rounded up, so that any choice of pieces that fills the bins also fits in
   tokens. With bins of one token, whatever fits by tokens also fits by bins. The histogram has at most `length / WIDTH`
   rows, whatever the number of documents.
3. Patterns of up to three bins that fill a sequence exactly are enumerated. Non-negative least squares finds how often
   each repeats so that the bins used match the histogram; repeats are rounded down, and those of the largest remainder
   up while their bins last. What is left, such as short pieces that no three fill a sequence with, is packed by best
   fit, over the histogram again: a greedy filling is repeated as often as its bins last.
4. The plan lists, per bin, which ranks go to which sequences and slots. Its size follows the bins and not the
   documents, so it is broadcast. Ranks within a bin come from counts per part of the bin: a bin that holds a third of
   all pieces is spread over many tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.shared import blocks, stored

TOKENIZER = "word_bpe_49k.json"
LENGTH = 2048
END_ID = 0
WIDTH = 1
MEMO_WORDS = 700_000
MEMO_TOKENS = 500_000
MEMO_WORD_CHARS = 64
TOGETHER = 256
BLOCK_CHARS = 4_000_000
# Fixed values of the vocabulary: how it splits text, what closes a pre-token, how its special tokens begin.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
SPECIAL = "<|"
LATIN_END = "\u0250"
PART_ROWS = 50_000
STEPS = 400

_loaded: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, each distinct blank-free stretch encoded once per worker."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.memo: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        """Words of Latin letters are split into the vocabulary's own pre-tokens, which repeat far more often; each new
        one is encoded once, hundreds of them in a call, and ends with the one token that closes a pre-token. For these
        letters composing characters changes nothing and lower case stands alone; all other words go to the library."""
        plain = [word for word in words if word and max(word) < LATIN_END and SPECIAL not in word]
        split = [self.pre_tokens(word.lower()) for word in plain]
        if len(self.known) > MEMO_TOKENS:
            self.known.clear()
        new = sorted({token for tokens in split for token in tokens if token not in self.known})
        for start in range(0, len(new), TOGETHER):
            some = new[start : start + TOGETHER]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(self.closing[ids]) + 1) * 4
            if len(ends) != len(some):
                raise ValueError("a pre-token does not end in one closing token")
            data = ids.tobytes()
            self.known.update(
                (token, data[a:b]) for token, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)
            )
        self.memo.update(
            (word, b"".join([self.known[token] for token in tokens])) for word, tokens in zip(plain, split, strict=True)
        )
        others = [word for word in words if word not in self.memo]
        for encoding, word in zip(self.tokenizer.encode_batch_fast(others, add_special_tokens=False), others, strict=True):
            self.memo[word] = np.array(encoding.ids, "<u4").tobytes()

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """White space is dropped by this vocabulary and never joined, so stretches between blanks stand alone."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        worded = [text.split(" ") for text in texts]
        new = sorted(word for word in set().union(*worded) if word not in self.memo)
        self.learn(new)
        find = self.memo.__getitem__
        ids = [b"".join(map(find, words)) for words in worded]
        for word in new:
            if len(word) > MEMO_WORD_CHARS:
                del self.memo[word]
        return ids


def encoder(path: str) -> Encoder:
    """The encoder by arrays, whose table has a fixed size; it takes what is not Latin to the one above."""
    from claimsieve.llm.latin_tokens import LatinEncoder  # builds on this module

    if path not in _loaded:
        _loaded[path] = LatinEncoder(path)
    return _loaded[path]


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the ids of every document and an end id, cut where longer than
    `length`. A null text counts as empty: the end id alone."""
    path = path or public_tokenizers.path(TOKENIZER)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = encoder(path)
        for pdf in blocks(pdfs, "text", BLOCK_CHARS):
            rows = []
            for doc_id, ids in zip(pdf["doc_id"], made.encode(list(pdf["text"])), strict=True):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[start : start + 4 * length]
                    rows.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # ids travel as text: pandas would turn long ids beside a null into inexact doubles
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    made = texts.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def patterns_of(size: int, bins: np.ndarray) -> np.ndarray:
    """(patterns, 3) bins in falling order that sum to `size`, 0 for an empty place; only bins that occur."""
    held = np.zeros(size + 1, bool)
    held[bins] = True
    held[0] = True
    first, second = np.meshgrid(np.arange(size + 1), np.arange(size + 1), indexing="ij")
    third = size - first - second
    good = (first >= second) & (second >= third) & (third >= 0)
    found = np.stack([first[good], second[good], third[good]], axis=1)
    return found[held[found].all(axis=1) & (found[:, 0] > 0)]


def repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: x >= 0 that minimises the squared distance of the bins used from the histogram.

    Accelerated projected gradient; a pattern touches three bins, so a step costs three additions a pattern.
    """
    size = len(histogram)
    wanted = histogram.astype(float)
    wanted[0] = 0

    places = np.ascontiguousarray(patterns.T)

    def used(x):
        total = sum(np.bincount(place, x, size) for place in places)
        total[0] = 0
        return total

    # the largest eigenvalue of A'A is bounded by the largest row sum times the largest column sum of A
    bound = 3.0 * max(1, np.bincount(patterns[patterns > 0], minlength=size).max())
    x = y = np.zeros(len(patterns))
    momentum = 1.0
    for _ in range(steps):
        miss = used(y) - wanted
        miss[0] = 0
        new = np.maximum(y - sum(miss[place] for place in places) / bound, 0)
        following = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        y = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


def rounded(patterns: np.ndarray, wish: np.ndarray, histogram: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns with whole repeats within the histogram: rounded down, then one more for the largest remainders."""
    left, times = histogram.tolist(), np.zeros(len(patterns), np.int64)
    whole = np.floor(wish + 1e-6).astype(np.int64)
    remainder = np.maximum(wish - whole, 0)
    down = [(at, int(whole[at])) for at in np.argsort(-whole, kind="stable") if whole[at]]
    up = [(at, 1) for at in np.argsort(-remainder, kind="stable") if remainder[at] > 1e-6]
    for at, more in down + up:
        pattern = [b for b in patterns[at].tolist() if b]
        more = min(more, *(left[b] // pattern.count(b) for b in pattern))
        for b in pattern:
            left[b] -= more
        times[at] += more
    return [([b for b in patterns[at].tolist() if b], int(times[at])) for at in np.flatnonzero(times)]


@dataclass
class Plan:
    """Per slot: pieces of `bin` with ranks from `rank` on, `count` of them, go to sequences from `sequence` on."""

    rows: list[tuple[int, int, int, int, int]]
    sequences: int


def plan(histogram: np.ndarray) -> Plan:
    """Which ranks of which bin share a sequence. `histogram[b]` counts the pieces of bin b; the last is a full one."""
    size = len(histogram) - 1
    left = histogram.copy()
    given = np.zeros(size + 1, np.int64)
    made = Plan([], 0)

    def take(pattern: Sequence[int], times: int) -> None:
        for slot, b in enumerate(pattern):
            made.rows.append((b, int(given[b]), times, made.sequences, slot))
            given[b] += times
            left[b] -= times
        made.sequences += times

    def lasting(pattern: Sequence[int]) -> int:
        bins, uses = np.unique(pattern, return_counts=True)
        return int((left[bins] // uses).min())

    if left[size]:
        take([size], int(left[size]))
    if left.sum():
        found = patterns_of(size, np.flatnonzero(left))
        for pattern, times in rounded(found, repeats(found, left), left) if len(found) else []:
            take(pattern, times)
    while left.sum():
        pattern, room, spare = [], size, left.copy()
        while room > 0:
            fitting = np.flatnonzero(spare[: room + 1])
            if not len(fitting):
                break
            best = int(fitting[-1])  # the fullest that fits
            uses = min(int(spare[best]), room // best)
            if not pattern:
                uses = 1
            pattern += [best] * uses
            spare[best] -= uses
            room -= best * uses
        take(pattern, lasting(pattern))
    return made


def ranked(cut: DataFrame, counts: dict[int, int], width: int) -> DataFrame:
    """The pieces with their bin and their rank in it, from 0, in an order that no partitioning changes.

    A bin is cut into parts by hash, of some PART_ROWS rows each; a rank is the rows of the parts before and the row
    number in the part. The parts' counts are a table of a row per part and join like any other.
    """
    parts = [max(1, math.ceil(counts.get(b, 0) / PART_ROWS)) for b in range(max(counts) + 1)]
    binned = cut.withColumn("bin", F.ceil(F.col("length") / width).cast("int"))
    identity = "doc_id", "piece", "start", "length", "ids_crc32"
    n_parts = F.lit(np.array(parts, np.int64))[F.col("bin")]
    spread = binned.withColumn("part", F.pmod(F.xxhash64(*identity), n_parts))
    numbered = spread.withColumn(
        "row", F.row_number().over(Window.partitionBy("bin", "part").orderBy(*identity)) - 1
    )
    sizes = spread.groupBy("bin", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bin", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return numbered.join(offsets, ["bin", "part"]).withColumn("rank", F.col("before") + F.col("row"))


def placed(rows: DataFrame, made: Plan) -> DataFrame:
    """The pieces with the sequence and slot that the plan gives their rank."""
    table = np.array(sorted(made.rows), np.int64).reshape(-1, 5)
    bins, ranks, times, sequences, slots = table.T
    span = int((ranks + times).max(initial=0)) + 1
    keys = bins * span + ranks

    def place(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            rank = pdf["rank"].to_numpy(np.int64)
            at = np.searchsorted(keys, pdf["bin"].to_numpy(np.int64) * span + rank, side="right") - 1
            yield pdf.assign(sequence_id=sequences[at] + rank - ranks[at], slot=slots[at])

    fields = "doc_id string, piece int, start long, length long, ids_crc32 long, bin int, rank long"
    wanted = rows.select(
        F.col("doc_id").cast("string"), "piece", "start", "length", "ids_crc32", "bin", F.col("rank").cast("long")
    )
    made = wanted.mapInPandas(place, f"{fields}, sequence_id long, slot long")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack(docs: DataFrame, length: int = LENGTH, width: int = WIDTH, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Offsets leave no gap from 0 on. Repeated rows and null ids are packed like any other; further columns of `docs` are
    ignored whatever their names; without documents there are no rows.
    """
    cut = stored(pieces(docs, length, path))
    size = length // width
    counts = {
        row["bin"]: row["n"]
        for row in cut.groupBy(F.ceil(F.col("length") / width).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
        .collect()
    }
    histogram = np.zeros(size + 1, np.int64)
    for b, n in counts.items():
        histogram[b] = n
    made = plan(histogram)
    rows = placed(ranked(cut, counts or {0: 0}, width), made)
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(ahead), F.lit(0))
    fields = "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id"
    return rows.select(*fields, offset.alias("offset"))

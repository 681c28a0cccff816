"""Target-distribution importance resampling: drawing the documents that look most like a target corpus.

1. A batch of texts becomes one string of bytes: letters A-Z lowered, texts joined by a sentinel that no text holds any
   more. One pass of one regular expression finds all words and sentinels; the sentinels' places are the offsets of the
   texts, in which `searchsorted` finds the text of every word. Runs of words whose ends lie in different texts are
   masked out. The crc32 of a run goes on from the crc32 of the run without its last word, so no run is ever built.
2. Pass one counts the buckets of all features of the raw and of the target texts: `buckets` numbers each, whatever the
   size of the data. A bucket's gain is the logarithm of the smoothed ratio of its shares, in thousandths.
3. Pass two reads the texts again rather than storing features; a document's weight is the mean gain of its features.
4. Adding Gumbel noise from a hash of the id to the weight and taking the highest scores draws without replacement.
   Scores are whole numbers in a bounded range, so their histogram tells the lowest score that can be drawn; only
   documents from there on are sorted, by ranges.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.shared import numbered, stored

# The bytes of words (digits, lower-case letters, all of UTF-8 beyond ASCII), the scale of the logarithms.
WORD = rb"[0-9a-z\x80-\xFF]+"
NO_WORD = rb"[^0-9a-z\x80-\xFF]"
SCALE = 1000
RUNS = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
BLOCK_BYTES = 2_000_000
STRETCH = 4_000_000

SENTINEL = b"\x00"
PREPARED = bytes.maketrans(bytes(range(ord("A"), ord("Z") + 1)) + SENTINEL, bytes(range(ord("a"), ord("z") + 1)) + b" ")
TOKENS = re.compile(WORD + b"|" + SENTINEL)
GAP = re.compile(NO_WORD)


def features(texts: list[bytes], runs: int = RUNS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length of the runs, text number and crc32 of each run of that many words), in parts of bounded size.

    Texts beyond STRETCH bytes are read a stretch at a time, cut between words, so memory follows the stretch.
    """
    joined = SENTINEL.join(text.translate(PREPARED) for text in texts)
    start, number = 0, 0
    kept: list[bytes] = []
    kept_texts = np.zeros(0, np.int64)
    while start < len(joined):
        gap = GAP.search(joined, start + STRETCH)
        end = gap.start() if gap else len(joined)
        found = TOKENS.findall(joined, start, end)
        sentinel = np.fromiter((token == SENTINEL for token in found), bool, len(found))
        offsets = np.flatnonzero(sentinel)
        at = np.flatnonzero(~sentinel)
        words = kept + ([token for token in found if token != SENTINEL] if len(offsets) else found)
        text = np.append(kept_texts, number + np.searchsorted(offsets, at))
        crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        yield 1, text[len(kept) :], crc[len(kept) :]
        spaced = [b" " + word for word in words] if runs > 1 else []
        for length in range(2, runs + 1):
            # the run that starts one word later ends where this one does: go on from the shorter run's crc32
            count = max(0, len(words) - length + 1)
            crc = np.fromiter(map(zlib.crc32, spaced[length - 1 :], crc[:count].tolist()), np.uint32, count)
            whole = text[:count] == text[length - 1 :][:count]
            whole[: max(0, len(kept) - length + 1)] = False  # counted with the stretch before
            yield length, text[:count][whole], crc[whole]
        number += len(offsets)
        kept, kept_texts = (words[1 - runs :], text[1 - runs :]) if runs > 1 else (kept, kept_texts)
        start = end


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches of a task with their `text`, null as empty, cut where the texts pass BLOCK_BYTES."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
        start, size = 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text or b"")
            if size >= BLOCK_BYTES or end == len(texts):
                yield batch.slice(start, end - start), [text or b"" for text in texts[start:end]]
                start, size = end, 0


def bucket_counts(texts: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends its sums, a row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, block in text_blocks(batches):
            for _, _, crc in features(block, runs):
                total += np.bincount(crc % buckets, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket long, n long")
    result = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        result[row.bucket] = row.n
    return result


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the logarithm of (smoothed share in the target) / (smoothed share in the raw texts), floored."""
    buckets = len(raw)
    upper = (target + 1.0) * (raw.sum() + float(buckets))
    lower = (raw + 1.0) * (target.sum() + float(buckets))
    return np.floor(SCALE * np.log(upper / lower)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, runs: int = RUNS) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block in text_blocks(batches):
            words = np.zeros(len(block), np.int64)
            count, total = words.copy(), words.copy()
            for length, text, crc in features(block, runs):
                per_text = np.bincount(text, minlength=len(block))
                count += per_text
                words += per_text if length == 1 else 0
                # sums of whole numbers far below 2^53 are exact as doubles
                total += np.bincount(text, gain[crc % buckets], len(block)).astype(np.int64)
            weight = np.floor_divide(total, np.maximum(count, 1))
            columns = [part.column(part.schema.get_field_index("doc_id")), *map(pa.array, (words, count, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise from the id alone, in thousandths: the same on every run and whatever the partitioning."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    runs: int = RUNS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null if not drawn) of every document.

    Null and empty texts have no features and weight 0; they are scored and never drawn while `least_words` is above 0.
    A null id hashes like an empty one and comes last among equal scores. Repeated rows are rows of their own, weighed,
    ranked and drawn one by one. Only the columns doc_id and text are read, whatever others there are. Without documents
    there are no rows; an empty target leaves the raw shares alone to decide.
    """
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    scores = weighed(docs, gain, runs).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # the row number sets repeated rows apart when they are sorted
    kept = stored(scores.withColumn("copy", F.monotonically_increasing_id()))
    able = F.col("n_words") >= least_words
    histogram = kept.filter(able).groupBy("score").agg(F.count("*").alias("rows"))
    # one row per distinct score: some 100,000 at most, as gains and noise are bounded whatever the number of documents
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = histogram.withColumn("reached", F.sum("rows").over(down))
    drawn = F.expr(f"CAST({percent} AS BIGINT) * sum(rows) DIV 100")
    quota = histogram.agg(drawn.alias("quota")).first()["quota"] or 0
    cut = reached.filter(F.col("reached") >= quota).agg(F.max("score").alias("cut")).first()["cut"] if quota else None
    fields = "doc_id", "n_words", "n_features", "weight", "score"
    if cut is None:
        return kept.select(*fields, F.lit(None).cast("long").alias("rank"))
    high = able & (F.col("score") >= cut)
    sorted_high = numbered(kept.filter(high), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("copy"))
    rank = F.when(F.col("place") < quota, F.col("place") + 1)
    ranked = sorted_high.select(*fields, rank.alias("rank"))
    return ranked.unionByName(kept.filter(~high).select(*fields, F.lit(None).cast("long").alias("rank")))

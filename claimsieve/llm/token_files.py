"""Token ids in ORC files: integer run lengths in stripes, row indexes, Bloom filters on document ids.

1. Encoding: tasks turn whole texts into ids; the ids of a document and its end id are one binary value, stored once.
2. Writing: documents are dealt out by ranges of their id and sorted there, so the files, in the order of their names,
   hold all documents in ascending order. A file's rows carry `start`, the ids in the file before the document, so a row
   index on `start` as well as on `doc_id` leads to a stripe and a row group without reading ids. `ids` is a list of
   integers, which ORC stores by its integer run-length encoding; `doc_id` has a Bloom filter per row group.
3. The manifest has a row per file with the ids and documents ahead of it; it is worked out from the files' columns
   `n_tokens` alone.
4. Reading: stripes are read side by side. `read_documents` asks for single documents, which the scan looks up in the
   file and stripe statistics, row indexes and Bloom filters; `read_span` asks for a span of the token stream.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimsieve.llm.latin_tokens import LatinEncoder
from claimsieve.llm.pattern_packing import BLOCK_CHARS, TOKENIZER
from claimsieve.llm.shared import blocks, stored

END_ID = 1
FILE_BYTES = 256 << 20
STRIPE_BYTES = 32 << 20
ROW_GROUP = 1_000
BLOOM_MISSES = 0.01

_loaded: dict[str, LatinEncoder] = {}


def encoder(path: str) -> LatinEncoder:
    if path not in _loaded:
        _loaded[path] = LatinEncoder(path)
    return _loaded[path]


def encoded(docs: DataFrame, end_id: int | None = END_ID, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (binary) and id_bytes of every document, its end id included.

    Ids travel in the narrowest little-endian integers that hold the vocabulary, `id_bytes` wide.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    end = [] if end_id is None else [end_id]

    def encode(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = encoder(path)
        narrow = "<u2" if max(made.tokenizer.get_vocab_size(), *end, 0) <= 1 << 16 else "<u4"
        tail = np.array(end, narrow).tobytes()
        for pdf in blocks(pdfs, "text", BLOCK_CHARS):
            wide = made.encode(list(pdf["text"]))
            ids = [np.frombuffer(found, "<u4").astype(narrow).tobytes() + tail for found in wide]
            counts = [len(found) // 4 + len(end) for found in wide]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": counts, "ids": ids, "id_bytes": int(narrow[-1])})

    # ids of documents travel as text: pandas would turn long ids beside a null into inexact doubles
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    made = texts.mapInPandas(encode, "doc_id string, n_tokens long, ids binary, id_bytes int")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


FILE_ROWS = "doc_id long, start long, n_tokens long, ids array<int>"


def write_files(tokens: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Rows of `encoded` as ORC files in ascending order of doc_id, null last.

    Equal ids are ordered by size and checksum of their tokens; what is equal still is told apart by its place in the
    stored table, so that a hot id spreads over files. The order is total, so a repeated task writes the same file.
    """
    spark = tokens.sparkSession
    kept = stored(tokens.withColumn("copy", F.monotonically_increasing_id()))
    size = kept.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0] * 4
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / file_bytes))
    order = F.asc_nulls_last("doc_id"), F.asc("n_tokens"), F.crc32("ids").asc(), F.asc("copy")
    ranged = kept.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranged = ranged.select("doc_id", "n_tokens", "ids", "id_bytes")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = 0
        for batch in batches:
            doc_id, n_tokens, ids, id_bytes = batch.columns
            ends = np.cumsum(n_tokens.to_numpy())
            inside = np.append(0, ends).astype(np.int32)
            narrow = f"<u{id_bytes[0].as_py() if len(batch) else 4}"
            values = np.frombuffer(b"".join(ids.to_pylist()), narrow).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(inside), pa.array(values))
            start = pa.array(ahead + inside[:-1].astype(np.int64))
            ahead += int(inside[-1])
            yield pa.RecordBatch.from_arrays(
                [doc_id, start, n_tokens, lists], names=["doc_id", "start", "n_tokens", "ids"]
            )

    (
        ranged.mapInArrow(rows, FILE_ROWS)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(BLOOM_MISSES))
        .option("orc.row.index.stride", str(ROW_GROUP))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.create.index", "true")
        .option("compression", "zstd")
        .orc(folder)
    )


def open_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files, with the name of their file."""
    return spark.read.schema(FILE_ROWS).orc(folder).select("*", F.col("_metadata.file_name").alias("file"))


def manifest(files: DataFrame) -> DataFrame:
    """file, tokens and documents ahead of it, and its own. A row per file meets in one task, none per document."""
    sizes = files.groupBy("file").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)

    def ahead(name: str):
        return F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"{name}_ahead")

    return sizes.select("file", "tokens", "documents", ahead("tokens"), ahead("documents"))


def in_corpus(files: DataFrame, listing: DataFrame) -> DataFrame:
    """The rows with `start` counted over all files. The join is Spark's choice: a row per file on one side."""
    known = files.join(listing.select("file", "tokens_ahead"), "file")
    return known.withColumn("start", F.col("start") + F.col("tokens_ahead"))


def read_documents(files: DataFrame, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of some documents: the scan skips files, stripes and row groups by ranges and Bloom filters."""
    return files.filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def read_span(files: DataFrame, listing: DataFrame, first: int, last: int) -> DataFrame:
    """The documents that hold tokens `first` to `last` (exclusive) of the corpus, with `start` counted over all files.

    The manifest names the files and the places in them; what is asked of each file is a range of its own `start`.
    """
    held = (F.col("tokens_ahead") < last) & (F.col("tokens_ahead") + F.col("tokens") > first)
    spans = listing.filter(held).select("file", "tokens_ahead").collect()
    if not spans:
        return in_corpus(files, listing).filter(F.lit(False))
    wanted = [
        (F.col("file") == span.file)
        & (F.col("start") < last - span.tokens_ahead)
        & (F.col("start") > first - span.tokens_ahead - F.col("n_tokens"))
        for span in spans
    ]
    found = wanted[0]
    for condition in wanted[1:]:
        found = found | condition
    return in_corpus(files.filter(found), listing)


def checksums(rows: DataFrame) -> DataFrame:
    """Rows read from files with ids_crc32, the ids taken as little-endian 32-bit integers, in place of the ids."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, ids = batch.columns
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            ends = ids.offsets.to_numpy()
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            counts = pa.array(np.diff(ends).astype(np.int64))
            columns = [*others, counts, pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "start", "n_tokens", "ids_crc32"])

    fields = "doc_id long, file string, start long, n_tokens long, ids_crc32 long"
    return rows.select("doc_id", "file", "start", "ids").mapInArrow(check, fields)


def file_round_trip(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """The documents written to `folder` and read back: doc_id, start, n_tokens and ids_crc32 of each. The checksums
    are taken where the files are read, so no ids are shuffled for the join with the manifest.

    A null text counts as empty: the end id alone. Repeated rows are written once each, a null id comes last; only
    doc_id and text of `docs` are read, whatever other columns there are. An empty table makes files without rows.
    Texts are never cut; the ids of one document are one value of a task.
    """
    write_files(encoded(docs, path=path), folder)
    files = open_files(docs.sparkSession, folder)
    return in_corpus(checksums(files), manifest(files)).drop("file", "tokens_ahead")

"""Nearest neighbours by inner product along shifted Hilbert curves.

1. Equal vectors are one point that keeps its smallest ids, as many as a query can need; nothing beyond them could
   appear in a result. Queries with equal vectors are searched once.
2. For every curve the points are projected onto a few random orthogonal directions, shifted by a random part of a cell
   and ordered by their Hilbert key. Spark range-partitions each curve by key; a point's rank on the curve is the count
   of the partitions before it and its row number in its own.
3. A query looks at the points whose rank is within `WINDOW / 2` of all points on either side, on each curve. Ranks fall
   into blocks of fixed size; the query visits the blocks that its window touches, and a block hands back its best.
   The answers of all blocks and curves merge, exact scores decide.
4. Curves order directions, but a long vector is near to many queries whatever its direction. Where lengths differ, one
   more order has the points by falling length, and every query looks at the first `WINDOW / 2` of all points there.

Recall at a given window depends on how far the vectors are from a low-dimensional shape. For directions without any
such shape a curve tells little, and only wide windows, which are a share of all points, reach a recall of 0.9. The
README has figures. Because the window is a share, recall does not fall as the table grows, and the work grows as
queries times points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.shared import stored

NEIGHBOURS = 20
QUERY_STEP = 20
CURVES = 6
DIRECTIONS = 8
BITS = 7
WINDOW = 0.24
# the longest vector against the shortest, from which lengths count as uneven
UNEVEN = 1.05
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4096
SEED = 5


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of points with coordinates below 2^bits, (points, directions) -> 64-bit keys.

    The coordinates are turned into the transposed curve position by undoing reflections and exchanges from the
    coarsest to the finest bit, then Gray-decoded and interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    directions = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(directions):
            high = (x[i] & bit) != 0
            exchange = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, exchange)
            x[i] ^= exchange
    for i in range(1, directions):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= flips
    keys = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(directions):
            keys = (keys << 1) | ((x[i] >> level) & 1)
    return keys


def curve_keys(vectors: np.ndarray, curve: int, directions: int, bits: int) -> np.ndarray:
    """Keys of unit-length versions of the vectors on one curve; equal vectors get equal keys."""
    rng = np.random.default_rng((SEED, curve))
    size = vectors.shape[1]
    directions = min(directions, size)
    basis = np.linalg.qr(rng.normal(size=(size, size)))[0][:, :directions]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    # a coordinate of a random direction has a deviation of 1 / sqrt(size); eight of them span the grid
    spread = np.einsum("nd,dk->nk", unit, basis) * math.sqrt(size) + 4 + rng.uniform(-0.5, 0.5, directions)
    cells = np.clip(spread / 8 * (1 << bits), 0, (1 << bits) - 1)
    return hilbert_keys(cells, bits)


def length_keys(vectors: np.ndarray) -> np.ndarray:
    """Keys that put longer vectors first: the bits of a positive double grow with it."""
    return -np.linalg.norm(vectors, axis=1).view(np.int64)


def points(embeddings: DataFrame, keep: int) -> DataFrame:
    """point (the smallest id), vector and ids (the `keep` smallest, ascending) of every distinct usable vector.

    Vectors that are null, empty, zero or hold a null, NaN or infinity take no part, nor do rows with a null id.
    """
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < math.inf) & ~F.isnan(c)), F.lit(False))
        & F.coalesce(F.exists("embedding", lambda c: c != 0), F.lit(False))
    )
    vectors = embeddings.filter(usable).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    # the limit on the row number is pushed below the shuffle: a vector in a third of all rows sends a few per task
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = vectors.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("point"), "vector", "ids")


def ranked(keyed: DataFrame) -> DataFrame:
    """(curve, point, rank): the place of every point on every curve, counted over all partitions.

    Rows are range-partitioned by (curve, key, point) and numbered within a partition and curve; the offset of a
    partition is the count of the same curve in the partitions before it, a table of a row per partition and curve.
    """
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored(
        keyed.repartitionByRange(n, "curve", "key", "point")
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.row_number().over(Window.partitionBy("part", "curve").orderBy("key", "point")) - 1)
    )
    sizes = ordered.groupBy("curve", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("curve", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    numbered = ordered.join(offsets, ["curve", "part"])
    return numbered.select("curve", "point", (F.col("before") + F.col("row")).alias("rank"))


def block_best(queries: pd.DataFrame, rows: pd.DataFrame, keep: int) -> pd.DataFrame:
    """The `keep` best points of a block for each of its queries, with exact scores; ties go to the smaller point."""
    names = ["query_point", "point", "score"]
    if queries.empty or rows.empty:
        return pd.DataFrame({name: [] for name in names})
    rows = rows.sort_values("point")
    asked, held = np.stack(queries["asked"].to_list()), np.stack(rows["vector"].to_list())
    point = rows["point"].to_numpy()
    parts = []
    for start in range(0, len(asked), 256):
        some = asked[start : start + 256]
        rough = some @ held.T
        size = min(keep, len(held))
        limit = -np.partition(-rough, size - 1, axis=1)[:, size - 1] if size else 0
        # rounding of the matrix product must not decide ties: all within it of the limit are scored again
        slack = 1e-9 * np.linalg.norm(some, axis=1) * np.linalg.norm(held, axis=1).max()
        query, row = np.nonzero(rough >= (limit - slack)[:, None])
        exact = (some[query] * held[row]).sum(axis=1)
        order = np.lexsort((point[row], -exact, query))
        query, row, exact = query[order], row[order], exact[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        best = place < keep
        who = queries["query_point"].to_numpy()[start + query[best]]
        parts.append(pd.DataFrame(dict(zip(names, (who, point[row[best]], exact[best]), strict=True))))
    return pd.concat(parts)


def nearest(
    embeddings: DataFrame,
    neighbours: int = NEIGHBOURS,
    query_step: int = QUERY_STEP,
    curves: int = CURVES,
    window: float = WINDOW,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score for every query (ids divisible by `query_step`), nearest first.

    A query never finds its own row. Ties go to the smaller vec_id. Repeated rows are one candidate. Fewer candidates
    than `neighbours` give fewer rows, an empty table none. Further columns are ignored whatever their names.
    """
    slim = embeddings.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull()).distinct()
    all_points = stored(points(slim, neighbours + 1))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, c: total + c * c))
    sizes = all_points.agg(F.count("*").alias("n"), F.min(length).alias("low"), F.max(length).alias("high")).first()
    total, uneven = sizes["n"], sizes["n"] > 0 and sizes["high"] > UNEVEN * sizes["low"]

    def keys(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for size, same in pdf.groupby(pdf["vector"].map(len)):
                vectors = np.stack(same["vector"].to_list())
                for curve in range(curves):
                    own = curve_keys(vectors, curve, DIRECTIONS, BITS)
                    yield pd.DataFrame({"curve": curve, "key": own, "point": same["point"].to_numpy()})
                if uneven:
                    own = length_keys(vectors)
                    yield pd.DataFrame({"curve": curves, "key": own, "point": same["point"].to_numpy()})

    keyed = all_points.select("point", "vector").mapInPandas(keys, "curve int, key long, point long")
    places = stored(ranked(keyed))
    reach = math.ceil(total * window / 2)

    usable = slim.filter(F.col("vec_id") % query_step == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    owners = stored(usable.join(all_points.select("vector", F.col("point").alias("query_point")), "vector"))
    asked = owners.select("query_point").distinct()

    block = (F.col("rank") / block_rows).cast("long")
    with_vector = places.join(all_points.select("point", "vector"), "point")
    held = with_vector.select("curve", block.alias("block"), "point", "vector")
    query_places = with_vector.join(asked, F.col("point") == F.col("query_point"))
    first = F.greatest(F.col("rank") - reach, F.lit(0))
    last = F.least(F.col("rank") + reach, F.lit(max(total - 1, 0)))
    by_length = F.col("curve") == curves
    if uneven:
        held = held.filter(~by_length | (F.col("block") <= reach // block_rows))
        first = F.when(by_length, F.lit(0)).otherwise(first)
        last = F.when(by_length, F.lit(min(reach, total - 1))).otherwise(last)
    blocks = F.sequence((first / block_rows).cast("long"), (last / block_rows).cast("long"))
    # a block with many visitors is copied for every group of them
    queries = asked.count()
    groups = F.lit(max(1, math.ceil(queries * (window + block_rows / max(total, 1)) / BLOCK_QUERIES)))
    if uneven:
        groups = F.when(by_length, F.lit(max(1, math.ceil(queries / BLOCK_QUERIES)))).otherwise(groups)
    visits = query_places.select(
        F.col("curve").alias("on_curve"),
        "query_point",
        F.col("vector").alias("asked"),
        F.explode(blocks).alias("visited"),
        F.pmod(F.xxhash64("query_point"), groups).alias("visitors"),
    )
    held = held.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), (groups - 1).cast("long"))))

    def best(asked_rows: pd.DataFrame, held_rows: pd.DataFrame) -> pd.DataFrame:
        return block_best(asked_rows, held_rows, neighbours + 1)

    both = visits.groupBy("on_curve", "visited", "visitors").cogroup(held.groupBy("curve", "block", "group"))
    found = both.applyInPandas(best, "query_point long, point long, score double")
    order = Window.partitionBy("query_point").orderBy(F.col("score").desc(), "point")
    few = (
        found.distinct()
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= neighbours + 1)
    )
    ids = few.join(all_points.select("point", "ids"), "point").select(
        "query_point", "score", F.explode("ids").alias("vec_id")
    )
    by_score = Window.partitionBy("query_point").orderBy(F.col("score").desc(), "vec_id")
    listed = (
        ids.withColumn("place", F.row_number().over(by_score))
        .filter(F.col("place") <= neighbours + 1)
        .groupBy("query_point")
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    )
    answers = owners.select("query_id", "query_point").distinct().join(listed, "query_point")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, neighbours)
    return answers.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id"), F.col("hit.score")
    )

"""Near-duplicate documents by ProbMinHash sketches of weighted five-word shingles.

1. A document is the multiset of its five-word shingles (lower-case words between white space); the weight of a shingle
   is the number of times it occurs. Documents with the same words share a content key and are one node from here on.
2. Sketch: every shingle sends out a Poisson process of arrivals with its weight as rate; each arrival falls on a
   random component, and a component keeps the shingle that arrived first. A shingle stops as soon as its next arrival
   is later than the latest first arrival of all components. Two documents agree in a component with a probability
   equal to the probability Jaccard similarity of their weights.
3. Bands of `ROWS` components are bucket keys. Only buckets with two or more nodes matter.
4. The members of a bucket are compared inside a task by their whole sketches, a byte per component; no pair is sent
   anywhere because of its bucket alone. First, pairs of `SURE` agreement propose a spanning forest of each bucket, no
   more edges than members; their exact comparison merges most of what belongs together. Then the buckets that still
   hold several components are compared with their shingle sets at hand: pairs of different components and at least
   `FLOOR` agreement, the likeliest first, each link joining components at once, so again only the edges of a forest
   leave the task. Buckets above `CHUNK` members or `CHUNK_BYTES` of sets are cut into parts, and the largest component
   meets the others only, part by part: no bucket, partner or candidate is capped.
5. A comparison is the exact probability Jaccard of the two shingle multisets; a link needs `SIMILARITY`.

With 36 bands of 7 rows a pair of similarity 0.8 is missed with probability 2e-4, one of 0.85 with 1e-6. The agreement
of 252 components has a standard deviation of 0.025 at 0.8, so `FLOOR` misses another 4e-5 there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.shared import marked, release, stored

WORDS = 5
SIMILARITY = 0.8
BANDS = 36
ROWS = 7
BLOCK_CHARS = 1_000_000
MEMO_WORDS = 150_000
ARRIVALS = 50_000
SURE = 0.82
FLOOR = 0.7
CHUNK = 2_000
CHUNK_BYTES = 64 << 20
LEADERS = 8
STRIP_BYTES = 32 << 20
SLICE = 500
CONTESTED_BITS = 1 << 24

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def scramble(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each 64-bit number (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = hashed = xxhash.xxh3_64_intdigest(word)
        return hashed


word_hashes = WordHashes()


def shingles(texts: list[str]) -> tuple[list[bytes | None], np.ndarray, np.ndarray, np.ndarray]:
    """(content key per text, then text number, shingle and weight of each distinct shingle), ordered by both.

    A text of fewer than five words has one shingle, all its words; a text without words has no key and no shingle.
    """
    keys, words, sizes = [], [], []
    for text in texts:
        own = text.lower().split()
        keys.append(xxhash.xxh3_128_digest(" ".join(own)) if own else None)
        words += map(word_hashes.__getitem__, own)
        sizes.append(len(own))
    hashed, sizes = np.array(words, np.uint64), np.array(sizes, np.int64)
    number = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(hashed)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rolled, rest = np.zeros(len(hashed), np.uint64), sizes[number] - place
    for step in range(WORDS):
        # words beyond a short text add nothing
        inside = step < rest
        ahead = np.append(hashed[step:], np.zeros(min(step, len(hashed)), np.uint64))
        rolled = np.where(inside, scramble(rolled * GOLDEN + ahead + np.uint64(1)), rolled)
    starts = (rest >= WORDS) | (place == 0)
    pairs = np.rec.fromarrays([number[starts], rolled[starts]], names="text,shingle")
    order = np.lexsort((pairs.shingle, pairs.text))
    texts_of, values = pairs.text[order], pairs.shingle[order]
    new = np.append(True, (texts_of[1:] != texts_of[:-1]) | (values[1:] != values[:-1])) if len(values) else []
    first = np.flatnonzero(new)
    return keys, texts_of[first], values[first], np.diff(np.append(first, len(values)))


def prob_min_hash(count: int, text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """(count, size) 32-bit winners: the shingle whose arrival was first in each component."""
    earliest, winner = np.full(count * size, np.inf), np.zeros(count * size, np.uint64)
    latest = np.full(count, np.inf)
    rate, time, arrivals = weight.astype(float), np.zeros(len(text)), 0
    while len(text):
        ahead = np.arange(arrivals + 1, arrivals + 1 + max(1, ARRIVALS // len(text)), dtype=np.uint64)
        drawn = scramble(shingle[:, None] + ahead * GOLDEN)
        gaps = -np.log1p(-(drawn >> np.uint64(11)).astype(float) * 2.0**-53) / rate[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        component = scramble(drawn ^ GOLDEN) % np.uint64(size)
        early = times <= latest[text][:, None]
        slots = (text[:, None] * size + component.astype(np.int64))[early]
        found, sender = times[early], np.broadcast_to(shingle[:, None], times.shape)[early]
        np.minimum.at(earliest, slots, found)
        won = earliest[slots] == found
        winner[slots[won]] = sender[won]
        alive = np.unique(text)
        latest[alive] = earliest.reshape(count, size)[alive].max(axis=1)
        arrivals += len(ahead)
        go_on = times[:, -1] <= latest[text]
        text, shingle, rate, time = text[go_on], shingle[go_on], rate[go_on], times[go_on, -1]
    return (winner >> np.uint64(32)).reshape(count, size)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) 64-bit bucket keys; the same values in another band give another key."""
    parts = sketches.reshape(len(sketches), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2])
    for row in range(rows):
        keys = scramble(keys * GOLDEN + parts[:, :, row])
    return keys.view(np.int64)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Sum over common shingles i of 1 / sum over all j of max(x_j / x_i, y_j / y_i); shingles are ascending.

    Sorted by the ratio x / y, the j with a larger ratio than i contribute x_j / x_i and the others y_j / y_i.
    """
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(in_a):
        return 0.0
    common_x, common_y = x[in_a].astype(float), y[in_b].astype(float)
    ratio = common_x / common_y
    order = np.argsort(ratio, kind="stable")
    common_x, common_y = common_x[order], common_y[order]
    only_x, only_y = x.sum() - common_x.sum(), y.sum() - common_y.sum()
    from_here = np.cumsum(common_x[::-1])[::-1] + only_x
    before = np.cumsum(common_y) - common_y + only_y
    return float((1 / (from_here / common_x + before / common_y)).sum())


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task cut where their texts pass `BLOCK_CHARS`, so that few texts at a time leave Arrow.

    Workers outlive the task, so what they remember of words and hold for further batches goes with it.
    """
    for batch in batches:
        lengths = pc.utf8_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (np.cumsum(lengths) - lengths) // BLOCK_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for start, end in pairwise(cuts):
            if end > start:
                yield batch.slice(start, end - start)
        release()
    word_hashes.clear()
    release()


def sketched(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, content_key (null without words) and `buckets`; a block sends the buckets of equal texts once."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            keys, text, shingle, weight = shingles(block["text"].to_pylist())
            found = band_keys(prob_min_hash(len(keys), text, shingle, weight, bands * rows), bands, rows)
            first = {key: i for i, key in reversed(list(enumerate(keys))) if key is not None}
            own = [row if key is not None and first[key] == i else None for i, (key, row) in enumerate(zip(keys, found))]
            columns = [block["doc_id"], pa.array(keys, pa.binary()), pa.array(own, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content_key", "buckets"])

    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    made = texts.mapInArrow(sketch, "doc_id string, content_key binary, buckets array<long>")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def content_key(text: Column) -> Column:
    """The key that documents with the same words share; null without words.

    Called non-deterministic, so that a filter on the key stays above it. Pushed below, it would work the key out a second
    time in the same task, and every task would hold two Python workers at once.
    """

    def of(text: str) -> bytes | None:
        words = text.lower().split()
        return xxhash.xxh3_128_digest(" ".join(words)) if words else None

    @F.arrow_udf("binary")
    def key(texts: pa.Array) -> pa.Array:
        keys = pa.array((of(text.as_py()) for text in texts), pa.binary())
        release()
        return keys

    return key.asNondeterministic()(F.coalesce(text, F.lit("")))


def shingle_sets(docs: DataFrame, keys: DataFrame, components: int) -> DataFrame:
    """content_key, shingles, weights, sketch (binary) and bytes of the nodes in `keys`, each once.

    The sketch here holds the last byte of each component: one in 256 unlike ones looks alike.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            found, text, shingle, weight = shingles(block["text"].to_pylist())
            ends = np.searchsorted(text, np.arange(1, len(found) + 1))
            spans = list(zip([0, *ends[:-1]], ends, strict=True))
            winners = prob_min_hash(len(found), text, shingle, weight, components).astype(np.uint8)
            yield pa.RecordBatch.from_pydict(
                {
                    "content_key": pa.array(found, pa.binary()),
                    "shingles": pa.array([shingle[a:b].tobytes() for a, b in spans], pa.binary()),
                    "weights": pa.array([weight[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                    "sketch": pa.array([row.tobytes() for row in winners], pa.binary()),
                    "bytes": pa.array([12 * int(b - a) + 200 for a, b in spans], pa.int64()),
                }
            )

    texts = docs.filter(F.col("text").isNotNull()).select(content_key(F.col("text")).alias("content_key"), "text")
    wanted = keys.select("content_key")
    near, hit = marked(texts, F.xxhash64("content_key"), wanted, F.xxhash64("content_key"))
    once = near.filter(hit).groupBy("content_key").agg(F.min("text").alias("text")).join(wanted, "content_key")
    fields = "content_key binary, shingles binary, weights binary, sketch binary, bytes long"
    return once.select("text").mapInArrow(sets, fields)


def sliced(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, a few hundred taken out of Arrow at a time."""
    for start in range(0, batch.num_rows, SLICE):
        yield from batch.slice(start, SLICE).to_pylist()


def links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of at least the similarity."""

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("content_key").alias(name), F.col("shingles").alias(f"{name}_set"), F.col("weights").alias(f"{name}_weights")
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                probability_jaccard(
                    np.frombuffer(row["a_set"], np.uint64), np.frombuffer(row["a_weights"], "<u4"),
                    np.frombuffer(row["b_set"], np.uint64), np.frombuffer(row["b_weights"], "<u4"),
                ) >= similarity - 1e-9
                for row in sliced(batch)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
            release()

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(compare, "a binary, b binary")


def merged(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """`nodes` (content_key, component) after the components that an edge (a, b) joins have become one.

    Every component hooks onto its smallest neighbour and the graph shrinks to the hooks, until no edge is left. Keys
    are hashes, so a constant share of the components goes each time.
    """
    while True:
        sides = [
            nodes.select(F.col("content_key").alias(side), F.col("component").alias(f"component_{side}"))
            for side in "ab"
        ]
        between = edges.join(sides[0], "a").join(sides[1], "b").select("a", "b", "component_a", "component_b")
        edges = stored(between.filter(F.col("component_a") != F.col("component_b")))
        if edges.isEmpty():
            return nodes
        either = edges.select(F.col("component_a").alias("component"), F.col("component_b").alias("other")).unionByName(
            edges.select(F.col("component_b").alias("component"), F.col("component_a").alias("other"))
        )
        hooks = either.groupBy("component").agg(F.min("other").alias("other"))
        hooked = nodes.join(hooks, "component", "left")
        smaller = F.least("component", F.coalesce("other", "component")).alias("component")
        nodes = stored(hooked.select("content_key", smaller))
        edges = edges.select("a", "b")


class Group:
    """Members of one bucket, or of two parts of it, in a task."""

    def __init__(self, rows: list[dict], exact: bool, similarity: float):
        self.rows, self.exact, self.similarity = rows, exact, similarity
        self.leader: dict[bytes, bytes] = {}

    def component(self, row: dict) -> bytes:
        own = row["component"]
        while (above := self.leader.get(own, own)) != own:
            self.leader[own] = own = self.leader.get(above, above)
        return own

    def likely(self) -> list[tuple[float, int, int]]:
        """(agreement, place, place) of the pairs worth a look, the likeliest first, ties by place."""
        least = FLOOR if self.exact else SURE
        sketches = np.stack([np.frombuffer(row["sketch"], np.uint8) for row in self.rows])
        sides = np.array([row["side"] for row in self.rows])
        names = {name: number for number, name in enumerate({row["component"] for row in self.rows})}
        own = np.array([names[row["component"]] for row in self.rows])
        one_part = len(set(sides.tolist())) == 1 and self.rows[0]["p"] == self.rows[0]["q"]
        # the rows of the largest component meet the others from their side
        outer = np.flatnonzero(own != np.bincount(own).argmax()) if one_part else np.flatnonzero(sides == sides.max())
        if one_part and len(names) == len(own):
            outer = np.arange(len(own))
        inner = np.zeros(len(own), bool)
        inner[outer] = True
        found = []
        strip = max(1, STRIP_BYTES // sketches.size)
        for start in range(0, len(outer), strip):
            some = outer[start : start + strip]
            agreement = (sketches[some][:, None, :] == sketches[None, :, :]).mean(axis=2)
            agreement[own[some][:, None] == own[None, :]] = 0
            if not one_part:
                agreement[sides[some][:, None] == sides[None, :]] = 0
            agreement[inner[None, :] & (np.arange(len(own))[None, :] <= some[:, None])] = 0  # met from the other side
            left, right = np.nonzero(agreement >= least)
            found += zip((-agreement[left, right]).tolist(), some[left].tolist(), right.tolist(), strict=True)
        return sorted(found)

    def linked(self, a: dict, b: dict) -> bool:
        """Whether the pair is alike; without sets at hand every likely pair counts."""
        if not self.exact:
            return True
        return (
            probability_jaccard(
                np.frombuffer(a["shingles"], np.uint64), np.frombuffer(a["weights"], "<u4"),
                np.frombuffer(b["shingles"], np.uint64), np.frombuffer(b["weights"], "<u4"),
            ) >= self.similarity - 1e-9
        )

    def forest(self) -> list[dict]:
        """The links that join components, each pair looked at unless links before it have joined it."""
        edges = []
        for _, i, j in self.likely():
            a, b = self.rows[i], self.rows[j]
            own, other = self.component(a), self.component(b)
            if own != other and self.linked(a, b):
                self.leader[max(own, other)] = min(own, other)
                low, high = sorted((a["content_key"], b["content_key"]))
                edges.append({"a": low, "b": high})
        return edges


def compared(rows: DataFrame, exact: bool, similarity: float) -> DataFrame:
    """Edges (a, b) between the members of each group (bucket, p, q), which stream through a task one after the other.

    In a group of two parts, p and q, only members of different `side` meet.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        name = None
        for batch in batches:
            for row in sliced(batch):
                if (row["bucket"], row["p"], row["q"]) != name:
                    if len(group) > 1:
                        yield pa.RecordBatch.from_pylist(Group(group, exact, similarity).forest(), schema=schema)
                    group, name = [], (row["bucket"], row["p"], row["q"])
                group.append(row)
        if len(group) > 1:
            yield pa.RecordBatch.from_pylist(Group(group, exact, similarity).forest(), schema=schema)
        group.clear()
        release()

    keys = "bucket", "p", "q"
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "content_key")
    return dealt.mapInArrow(compare, "a binary, b binary").distinct()


def _met_by_leaders(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links of the members of buckets that were cut to a few leaders of the bucket, of small components first."""
    sized = Window.partitionBy("bucket", "component")
    order = Window.partitionBy("bucket").orderBy("members", F.xxhash64("content_key"), "content_key")
    counted = placed.withColumn("members", F.count("*").over(sized))
    leaders = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= LEADERS)
    leaders = leaders.select("bucket", F.col("content_key").alias("leader"), F.col("component").alias("leads"))
    met = placed.join(leaders, "bucket").filter(F.col("component") != F.col("leads"))
    pairs = met.select(F.least("content_key", "leader").alias("a"), F.greatest("content_key", "leader").alias("b"))
    return links(pairs.distinct(), sets, similarity)


def _parts(rows: Column, size: Column) -> Column:
    return F.greatest(F.ceil(rows / CHUNK), F.ceil(size / CHUNK_BYTES), F.lit(1)).cast("int")


def _open_groups(placed: DataFrame) -> DataFrame:
    """The members of buckets with several components, in the groups (p, q) in which they are compared.

    The largest component is cut into parts 0 to a - 1, the other members into parts from a on. Pairs of parts of the
    largest component are no groups. What fits is one group.
    """
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("size"))
    largest = F.max(F.struct("n", "size", "component"))
    whole = parts.groupBy("bucket").agg(
        largest.alias("largest"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("components")
    )
    a, b = F.col("large_parts"), F.col("small_parts")
    opened = whole.filter(F.col("components") > 1).select(
        "bucket",
        F.col("largest.component").alias("largest"),
        (_parts(F.col("n"), F.col("size")) == 1).alias("single"),
        _parts(F.col("largest.n"), F.col("largest.size")).alias("large_parts"),
        _parts(F.col("n") - F.col("largest.n"), F.col("size") - F.col("largest.size")).alias("small_parts"),
    )
    is_large = F.col("component") == F.col("largest")
    part = F.pmod(F.xxhash64("content_key"), F.when(is_large, a).otherwise(b)).cast("int")
    own = F.when(F.col("single"), 0).when(is_large, part).otherwise(a + part)

    def pair(other: Column) -> Column:
        return F.struct(F.least("side", other).alias("p"), F.greatest("side", other).alias("q"))

    smalls = F.transform(F.sequence(F.lit(0), b - 1), lambda i: pair(a + i))
    larges = F.transform(F.sequence(F.lit(0), a - 1), pair)
    groups = F.when(F.col("single"), F.array(pair(F.lit(0)))).when(is_large, smalls).otherwise(F.concat(larges, smalls))
    dealt = placed.join(opened, "bucket").withColumn("side", own).withColumn("group", F.explode(groups))
    return dealt.select("bucket", "group.p", "group.q", "side", "content_key", "component")


def settled(members: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """`nodes` after all buckets of `members` (bucket, content_key) are settled."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    wide = sizes.filter(F.col("n") > CHUNK)
    side = F.pmod(F.xxhash64("content_key"), F.ceil(F.col("n") / CHUNK)).cast("int")
    parted = members.join(sizes, "bucket").select("bucket", "content_key", side.alias("side"))
    alone = parted.select("*", *(F.col("side").alias(name) for name in "pq"), F.col("content_key").alias("component"))
    sketches = sets.select("content_key", "sketch")
    proposed = stored(compared(alone.join(sketches, "content_key"), False, similarity))
    nodes = merged(nodes, stored(links(proposed, sets, similarity)))
    if not wide.isEmpty():
        cut = members.join(wide.select("bucket"), "bucket").join(nodes, "content_key")
        nodes = merged(nodes, stored(_met_by_leaders(cut, sets, similarity)))
    placed = members.join(nodes, "content_key").join(sets.select("content_key", "bytes"), "content_key")
    doubtful = _open_groups(stored(placed)).join(sets.drop("bytes"), "content_key")
    return merged(nodes, stored(compared(doubtful, True, similarity)))


def contested(keyed: DataFrame, components: DataFrame) -> DataFrame:
    """(content_key, component) of the keys in classes of several documents, whether near copies or the same words."""
    counted = keyed.filter(F.col("content_key").isNotNull()).groupBy("content_key").agg(F.count("*").alias("documents"))
    near = F.col("component").isNotNull()
    found = counted.join(components, "content_key", "left").filter(near | (F.col("documents") > 1))
    found = found.withColumn("component", F.coalesce("component", "content_key"))
    # a component bears the key of one of its nodes, so that of a single document bears its only key
    alone = found.groupBy("component").agg(F.sum("documents").alias("documents")).filter(F.col("documents") == 1)
    keys = alone.select(F.col("component").alias("content_key"))
    return found.join(keys, "content_key", "left_anti").select("content_key", "component")


def content_classes(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, several: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, content_key) of every document, and (content_key, component) of the nodes that share a bucket.

    With `several`, the components are instead those of `contested`: every key whose class has several documents.
    """
    found = stored(sketched(docs, bands, rows))
    exploded = found.filter(F.col("buckets").isNotNull()).select("content_key", F.explode("buckets").alias("bucket"))
    in_bucket = exploded.distinct()
    shared = in_bucket.groupBy("bucket").agg(F.count("*").alias("nodes")).filter(F.col("nodes") > 1)
    members = stored(in_bucket.join(shared.select("bucket"), "bucket"))
    nodes = stored(members.select("content_key").distinct())
    sets = stored(shingle_sets(docs, nodes, bands * rows))
    start = nodes.withColumn("component", F.col("content_key"))
    keyed, components = found.select("doc_id", "content_key"), settled(members, start, sets, similarity)
    return keyed, stored(contested(keyed, components)) if several else components


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id and class_id of every document: the smallest id of its class.

    Documents without words (null and empty texts too) are classes of their own. A null id never names a class unless
    all ids of the class are null. Repeated rows give a row each and share their class; further columns are ignored
    whatever their names.
    """
    keyed, components = content_classes(docs, similarity, bands, rows)
    worded = keyed.filter(F.col("content_key").isNotNull())
    placed = worded.join(components, "content_key", "left").select(
        "doc_id", F.coalesce("component", "content_key").alias("class_key")
    )
    smallest = placed.groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    named = placed.join(smallest, "class_key").select("doc_id", "class_id")
    alone = keyed.filter(F.col("content_key").isNull()).select("doc_id", F.col("doc_id").alias("class_id"))
    return named.unionByName(alone)


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The columns of `docs`, one row of each class: the smallest id, null last. Documents without words all stay.

    Only rows whose key hits a mark of a class of several documents are shuffled; the others stay where they are.
    """
    _, components = content_classes(docs, similarity, bands, rows, True)

    columns = [F.col(f"`{name}`") for name in docs.columns]
    # names with a blank meet no column of `docs`
    keyed = docs.select(*columns, content_key(F.col("text")).alias("own key"))
    near, hit = marked(keyed, F.xxhash64("own key"), components, F.xxhash64("content_key"), CONTESTED_BITS)
    meets = hit & F.col("own key").isNotNull()

    def first(rows: DataFrame, name: str) -> DataFrame:
        # the limit on the row number is pushed below the shuffle: a group of any size sends one row per task
        order = Window.partitionBy(name).orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64(*columns))
        return rows.withColumn("place in group", F.row_number().over(order)).filter(F.col("place in group") == 1)

    of_key = first(near.filter(meets), "own key").select(*columns, "own key")
    classed = of_key.join(components.toDF("node key", "node class"), F.col("own key") == F.col("node key"), "left")
    chosen = first(classed.select(*columns, F.coalesce("node class", "own key").alias("class key")), "class key")
    return chosen.select(*columns).unionByName(near.filter(~meets).select(*columns))

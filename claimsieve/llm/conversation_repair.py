"""Repairing the structure of conversations at the least cost, by a suffix-shared automaton over all of them.

1. Every row is a symbol: the initial of its role and its fault. Blank rows and duplicates must go whatever their role.
   Spark deals the rows out by conversation and sorts them, a task reads them as a stream, so a conversation costs a
   byte per row in memory and its texts stay where they are; duplicates are found by digests.
2. Signatures (the symbols of a conversation) are sorted by their reversed text, by ranges. Neighbours share the
   longest endings, so the path of nodes from the end of one signature is kept for the next: a shared suffix is worked
   out once per range, and equal signatures cost nothing. Nodes are minimised as they are made: two suffixes whose costs
   to go differ by the same amount in every grammar state are one node of the automaton, and an arc (symbol, node) is
   worked out once. It holds the cheapest first edit for each grammar state, ties to the ASCII-least audit; equal first
   edits lead to the same state, so comparing first edits compares whole audits.
3. The audit of a conversation is read off its path. Audits go back to the rows, sorted ahead of them, and the
   repaired texts stream through the digest.

A SHA-256 has no parallel form and an audit is one value, so a conversation of any length passes through one task, as a
stream: its memory is some 12 bytes per row, never its texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.shared import stored

# Blanks, ends of sentences, damages by remainder, edits and their costs.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
DAMAGES, DROPPED, EMPTIED, UNENDED, REPEATED, TURNED = 20, 0, 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
LEGAL_PAIRS = ("su", "ua", "au")

# The grammar (s?(ua)+)? as states: nothing yet, system seen, user seen, assistant seen.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ACCEPTED = 0, 3
# what Rerole and Insert write in each state; the grammar takes one of the two at most
WRITES = ["user", "user", "assistant", "user"]
MUST_GO = "x"
OTHER = "o"


def _after_writing(state: int) -> int:
    return NEXT[state][WRITES[state][0]]


class Automaton:
    """Nodes are suffixes up to a shift of all costs; arcs are the nodes that a symbol in front of a node makes."""

    def __init__(self):
        self.nodes: dict[tuple[int, ...], int] = {}
        self.arcs: dict[tuple[str, int], int] = {}
        self.relative: list[tuple[int, ...]] = []
        # per arc: the node it makes, the shift of its costs, the first edit in each state
        self.made: list[tuple[int, int, tuple[str, ...]]] = []
        self.end = self._arc("", [{0: 0} if state in ACCEPTED else {} for state in range(len(NEXT))])

    def _arc(self, key, options: list[dict]) -> int:
        """`options[state]` maps first edits that use the row up (or 0: the end) to costs; insertions are added here."""
        best = [min(((cost, edit) for edit, cost in found.items()), key=_by_cost, default=None) for found in options]
        settled = False
        while not settled:  # an insertion costs, so a cheaper way through insertions has no loop
            settled = True
            for state in range(len(NEXT)):
                ahead = best[_after_writing(state)]
                if ahead is not None:
                    inserted = ahead[0] + COSTS[INSERT], INSERT
                    if best[state] is None or _by_cost(inserted) < _by_cost(best[state]):
                        best[state], settled = inserted, False
        least = min(cost for cost, _ in best)
        relative = tuple(cost - least for cost, _ in best)
        if relative not in self.nodes:
            self.nodes[relative] = len(self.relative)
            self.relative.append(relative)
        self.made.append((self.nodes[relative], least, tuple(edit for _, edit in best)))
        self.arcs[key] = len(self.made) - 1
        return len(self.made) - 1

    def arc(self, symbol: str, node: int) -> int:
        """The arc of a row's symbol in front of the suffixes of `node`."""
        known = self.arcs.get((symbol, node))
        if known is not None:
            return known
        behind, extra = self.relative[node], TRUNCATED_COST if symbol.isupper() else 0
        options = []
        for state, following in enumerate(NEXT):
            found = {DELETE: COSTS[DELETE] + behind[state]}
            if symbol != MUST_GO:
                found[REROLE] = COSTS[REROLE] + extra + behind[_after_writing(state)]
                if symbol.lower() in following:
                    found[KEEP] = COSTS[KEEP] + extra + behind[following[symbol.lower()]]
            options.append(found)
        return self._arc((symbol, node), options)


def _by_cost(option: tuple) -> tuple:
    return option[0], str(option[1])


class Path:
    """The arcs of one signature from its end, kept for the next signature with the same ending."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.signature = automaton, ""
        node, shift, _ = automaton.made[automaton.end]
        self.arcs, self.shifts = array("l", [automaton.end]), array("q", [shift])

    def extend(self, signature: str) -> None:
        """To another signature: the arcs of the common ending stay."""
        shared, most = 0, min(len(signature), len(self.signature))
        if signature == self.signature:
            return
        step = 1 << max(0, most.bit_length() - 1)
        while step:  # the longest common ending, by halving steps
            longer = shared + step
            if longer <= most and signature[len(signature) - longer :] == self.signature[len(self.signature) - longer :]:
                shared = longer
            step >>= 1
        del self.arcs[shared + 1 :], self.shifts[shared + 1 :]
        arc, made = self.automaton.arc, self.automaton.made
        for symbol in reversed(signature[: len(signature) - shared]):
            self.arcs.append(arc(symbol, made[self.arcs[-1]][0]))
            self.shifts.append(self.shifts[-1] + made[self.arcs[-1]][1])
        self.signature = signature

    def answer(self) -> tuple[int, str]:
        """Cost and audit of the whole signature."""
        made, edits, state, left = self.automaton.made, [], 0, len(self.signature)
        cost = self.shifts[-1] + self.automaton.relative[made[self.arcs[-1]][0]][0]
        while True:
            edit = made[self.arcs[left]][2][state]
            if edit == 0:
                return cost, "".join(edits)
            edits.append(edit)
            if edit == INSERT:
                state = _after_writing(state)
                continue
            symbol = self.signature[len(self.signature) - left].lower()
            state = state if edit == DELETE else _after_writing(state) if edit == REROLE else NEXT[state][symbol]
            left -= 1


@cache
def automaton() -> Automaton:
    """One automaton per worker: it has a few dozen nodes, whatever the conversations."""
    return Automaton()


def damaged(talks: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `gone` (the row is dropped) after the damages that conv_id and turn decide."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % DAMAGES
    text = F.when(kind == EMPTIED, F.lit("")).when(kind == UNENDED, F.translate(known("text"), ENDS, ""))
    copies = F.when(kind == REPEATED, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return talks.select(
        "conv_id",
        "turn",
        F.when(kind == TURNED, F.lit("user")).otherwise(known("role")).alias("role"),
        text.otherwise(known("text")).alias("text"),
        (kind == DROPPED).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _in_order(rows: DataFrame, *more: str) -> DataFrame:
    """Each conversation in one partition, its rows by turn, nulls first; equal turns by role and digest of the text."""
    turn = F.asc_nulls_first("turn")
    return rows.sortWithinPartitions(F.asc_nulls_first("conv_id"), *more, turn, "role", "digest")


def _digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


SIGNED = "signature string, gaps long, blank long, duplicate long, truncated long, illegal long"


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature and counts of every conversation of damaged rows (conv_id, turn, role, text, gone)."""
    body = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(body == "", F.lit("blank")).when(~F.right(body, F.lit(1)).isin(*ENDS), F.lit("truncated"))
    small = _digested(rows).select("conv_id", "turn", "role", "digest", "gone", fault.alias("fault"))
    # one shuffle: the window and the stream both find their conversation in the partition
    dealt = small.repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "digest", "gone").orderBy(F.asc_nulls_first("turn"))
    seen = dealt.withColumn("again", F.row_number().over(same) > 1)
    initial = F.left("role", F.lit(1))
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit(OTHER))
    marked = (
        F.when(F.col("gone"), F.lit(""))
        .when(F.col("fault") == "blank", F.lit("b"))
        .when(F.col("again"), F.lit("d"))
        .when(F.col("fault") == "truncated", F.lit("t"))
        .otherwise(F.lit("k"))
    )
    stream = _in_order(seen).select("conv_id", "turn", symbol.alias("symbol"), marked.alias("mark"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # conversations in the order of the rows; what is known of the last one is carried to the next batch
        schema = None
        current: dict | None = None
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(0), *_signed_fields()])
            done = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for conv_id, turn, letter, mark in zip(*columns, strict=True):
                if current is None or conv_id != current["conv_id"]:
                    if current is not None:
                        done.append(_signed(current))
                    current = {"conv_id": conv_id, "signature": bytearray(), "first": None, "last": None, "turns": 0,
                               "b": 0, "d": 0, "t": 0, "k": 0, "before": "", "illegal": 0}
                if not mark:
                    continue
                current[mark] += 1
                current["illegal"] += bool(current["before"]) and current["before"] + letter not in LEGAL_PAIRS
                current["before"] = letter
                coded = MUST_GO if mark in "bd" else letter.upper() if mark == "t" else letter
                current["signature"] += coded.encode()
                if turn is not None and turn != current["last"]:
                    current["turns"] += 1
                    current["first"] = turn if current["first"] is None else current["first"]
                    current["last"] = turn
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([_signed(current)], schema=schema)

    return stream.mapInArrow(sign, f"conv_id {kind}, {SIGNED}")


def _signed_fields() -> list[pa.Field]:
    return [pa.field("signature", pa.string())] + [
        pa.field(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal")
    ]


def _signed(found: dict) -> dict:
    spread = found["last"] - found["first"] + 1 - found["turns"] if found["turns"] else 0
    return {
        "conv_id": found["conv_id"],
        "signature": found["signature"].decode(),
        "gaps": spread,
        "blank": found["b"],
        "duplicate": found["d"],
        "truncated": found["t"],
        "illegal": found["illegal"],
    }


def audited(signed: DataFrame) -> DataFrame:
    """The conversations with cost and audit. Ranges of reversed signatures bring shared endings together; the hash of
    the id lets equal signatures, however many, spread over ranges."""
    order = F.reverse("signature"), F.xxhash64("conv_id")
    ranged = signed.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in signed.schema)

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, last, answer = Path(automaton()), None, (0, "")
        for batch in batches:
            costs, audits = [], []
            for signature in batch.column(batch.schema.get_field_index("signature")).to_pylist():
                if signature != last:
                    path.extend(signature)
                    last, answer = signature, path.answer()
                costs.append(answer[0])
                audits.append(answer[1])
            columns = [*batch.columns, pa.array(costs, pa.int64()), pa.array(audits, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cost", "audit"])

    return ranged.mapInArrow(audit, f"{fields}, cost long, audit string")


COUNTS = "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"


class _Repair:
    """The digest of one conversation, row by row."""

    def __init__(self, conv_id, counts: tuple):
        self.conv_id, self.counts, self.edits = conv_id, counts, iter(counts[-1])
        self.state, self.digest, self.first = 0, hashlib.sha256(), True

    def write(self, role: str, text: str) -> None:
        self.digest.update(b"" if self.first else b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.first = False

    def insert(self) -> None:
        self.write(WRITES[self.state], "")
        self.state = _after_writing(self.state)

    def row(self, role: str, text: str) -> None:
        for edit in self.edits:
            if edit == INSERT:
                self.insert()
                continue
            if edit == KEEP:
                self.write(role, text)
                self.state = NEXT[self.state][role[0]]
            elif edit == REROLE:
                self.write(WRITES[self.state], text)
                self.state = _after_writing(self.state)
            return

    def result(self) -> tuple:
        for _ in self.edits:  # insertions behind the last row
            self.insert()
        return (self.conv_id, *self.counts, self.digest.hexdigest())


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, the counts, cost, audit and repaired_sha256 of every conversation.

    A conversation's audit is sorted ahead of its rows, so that the rows stream past it.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    shown = _digested(rows.filter(~F.col("gone"))).select("conv_id", "turn", "role", "digest", "text")
    both = shown.withColumn("part", F.lit(1)).unionByName(
        audits.select("conv_id", F.lit(0).alias("part"), *COUNTS), allowMissingColumns=True
    )
    stream = _in_order(both.repartition("conv_id"), "part").select("part", "role", "text", "conv_id", *COUNTS)
    fields = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current = None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            names = ["conv_id", *COUNTS, "repaired_sha256"]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in rows], schema=schema)

        for batch in batches:
            types = [batch.schema.field(name) for name in ("conv_id", *COUNTS)]
            schema = schema or pa.schema([*types, pa.field("repaired_sha256", pa.string())])
            done = []
            for part, role, text, *found in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if part == 0:
                    if current is not None:
                        done.append(current.result())
                    current = _Repair(found[0], tuple(found[1:]))
                else:
                    current.row(role, text)
            yield made(done)
        if current is not None:
            yield made([current.result()])

    return stream.mapInArrow(repair, fields + "audit string, repaired_sha256 string")


def repair(talks: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation.

    `talks` holds conv_id, turn, role and text; other columns are ignored whatever their names. Nulls of any of the
    four count as one space; rows without conv_id are one conversation and rows without turn come first. Rows of equal
    turn are taken by role and then by the SHA-256 of their text, so repeated rows are adjacent and all but the first
    are duplicates. Roles whose initial is not s, u or a fit nowhere and have to be rewritten or deleted. An empty
    table has no conversations.
    """
    rows = damaged(talks)
    return repaired(rows, stored(audited(stored(signatures(rows)))))

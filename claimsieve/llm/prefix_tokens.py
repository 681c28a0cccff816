"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

The vocabulary is a sentencepiece BPE model with byte fallback. For such a vocabulary the encoding of a prefix
ends in exactly one token `t` for which (last token of the shorter prefix, t) is a pair that encodes to itself, so

    tokens(prefix i) = tokens(prefix i - len(t)) + weight(t)

with weight 1, or the number of UTF-8 bytes for a character outside the vocabulary. The pieces that end at a character
are known from the longest stretch before it that some piece begins with, so a character costs a step of an automaton
and a look at the one or two pieces that fit. No piece of the vocabulary crosses from a word into the space before the
next one, so the table of a text is the tables of its space-led words one after the other, and each distinct word is
worked out once per worker while it keeps coming up: the memos are bounded in bytes, and that of words has an older half
that goes when the younger one is full.

The table keeps one signed byte per character: the change of the count. Its running sum is the exact count at every
prefix, from which totals, truncation points and budget splits follow without encoding anything again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.shared import blocks

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MEMO_BYTES = 120 << 20
ENTRY_BYTES = 200  # of a word or a pair with its place in a dictionary, beside the characters
MEMO_WORD_CHARS = 64
MEMO_STEPS = 200_000
BLOCK_CHARS = 1_000_000

_loaded: dict[str, "PrefixCounter"] = {}


class PrefixCounter:
    """Prefix tables for one model file."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        skip = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        self.rank = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.get_piece_size())
            if not any(kind(i) for kind in skip)
        }
        inner = any(SPACE in piece.lstrip(SPACE) for piece in self.rank)
        lines = any("\n" in piece for piece in self.rank)
        # where a piece could cross into the next word, the whole text is one word
        self.words = re.compile(r"(?s).+" if inner or lines else rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+").findall
        self.beginnings = {piece[:end] for piece in self.rank for end in range(1, len(piece) + 1)}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.steps: dict[str, tuple[str, list[tuple[str, int, int]]]] = {}
        self.memo_bytes = self.pair_bytes = 0

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text: the best-ranked adjacent pair is joined first, the left one among equals."""
        parts, get, none = list(text), self.rank.get, float("inf")
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], none)
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], none)
        return parts

    def follows(self, left: str, right: str) -> bool:
        """Whether `right` can stand after `left` in an encoding. `left` is empty at the start."""
        known = self.merge(left + right) == ([left, right] if left else [right])
        if self.pair_bytes > MEMO_BYTES:
            self.pairs.clear()
            self.pair_bytes = 0
        self.pairs[left, right] = known
        self.pair_bytes += ENTRY_BYTES + len(left) + len(right)
        return known

    def step(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The longest end of `text` that a piece begins with, and (piece, length, weight) of all that end there, longest
        first. The last character is one of them even where the vocabulary lacks it."""
        ends = [text[start:] for start in range(len(text))]
        fits = [(end, len(end), 1) for end in ends if end in self.rank]
        if text[-1] not in self.rank:
            fits.append((text[-1], 1, len(text[-1].encode())))
        found = next((end for end in ends if end in self.beginnings), ""), fits
        if len(self.steps) > MEMO_STEPS:
            self.steps.clear()
        self.steps[text] = found
        return found

    def learn(self, words: list[str]) -> Iterator[bytes]:
        """The change of the token count at each character of each word. Neighbours that begin alike share that part."""
        steps, pairs, step, follows = self.steps, self.pairs, self.step, self.follows
        before, states, last, counts = "", [""], [""], [0]
        for word in words:
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :], last[shared + 1 :], counts[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, len(word) + 1):
                text = state + word[end - 1]
                state, fits = steps.get(text) or step(text)
                for piece, length, weight in fits:
                    left = last[end - length]
                    known = pairs.get((left, piece))
                    if known or known is None and follows(left, piece):
                        states.append(state)
                        last.append(piece)
                        counts.append(counts[end - length] + weight)
                        break
            before = word
            yield bytes([(b - a) & 255 for a, b in zip(counts, counts[1:], strict=False)])

    def tables(self, texts: Sequence[str]) -> list[bytes]:
        """Per text one byte per character, behind one for the leading space that the model adds; b"" for no text."""
        worded = [self.words(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        if self.memo_bytes > MEMO_BYTES // 2:
            self.older, self.memo, self.memo_bytes = self.memo, {}, 0
        memo, older, new = self.memo, self.older, []
        here: dict[str, bytes] = {}  # of this block alone: long words, and all once the memo is full

        def keep(word: str, table: bytes) -> None:
            if len(word) > MEMO_WORD_CHARS or self.memo_bytes > MEMO_BYTES // 2:
                here[word] = table
            else:
                memo[word] = table
                self.memo_bytes += ENTRY_BYTES + 2 * len(word)

        for word in set().union(*worded):
            if word not in memo:
                if word in older:
                    keep(word, older[word])
                else:
                    new.append(word)
        new.sort()
        for word, table in zip(new, self.learn(new), strict=True):
            keep(word, table)
        return [b"".join([memo.get(word) or here[word] for word in words]) for words in worded]


def counter(model_file: str) -> PrefixCounter:
    if model_file not in _loaded:
        _loaded[model_file] = PrefixCounter(model_file)
    return _loaded[model_file]


def prefix_counts(table: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... characters."""
    if not table:
        return np.zeros(1, np.int64)
    running = np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64)
    running[0] = 0  # the added space alone is no text
    return running


def prefix_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def budget_cuts(counts: np.ndarray, budget: int) -> list[int]:
    """Ends of consecutive pieces, each as long as the stored counts allow: no more than `budget` new tokens a piece."""
    cuts, start = [], 0
    while start < len(counts) - 1:
        fits = np.flatnonzero(counts[start + 1 :] - counts[start] <= budget)
        start += int(fits[-1]) + 1 if len(fits) else 1
        cuts.append(start)
    return cuts


def prefix_tables(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id, n_bytes and `prefix_table` (binary) of every document.

    A null text counts as empty and has an empty table. Repeated rows and null ids give a row each; further columns
    of `docs` are ignored whatever their names. Texts are never cut: memory is a few bytes per character of one text.
    """
    model_file = model_file or public_tokenizers.path(MODEL)

    def tables(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = counter(model_file)
        for pdf in blocks(pdfs, "text", BLOCK_CHARS):
            yield pdf[["doc_id", "n_bytes"]].assign(prefix_table=made.tables(list(pdf["text"])))

    # ids travel as text: pandas would turn long ids beside a null into inexact doubles
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
    made = texts.mapInPandas(tables, "doc_id string, n_bytes long, prefix_table binary")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def budgets(tables: DataFrame, limit: int) -> DataFrame:
    """Answers from stored prefix tables: doc_id, n_bytes, n_tokens, over_limit, and the characters of the longest
    prefix within the limit (`fit_chars`)."""

    def answers(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            totals, fits = [], []
            for stored_table in pdf["prefix_table"]:
                counts = prefix_counts(stored_table)
                totals.append(int(counts[-1]))
                fits.append(len(counts) - 1 if counts[-1] <= limit else prefix_within(counts, limit))
            yield pdf[["doc_id", "n_bytes"]].assign(
                n_tokens=totals, over_limit=[n > limit for n in totals], fit_chars=fits
            )

    fields = "doc_id string, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    answered = tables.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(answers, fields)
    return answered.withColumn("doc_id", F.col("doc_id").cast("long"))

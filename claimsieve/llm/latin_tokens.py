"""Token ids of Latin texts, whole blocks of texts at a time in numpy.

A block of lower-case texts is one array of bytes, a byte per character. Character classes mark where pre-tokens begin
and end; a pre-token of at most 16 characters is known exactly by two 64-bit numbers, its characters themselves. An
open-addressing table holds the ids of each distinct pre-token, so a block is a few passes over arrays and only new
pre-tokens go through the vocabulary's merges. The table is emptied when half full: its size is fixed. Texts with
characters beyond Latin-1, NUL, special strings or immense stretches without a blank go to the encoder of words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import numpy as np

from claimsieve.llm.pattern_packing import SPECIAL, Encoder

SLOTS = 1 << 21
BLOCK = 500_000
LONGEST = SLOTS // 2  # of a piece without blanks, as every character may be a pre-token
KEY_CHARS = 16
BLANK, LETTER, DIGIT, MARK = range(4)
# Fixed values of the vocabulary: white space below U+0100, and what may follow an apostrophe as one pre-token with it.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0"
ENDINGS = "s", "t", "re", "ve", "m", "ll", "d"
# the first three classes of a general category that the vocabulary tells apart
CLASSES = {"L": LETTER, "N": DIGIT}

PADDING = "\x00"  # fills up keys, so texts that hold it have no exact keys
MIXERS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _character_classes() -> np.ndarray:
    kinds = [BLANK if c in BLANKS else CLASSES.get(unicodedata.category(c)[0], MARK) for c in map(chr, range(256))]
    return np.array(kinds, np.uint8)


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: itself where it is printable, else one from U+0100
    on in order of the bytes."""
    letters, spare = [], 256
    for byte in range(256):
        printable = 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174
        letters.append(chr(byte if printable else spare))
        spare += not printable
    return letters


class LatinEncoder(Encoder):
    """Ids as little-endian 32-bit bytes, like `Encoder`."""

    def __init__(self, path: str):
        super().__init__(path)
        self.classes = _character_classes()
        self.letters = _byte_letters()
        self.merges = self.tokenizer.model.tokenize
        # masks[n] keeps the first n bytes of a little-endian word
        self.masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
        self.clear()

    def clear(self) -> None:
        self.low, self.high = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)  # no key is 0: no pre-token is empty
        self.at, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = self.filled = 0

    def merged(self, pre_token: str) -> list[int]:
        """The ids of one pre-token, in lower case already."""
        text = "".join([self.letters[byte] for byte in pre_token.encode()])
        return [piece.id for piece in self.merges(text)]

    def pre_token_spans(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the pre-tokens of characters, of which the first and the last three are blanks."""
        kind = self.classes[text]
        before = np.concatenate(([BLANK], kind[:-1]))
        start = (kind != BLANK) & ((kind != before) | (kind == DIGIT))
        # an apostrophe that begins a run of marks takes an ending with it; letters behind the ending begin anew
        quotes = np.flatnonzero(start & (text == ord("'")))
        for ending in ENDINGS:
            fits = quotes
            for step, letter in enumerate(ending, 1):
                fits = fits[text[fits + step] == ord(letter)]
            start[fits + 1] = False
            behind = fits + 1 + len(ending)
            start[behind[kind[behind] == LETTER]] = True
        following = np.concatenate((kind[1:] == BLANK, [True])) | np.concatenate((start[1:], [True]))
        return np.flatnonzero(start), np.flatnonzero((kind != BLANK) & following) + 1

    def slots_of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The slot of each key: where it is, or the empty one where it would go."""
        mixed = (low * MIXERS[0]) ^ ((high + MIXERS[1]) * MIXERS[1])
        slot = ((mixed ^ (mixed >> np.uint64(29))) * MIXERS[0] >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)
        open_ = np.arange(len(slot))
        while len(open_):
            here = slot[open_]
            other = (self.low[here] != 0) & ((self.low[here] != low[open_]) | (self.high[here] != high[open_]))
            open_ = open_[other]
            slot[open_] = (slot[open_] + 1) % SLOTS
        return slot

    def add(self, low: np.ndarray, high: np.ndarray, names: list[str]) -> None:
        """New keys, each once, with the ids of their pre-tokens."""
        found = [self.merged(name) for name in names]
        counts = np.array([len(ids) for ids in found], np.int64)
        total = int(counts.sum())
        while self.filled + total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.filled : self.filled + total] = [i for ids in found for i in ids]
        at = self.filled + np.cumsum(counts) - counts
        self.filled += total
        self.used += len(names)
        left = np.arange(len(names))
        while len(left):  # of several new keys for a slot the first gets it, the others look again
            slot, first = np.unique(self.slots_of(low[left], high[left]), return_index=True)
            taken = left[first]
            self.low[slot], self.high[slot], self.at[slot], self.count[slot] = low[taken], high[taken], at[taken], counts[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)

    def encode_block(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts of Latin-1 bytes in lower case."""
        joined = b"\n" + b"\n".join(texts) + b"\n" * (KEY_CHARS + 3)
        text = np.frombuffer(joined, np.uint8)
        starts, ends = self.pre_token_spans(text)
        lengths = ends - starts
        words = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))  # eight characters from each place on
        low = words[starts] & self.masks[np.minimum(lengths, 8)]
        high = words[starts + 8] & self.masks[np.clip(lengths - 8, 0, 8)]
        long = np.flatnonzero(lengths > KEY_CHARS)
        if self.used > SLOTS // 2 - BLOCK // 2 or self.used + len(starts) > SLOTS - BLOCK // 2:
            self.clear()
        short = lengths <= KEY_CHARS
        slot = self.slots_of(low, high)
        fresh = np.flatnonzero((self.low[slot] == 0) & short)
        if len(fresh):
            pairs = np.rec.fromarrays([low[fresh], high[fresh]], names="low,high")
            order = np.lexsort((pairs.high, pairs.low))
            ranked = pairs[order]
            new = np.append(True, (ranked.low[1:] != ranked.low[:-1]) | (ranked.high[1:] != ranked.high[:-1]))
            once = fresh[order[new]]
            names = [joined[a:b].decode("latin-1") for a, b in zip(starts[once].tolist(), ends[once].tolist(), strict=True)]
            self.add(low[once], high[once], names)
            slot[fresh] = self.slots_of(low[fresh], high[fresh])
        at, count, ids = self.at[slot], self.count[slot], self.ids
        if len(long):  # longer ones stand behind the table for this block alone
            found = [self.merged(joined[a:b].decode("latin-1")) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
            count[long] = [len(some) for some in found]
            at[long] = self.filled + np.cumsum(count[long]) - count[long]
            ids = np.concatenate((ids[: self.filled], np.array([i for some in found for i in some], np.uint32)))
        upto = np.cumsum(count)
        places = np.repeat(at - (upto - count), count) + np.arange(int(upto[-1]) if len(upto) else 0)
        data = ids[places].astype("<u4").tobytes()
        bounds = np.cumsum([1] + [len(text) + 1 for text in texts])  # where each text begins
        cuts = np.append(0, upto)[np.searchsorted(starts, bounds)] * 4
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        pieces: list[list[bytes]] = []  # of each text: pieces in lower case, or nothing where it is no plain one
        for text in texts:
            try:
                if SPECIAL in text or PADDING in text:
                    raise UnicodeError
                text.encode("latin-1")  # upper case may lie beyond while lower case does not
                pieces.append(cut(text.lower().encode("latin-1")))
            except UnicodeError:
                pieces.append([])
            if any(len(piece) > LONGEST for piece in pieces[-1]):
                pieces[-1] = []
        ids = iter(self.encode_pieces([piece for some in pieces for piece in some]))
        others = iter(super().encode([text for text, some in zip(texts, pieces, strict=True) if not some]))
        return [b"".join([next(ids) for _ in some]) if some else next(others) for some in pieces]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """In blocks of some BLOCK characters, so that a block never fills the table."""
        result, start, size = [], 0, 0
        for end, piece in enumerate(pieces, 1):
            size += len(piece)
            if size >= BLOCK or end == len(pieces):
                result += self.encode_block(pieces[start:end])
                start, size = end, 0
        return result


def cut(text: bytes) -> list[bytes]:
    """A text cut behind blanks, where pre-tokens end, into pieces of some BLOCK characters; a short one is one piece."""
    pieces, start = [], 0
    while len(text) - start > BLOCK and (blank := text.find(b" ", start + BLOCK)) >= 0:
        pieces.append(text[start:blank])
        start = blank
    return [*pieces, text[start:]]

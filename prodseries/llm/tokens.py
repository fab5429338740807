"""Token ids by the tokenizers library, with a bounded memo of the pieces it has seen.

The tokenizer works on each pre-token alone, so a piece gets the same ids wherever it stands.
Texts are cut into pieces with numpy, pieces are looked up by two 64-bit hashes, and only new
ones go to the library. Pieces are runs of ASCII and Latin-1 letters (lower-cased, as the
tokenizer does), single digits and runs of ASCII punctuation. A stretch between ASCII white
space that holds anything else (other scripts, combining marks, apostrophes, the strings of
special tokens) is one piece, which the library cuts itself.
"""

from __future__ import annotations

import os

import numpy as np

from prodseries.llm.hashing import OTHER_BASE, SPACE, in_slices, joined, spans_hash, word_spans

SPACE_CLASS, LETTER, DIGIT, PUNCTUATION, OPAQUE = 0, 1, 2, 3, 4
# Slots of the lookup table, and pieces and ids held before the memo starts afresh (about 50 MB).
TABLE_BITS = 21
MOST_PIECES = 1_200_000
MOST_IDS = 8_000_000
# Bytes of text that are worked on at a time: the working arrays are many times as large.
SLICE_BYTES = 1 << 17

_CLASS = np.full(256, PUNCTUATION, dtype=np.uint8)
_CLASS[128:] = OPAQUE
_CLASS[SPACE] = SPACE_CLASS
_CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[ord("'")] = OPAQUE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The process's encoder of a tokenizer file: later tasks of a worker find it filled."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def released() -> None:
    """Drops the process's encoders: a worker that has done its tokenizing needs the memory for
    other work, and a later task makes them anew."""
    _ENCODERS.clear()


def pieces(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and classes of the pieces of a buffer of UTF-8, and the folded buffer."""
    kind, low = _CLASS[buf], _LOWER[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    second = buf[lead + 1]
    letter = (second != 0x97) & (second != 0xB7)
    lead, second = lead[letter], second[letter]
    kind[lead] = kind[lead + 1] = LETTER
    upper = lead[second <= 0x9E] + 1
    low[upper] += 32
    kind[np.flatnonzero((buf[:-1] == ord("<")) & (buf[1:] == ord("|")))] = OPAQUE
    opaque = np.flatnonzero(kind == OPAQUE)
    if len(opaque):
        starts, ends = word_spans(buf)
        held = np.unique(np.searchsorted(starts, opaque, side="right") - 1)
        inside = np.zeros(len(buf) + 1, dtype=np.int8)
        inside[starts[held]] += 1
        inside[ends[held]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        kind[inside] = OPAQUE
        low[inside] = buf[inside]
    turn = np.empty(len(buf) + 1, dtype=bool)
    turn[0] = turn[-1] = True
    turn[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    at = np.flatnonzero(turn)
    starts, ends = at[:-1], at[1:]
    solid = kind[starts] != SPACE_CLASS
    starts, ends = starts[solid], ends[solid]
    return starts, ends, kind[starts], low


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.ends_word[i] = token.endswith("</w>")
        self.by_word = self.ends_word.any()
        self.forget()

    def forget(self) -> None:
        # Numbers of pieces (-1 is an empty slot); by number, a piece's two hashes and where its
        # ids start in the pool. They end where the next piece's start.
        self.slots = np.full(1 << TABLE_BITS, -1, dtype=np.int32)
        self.hashes = np.zeros((1 << 14, 2), dtype=np.uint64)
        self.start = np.zeros(1 << 14, dtype=np.uint32)
        self.pool = np.zeros(1 << 16, dtype=np.uint16 if len(self.ends_word) <= 1 << 16 else np.uint32)
        self.count = self.used = 0

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (null: none), and how many each has."""
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        if not self.by_word:
            rows = self.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            lengths = np.array([len(r.ids) for r in rows], dtype=np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *(np.array(r.ids, np.uint32) for r in rows)]), lengths
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a, b in in_slices(raw, len, SLICE_BYTES):
            found = self._slice(raw[a:b])
            ids.append(found[0])
            counts.append(found[1])
        return np.concatenate(ids), np.concatenate(counts)

    def _slice(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        buf, at = joined(raw)
        starts, ends, kinds, low = pieces(buf)
        h, g = spans_hash(low, starts, ends), spans_hash(low, starts, ends, OTHER_BASE)
        value = self._known(h, g)
        new = np.flatnonzero(value < 0)
        if len(new):
            if self.count + len(new) > MOST_PIECES or self.used > MOST_IDS:
                self.forget()
                value[:] = -1
                new = np.arange(len(h))
            _, first, back = np.unique(h[new] ^ (g[new] >> np.uint64(1)), return_index=True, return_inverse=True)
            value[new] = self._learn(low, starts, ends, kinds, h, g, new[first])[back]
        lengths = (self.start[value + 1] - self.start[value]).astype(np.int64)
        done = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        ids = self.pool[np.repeat(self.start[value] - done[:-1], lengths) + np.arange(done[-1])].astype(np.uint32)
        return ids, np.diff(done[np.searchsorted(starts, at)])

    def _known(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Numbers of the pieces that are in one of their two slots, else -1."""
        shift = np.uint64(64 - TABLE_BITS)
        value = self._in_slot(h >> shift, h, g)
        rest = np.flatnonzero(value < 0)
        value[rest] = self._in_slot(g[rest] >> shift, h[rest], g[rest])
        return value

    def _in_slot(self, slot: np.ndarray, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        value = self.slots[slot.astype(np.int64)]
        own = self.hashes[value]
        return np.where((value >= 0) & (own[:, 0] == h) & (own[:, 1] == g), value, np.int32(-1))

    def _learn(self, low, starts, ends, kinds, h, g, new) -> np.ndarray:
        """Ask the library for new pieces; their numbers in the memo."""
        data = low.tobytes()
        said = [data[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
        opaque = kinds[new] == OPAQUE
        rows: list[np.ndarray | None] = [None] * len(said)
        plain = np.flatnonzero(~opaque).tolist()
        for i in range(0, len(plain), 512):
            part = plain[i : i + 512]
            ids = np.array(self.library.encode_batch_fast([" ".join(said[j] for j in part)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) != len(part):
                opaque[part] = True
                continue
            for j, a, b in zip(part, [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                rows[j] = ids[a:b]
        whole = np.flatnonzero(opaque).tolist()
        for j, row in zip(whole, self.library.encode_batch_fast([said[j] for j in whole], add_special_tokens=False), strict=True):
            rows[j] = np.array(row.ids, dtype=np.uint32)

        lengths = np.array([len(r) for r in rows], dtype=np.int32)
        ids = np.concatenate(rows)
        numbers = np.arange(self.count, self.count + len(new), dtype=np.int32)
        self.hashes, self.start = _grown(self.hashes, numbers[-1] + 1, MOST_PIECES), _grown(self.start, numbers[-1] + 2, MOST_PIECES + 1)
        self.pool = _grown(self.pool, self.used + len(ids), MOST_IDS)
        self.pool[self.used : self.used + len(ids)] = ids
        self.start[numbers + 1] = self.used + np.cumsum(lengths, dtype=np.int64)
        self.hashes[numbers, 0], self.hashes[numbers, 1] = h[new], g[new]
        self.count, self.used = self.count + len(new), self.used + len(ids)
        # An empty slot of the two if there is one; else the first is taken over.
        shift = np.uint64(64 - TABLE_BITS)
        one, two = (h[new] >> shift).astype(np.int64), (g[new] >> shift).astype(np.int64)
        self.slots[np.where((self.slots[one] >= 0) & (self.slots[two] < 0), two, one)] = numbers
        return numbers


def _grown(values: np.ndarray, size: int, most: int) -> np.ndarray:
    """Room for ``size`` rows: twice as much as before, but no more than ``most`` unless needed."""
    if size <= len(values):
        return values
    out = np.zeros((max(size, min(2 * len(values), most)), *values.shape[1:]), dtype=values.dtype)
    out[: len(values)] = values
    return out

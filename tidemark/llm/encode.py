"""Token ids of whole text columns with the ``tokenizers`` library.

Texts of a word tokenizer (white space dropped, runs of letters, single
numbers, runs of other signs) repeat few distinct pieces many times, so
each distinct piece is encoded once per worker and looked up after that.
Pieces are cut only where the tokenizer itself always cuts: at blanks
and between a plain letter or digit and an ASCII sign.  Any other
tokenizer file encodes row by row.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import textops as T
from .common import single_thread

# Fixed value: the pre-tokenizer pattern for which cutting in pieces is exact.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = True
_SIGN = ~_ALNUM
_SIGN[0x80:] = False
_SIGN[[0x20, *range(0x09, 0x0E)]] = False
_LATIN1_LETTER = np.zeros(256, bool)  # second byte of U+00C0..U+00FF without the two signs
_LATIN1_LETTER[0x80:0xC0] = True
_LATIN1_LETTER[[0x97, 0xB7]] = False

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0xC3] = True  # first byte of the Latin-1 letters
_JOINED = 200  # pieces that are encoded as one text

_OPEN: dict = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str, noted=None, name=None) -> "Encoder":
    """The worker's encoder for ``path`` (kept between tasks of one worker); ``name`` tells what is ``noted``."""
    if (path, name) not in _OPEN:
        _OPEN[path, name] = Encoder(path, noted=noted)
    return _OPEN[path, name]


class _Numbers:
    """Running numbers of 64-bit keys: an open hash table in two arrays, at most half full."""

    def __init__(self, bits: int = 16):
        self.n = 0
        self._empty(bits)

    def _empty(self, bits: int) -> None:
        self.bits, self.keys, self.number = bits, np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key (none is zero), -1 for an unknown one."""
        slot = self._home(keys)
        held = self.keys[slot]
        number = np.where(held == keys, self.number[slot], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.keys) - 1)
            held = self.keys[slot]
            hit = held == keys[left]
            number[left[hit]] = self.number[slot[hit]]
            on = ~hit & (held != 0)
            left, slot = left[on], slot[on]
        return number

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of distinct keys that are not in the table yet."""
        number = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        self.n += len(keys)
        if 2 * self.n > len(self.keys):
            some = np.flatnonzero(self.keys)
            old = self.keys[some], self.number[some]
            self._empty((2 * self.n - 1).bit_length())
            self._put(*old)
        self._put(keys, number)
        return number

    def _put(self, keys: np.ndarray, number: np.ndarray) -> None:
        slot = self._home(keys)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]  # of several keys one stays
            here = self.keys[slot] == keys
            self.number[slot[here]] = number[here]
            keys, number, slot = keys[~here], number[~here], (slot[~here] + 1) & (len(self.keys) - 1)


class _Lists:
    """Lists of numbers one after another; the arrays grow by doubling."""

    def __init__(self, dtype):
        self.data, self.end, self.n = np.zeros(1 << 16, dtype), np.zeros(1 << 16, np.int64), 0

    def add(self, values: np.ndarray, size: np.ndarray) -> None:
        first = int(self.end[self.n])
        for name, have, more in (("data", first, values), ("end", self.n + 1, first + np.cumsum(size))):
            kept = getattr(self, name)
            if have + len(more) > len(kept):
                kept = np.concatenate([kept, np.zeros(max(len(kept), len(more)), kept.dtype)])
                setattr(self, name, kept)
            kept[have:have + len(more)] = more
        self.n += len(size)

    def spread(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the lists ``number``, one after another, and the offsets of each."""
        first = self.end[number]
        size = self.end[number + 1] - first
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        if size.max(initial=0) <= 1:
            return self.data[first[size > 0]], total
        first -= total[:-1]
        out, step = np.empty(total[-1], self.data.dtype), 1 << 15
        for i in range(0, len(size), step):  # so that the places stay in a core's cache
            a, b = total[i], total[min(i + step, len(size))]
            at = np.repeat(first[i:i + step], size[i:i + step])
            at += np.arange(a, b)
            np.take(self.data, at, out=out[a:b], mode="clip")
        return out, total


class Encoder:
    """``rows(column)`` gives all ids of a string column and the row offsets.

    ``noted(bytes, starts, ends)`` may give more numbers (32 bits) of every
    piece, and how many there are: ``noted_rows`` has them too.  A piece's
    ASCII letters count as lower-case there.
    """

    def __init__(self, path: str, most_pieces: int = 1_500_000, noted=None):
        single_thread()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        norms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.piecewise = (bool(steps) and steps[0].get("pattern", {}).get("Regex") == WORD_PATTERN
                          and norms == ["NFC", "Replace", "Lowercase"])
        # Words of a-z alone: no normalizer and no pattern changes them, so the same model gets them by their blanks.
        self.plain = None
        if self.piecewise and [(s.get("type"), s.get("add_prefix_space")) for s in steps[1:]] == [("ByteLevel", False)]:
            self.plain = Tokenizer(self.tok.model)
            self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.added = [a["content"] for a in spec.get("added_tokens", [])]
        # Ids that end a word: a word of letters has one, its last.
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.noted = noted
        self.most_pieces = most_pieces  # memory bound of the lookup table; past it the table starts anew
        self._reset()

    def _reset(self):
        self.numbers, self.ids, self.notes = _Numbers(), _Lists(self.dtype), _Lists(np.uint32)

    def _encode(self, texts: list[str], tok=None) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in (tok or self.tok).encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), self.dtype, int(n.sum())), n

    def _encode_words(self, words: list[str], tok=None) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encode`` for words of letters only, many to a text."""
        ids, _ = self._encode([" ".join(words[i:i + _JOINED]) for i in range(0, len(words), _JOINED)], tok)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words):  # another kind of vocabulary
            return self._encode(words)
        return ids, np.diff(last, prepend=-1)

    def rows(self, col) -> tuple[np.ndarray, np.ndarray]:
        return self.noted_rows(col)[:2]

    def noted_rows(self, col) -> tuple:
        """Ids and row offsets, and those of the noted numbers: None for a column that is not taken in pieces."""
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
        if not self.piecewise:
            ids, n = self._encode(pc.fill_null(col, "").to_pylist())
            return ids, np.concatenate([[0], np.cumsum(n)]), None
        special, raw = np.zeros(len(col), bool), T.utf8(col)[0].tobytes()
        for token in self.added:  # texts that spell an added token out: whole, by the library
            if token.encode() in raw:
                special |= pc.fill_null(pc.match_substring(col, token), False).to_numpy(zero_copy_only=False)
        if not special.any():
            return self._pieces(col)
        ids, off, _ = self._pieces(pc.if_else(pa.array(special), "", col))
        own, n_own = self._encode(col.filter(pa.array(special)).to_pylist())
        parts, at, k = [], 0, 0
        for i, s in enumerate(special):
            parts.append(own[at:at + n_own[k]] if s else ids[off[i]:off[i + 1]])
            if s:
                at, k = at + n_own[k], k + 1
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]), None

    def _pieces(self, col) -> tuple:
        data, off = T.utf8(col)
        if not len(data):
            none = np.zeros(len(off), np.int64)
            return np.zeros(0, self.dtype), none, (np.zeros(0, np.uint32), none)
        left = T.mapped(data, _ALNUM)
        latin1 = np.flatnonzero(data[:-1] == 0xC3) + 1
        if len(latin1):
            left = left.copy()
            left[latin1] |= _LATIN1_LETTER[data[latin1]]
        cut = np.zeros(len(data), bool)
        np.logical_and(left[:-1], T.mapped(data, _SIGN)[1:], out=cut[1:])
        starts, ends, words = T.word_bounds(data, off, T.BLANK_SPLIT, cut)
        # ASCII letters are lowered first where that cannot touch composition (U+0000..U+00FF only).
        low, wide = T.mapped(data, T.LOWER), np.flatnonzero(data >= 0xC4)
        if len(wide):
            p = np.unique(np.searchsorted(starts, wide, side="right") - 1)
            step = np.zeros(len(data) + 1, np.int8)
            step[starts[p]] += 1
            step[ends[p]] -= 1
            low = np.where(np.cumsum(step[:-1], dtype=np.int8) > 0, data, low)
        number = self._lookup(T.span_hashes(low, starts, ends), low, starts, ends)
        ids, total = self.ids.spread(number)
        if not self.noted:
            return ids, total[words], None
        notes, n_notes = self.notes.spread(number)
        return ids, total[words], (notes, n_notes[words])

    def _lookup(self, keys, data, starts, ends) -> np.ndarray:
        """Number of each piece in ``self.ids``; new pieces are encoded and added."""
        if self.numbers.n > self.most_pieces:
            self._reset()
        keys = np.maximum(keys, np.uint64(1))
        number = self.numbers.find(keys)
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            new, first, inv = np.unique(keys[unknown], return_index=True, return_inverse=True)
            first = unknown[first]
            first, size = starts[first], ends[first] - starts[first]
            last = np.cumsum(size)
            own = data[np.repeat(first - (last - size), size) + np.arange(last[-1])]  # bytes of the new pieces
            plain = _LETTER[own]
            latin1 = np.flatnonzero(own[:-1] == 0xC3) + 1
            plain[latin1] |= _LATIN1_LETTER[own[latin1]]

            def only(of):
                return np.logical_and.reduceat(of, last - size)

            letters = only(plain)
            ascii_letters = letters & only(own < 0x80) if self.plain else np.zeros(len(new), bool)
            kinds = ascii_letters, letters & ~ascii_letters, ~letters
            order = np.concatenate([np.flatnonzero(k) for k in kinds])
            raw, n_ascii, n_words = own.tobytes(), int(ascii_letters.sum()), int(letters.sum())
            text = [raw[s:e].decode() for s, e in zip((last - size)[order].tolist(), last[order].tolist())]
            parts = self._encode_words(text[:n_ascii], self.plain), self._encode_words(text[n_ascii:n_words]), self._encode(text[n_words:])
            self.ids.add(*map(np.concatenate, zip(*parts)))
            place = np.empty(len(new), np.int32)
            place[order] = self.numbers.add(new[order])
            if self.noted:
                notes, n = self.noted(own, last - size, last)
                at = np.cumsum(n) - n
                size = n[order]
                self.notes.add(notes[np.repeat(at[order] - (np.cumsum(size) - size), size) + np.arange(len(notes))], size)
            number[unknown] = place[inv]
        return number

"""BPE encoding and decoding with a pair occurrence index.

Texts are normalised and cut to words by the tokenizer file's own rules;
each distinct word of a slice that the worker has not met yet is merged
here, all of them at once:

1. Symbols of all words lie in one array with links to their neighbours.
   The index maps each pair that has a merge rule to all its positions.
2. A heap holds the ranks of the pairs present.  The least rank is applied
   at all its positions, leftmost first where they overlap; the pairs that
   its merges make are added to their own lists, and so are ranks that come
   up again.  A position whose pair has gone meanwhile is passed over.
3. A rule whose token belongs to an earlier rule could wake that rule
   amid its own positions, so it is applied once per word and turn.

So every word sees its own rules in ascending order, as when merged alone,
and a very long word costs a few array operations per rule.

Decoding takes the token strings of the ids and joins them by the file's
decoder (a blank where it names none); unknown ids are passed over.

Defined results: a null or empty text has no ids and decodes to the empty
text; repeated rows and rows without doc_id are encoded each; no rows give
no rows; extra columns are ignored.  Tokenizer files with an unknown
token, byte fallback, dropout or a subword prefix are refused.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import documents_of
from .encode import Encoder, default_path

_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_TEXT = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])
_OPEN: dict = {}


def codec(path: str) -> "PairIndexCodec":
    """The worker's codec for ``path`` (kept between tasks of one worker)."""
    if path not in _OPEN:
        _OPEN[path] = PairIndexCodec(path)
    return _OPEN[path]


class Merges:
    """Merge rules of a vocabulary, applied to many words at once."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ", 1)) for m in merges]
        self.vocab, self.suffix = vocab, suffix
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = (self.left << 32) | self.right
        order = np.argsort(key, kind="stable")
        last = np.append(key[order][1:] != key[order][:-1], True)  # of a rule given twice the later holds
        self.key, self.rank = key[order][last], order[last]
        first_use = np.full(max(vocab.values()) + 1, len(pairs), np.int64)
        for part in (self.left, self.right):
            np.minimum.at(first_use, part, np.arange(len(pairs)))
        self.once = first_use[self.made] < np.arange(len(pairs))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where no rule has it."""
        if not len(self.key):
            return np.full(len(a), -1, np.int64)
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], -1)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the single characters of all words, and each symbol's word; unknown characters are left out."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        some, inverse = np.unique(code, return_inverse=True)
        inner = np.array([self.vocab.get(chr(c), -1) for c in some.tolist()], np.int64)
        final = np.array([self.vocab.get(chr(c) + self.suffix, -1) for c in some.tolist()], np.int64)
        word = np.repeat(np.arange(len(words)), size)
        ends = np.cumsum(size)[size > 0] - 1
        sym = inner[inverse] if len(some) else np.zeros(0, np.int64)
        sym[ends] = final[inverse[ends]]
        known = sym >= 0
        return sym[known], word[known]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each word has."""
        sym, word = self.symbols(words)
        n = len(sym)
        place = np.arange(n)
        inner = np.zeros(n, bool)  # has a right neighbour
        inner[:-1] = word[1:] == word[:-1]
        right = np.where(inner, place + 1, -1)
        left = np.full(n, -1, np.int64)
        left[1:][inner[:-1]] = place[:-1][inner[:-1]]
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self._ranks(sym[at], sym[right[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            by = np.argsort(rank, kind="stable")
            at, rank = at[by], rank[by]
            cuts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
            for r, own in zip(rank[cuts].tolist(), np.split(at, cuts[1:])):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(own)

        add(place[inner])
        while heap:
            r = heapq.heappop(heap)
            own = index.pop(r)
            at = own[0] if len(own) == 1 else np.unique(np.concatenate(own))
            at = at[alive[at]]
            after = right[at]
            ok = (after >= 0) & (sym[at] == self.left[r])
            ok[ok] = sym[after[ok]] == self.right[r]
            at, after = at[ok], after[ok]
            if self.once[r] and len(at) > 1:
                first = np.append(True, word[at][1:] != word[at][:-1])
                if not first.all():
                    index[r] = [at[~first]]
                    heapq.heappush(heap, r)
                    at, after = at[first], after[first]
            elif self.left[r] == self.right[r] and len(at) > 1:  # of overlapping places every other one
                chain = np.append(False, after[:-1] == at[1:])
                nth = np.arange(len(at))
                even = (nth - np.maximum.accumulate(np.where(chain, 0, nth))) % 2 == 0
                at, after = at[even], after[even]
            if not len(at):
                continue
            beyond = right[after]
            sym[at], right[at], alive[after] = self.made[r], beyond, False
            some = beyond >= 0
            left[beyond[some]] = at[some]
            before = left[at]
            add(np.unique(np.concatenate([before[before >= 0], at[right[at] >= 0]])))
        return sym[alive], np.bincount(word[alive], minlength=len(words))


class PairIndexCodec(Encoder):
    """``rows`` as in ``Encoder``, with the merges done here; ``texts`` decodes."""

    def __init__(self, path: str, most_pieces: int = 1_500_000):
        super().__init__(path, most_pieces)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        refused = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        refused += [f"added token {a['content']!r}" for a in spec.get("added_tokens", []) if a["single_word"] or a["lstrip"] or a["rstrip"]]
        if model.get("type") != "BPE" or refused:
            raise ValueError(f"not a plain BPE file: {refused or model.get('type')}")
        self.path = path
        added = sorted(((a["content"], a["id"], a["normalized"]) for a in spec.get("added_tokens", [])), key=lambda a: -len(a[0]))
        self.added_id = {text: i for text, i, _ in added}
        self.raw, self.normal = (self._either([t for t, _, norm in added if norm is kind]) for kind in (False, True))
        size = self.tok.get_vocab_size()
        strings = [self.tok.id_to_token(i) for i in range(size)]
        self.strings = pa.array([s or "" for s in strings])
        self.known = np.array([s is not None for s in strings])

    @cached_property
    def merges(self) -> Merges:
        """The merge rules; a worker that only decodes doesn't hold them."""
        with open(self.path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        return Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")

    @staticmethod
    def _either(texts: list[str]):
        return re.compile("(" + "|".join(map(re.escape, texts)) + ")") if texts else None

    def _parts(self, text: str, tok):
        """Words of a text in their vocabulary's spelling (as ``tok`` cuts it), and added tokens as ids."""
        for i, raw in enumerate(self.raw.split(text) if self.raw else [text]):
            if i % 2:
                yield self.added_id[raw]
                continue
            plain = tok.normalizer.normalize_str(raw) if tok.normalizer else raw
            for k, part in enumerate(self.normal.split(plain) if self.normal else [plain]):
                if k % 2:
                    yield self.added_id[part]
                elif part and tok.pre_tokenizer:
                    yield from (w for w, _ in tok.pre_tokenizer.pre_tokenize_str(part))
                elif part:
                    yield part

    def _encode(self, texts: list[str], tok=None) -> tuple[np.ndarray, np.ndarray]:
        words: dict[str, int] = {}
        parts = [[words.setdefault(p, len(words)) if isinstance(p, str) else -1 - p for p in self._parts(t, tok or self.tok)] for t in texts]
        ids, size = self.merges.merged(list(words))
        n_words = np.fromiter(map(len, parts), np.int64, len(parts))
        seq = np.fromiter((p for x in parts for p in x), np.int64, int(n_words.sum()))
        # Added tokens follow the words' ids, one entry each.
        tokens = np.flatnonzero(seq < 0)
        start = np.concatenate([np.cumsum(size) - size, len(ids) + np.arange(len(tokens))])
        ids = np.concatenate([ids, -1 - seq[tokens]])
        size = np.concatenate([size, np.ones(len(tokens), np.int64)])
        seq[tokens] = len(words) + np.arange(len(tokens))
        n = size[seq]
        total = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.repeat(start[seq] - total[:-1], n) + np.arange(total[-1])]
        ends = total[np.concatenate([[0], np.cumsum(n_words)])]
        return out.astype(self.dtype), np.diff(ends)

    def texts(self, col) -> pa.Array:
        """Texts of a column of ids (u32, little endian)."""
        data, off = T.utf8(pc.fill_null(col, b"") if col.null_count else col)
        ids, off = np.frombuffer(data.tobytes(), "<u4"), off // 4
        known = ids < len(self.known)
        known[known] = self.known[ids[known]]
        if not known.all():
            off = np.concatenate([[0], np.cumsum(known)])[off]
            ids = ids[known]
        strings = pa.ListArray.from_arrays(pa.array(off, pa.int32()), self.strings.take(pa.array(ids)))
        if self.tok.decoder is None:
            return pc.binary_join(strings, " ")
        return pa.array([self.tok.decoder.decode(x) for x in strings.to_pylist()], pa.string())


def encode(docs: DataFrame, tokenizer: str | None = None, slice_bytes: int = 2 << 20) -> DataFrame:
    """doc_id and ids (u32, little endian) of every row."""
    tokenizer = tokenizer or default_path()

    def run(batches):
        code = codec(tokenizer)
        for batch in batches:
            for part in T.slices(batch, "text", slice_bytes):
                ids, off = code.rows(part.column(1))
                body = pa.py_buffer(np.ascontiguousarray(ids.astype("<u4")).view(np.uint8))
                own = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((4 * off).astype(np.int32)), body])
                yield pa.RecordBatch.from_arrays([part.column(0), own], schema=_IDS)

    return documents_of(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(rows: DataFrame, tokenizer: str | None = None, slice_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, ids and text of every row of ``encode``'s result."""
    tokenizer = tokenizer or default_path()

    def run(batches):
        code = codec(tokenizer)
        for batch in batches:
            for part in T.slices(batch, "ids", slice_bytes):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), code.texts(part.column(1))], schema=_TEXT)

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op13``."""
    ids = F.coalesce("ids", F.lit(b""))
    return result.select("doc_id", (F.length(ids) / 4).cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                         F.sha2("text", 256).alias("decoded_sha256"))

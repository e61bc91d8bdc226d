"""Lexical retrieval packing: neighbours of a seed document fill its window.

1. Every text is encoded once and stored with its distinct terms (hashed
   words, ascending, by their steps) and their frequencies.
2. Document frequencies and the mean length in words are counted over all
   rows; the table has ``2 ** bits`` entries whatever the input.
3. An inverted index of all rows is written in files of a bounded size,
   with every posting's BM25 weight and every term's greatest one.
4. Rounds: so many unused documents become seeds as there are windows to
   fill.  Every block of seeds asks every index file with each seed's
   ``query_terms`` weightiest terms, and the answers are merged per seed,
   so that any unused document of the table is a candidate.  A file whose
   greatest weights can't reach a seed's present list is passed over; the
   others are scored for many seeds at once.  Once a seed's list is full,
   terms too common to lift a document to it by themselves are added last,
   for the documents they can lift; the postings of its other terms are
   added up in few places first, and exactly for what comes far enough.
   A document goes to the seed that scores it highest, and seeds with room
   left go on in the next round, without what is used by then.  Their lists
   are ``spare`` times as long as their room, and only a seed whose list no
   longer fills its room asks again.  Used documents are bits in files, a
   file per 65,536 rows, which the tasks read.
5. After a round, when what is left fits in one shard, one task finishes
   it: the best unused neighbours follow a seed until its window is full,
   and the document that crosses the window's end seeds the next one.

BM25 scores count in steps of a sixteenth of an octave, and within a step
the order differs from seed to seed; otherwise all seeds amid near copies
would want the same few.  A seed's documents make whole windows; what
goes beyond, or doesn't fill one, follows in the order of the seeds.  The
last window of a task's lot is cut into powers of two, which need no
padding, so that nothing is padded.  A repeated task gives the same
sequences.

Defined results: a null or empty text is the end id alone; rows are
packed each, also repeated ones or such without doc_id; no rows give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import arrays_of, documents_of, scratch_path, stored
from .encode import default_path, encoder
from .token_store import put

K1, B = 1.2, 0.75
_STORED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("terms", pa.binary()), ("tf", pa.binary()), ("words", pa.int64())])
_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
_OUT = pa.schema([*((c, pa.int64()) for c in _COLUMNS), ("ids", pa.binary())])
OUT = ", ".join(f"{c} long" for c in _COLUMNS) + ", ids binary"


def _words(data: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words between the offsets ``off``, in their order, and the offsets in them."""
    data = T.mapped(data, T.LOWER)
    starts, ends, words = T.word_bounds(data, off, T.ALNUM_SPLIT)
    return (T.span_hashes(data, starts, ends) >> np.uint64(64 - bits)).astype(np.uint32), words


def _words_of_pieces(bits: int):
    """What the encoder notes of a piece: its words.  Its pieces are never cut inside a word."""
    def of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        term, at = _words(data, np.append(starts, ends[-1:]), bits)
        return term, np.diff(at)

    return of


def _terms(term: np.ndarray, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of every row (ascending, each but the first as its step from the one before), their frequencies, and the rows' offsets."""
    n = len(words) - 1
    key = np.repeat(np.arange(n) << bits, np.diff(words)) | term
    key = np.sort(key.astype(np.uint32) if n << bits <= 1 << 32 else key)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at].astype(np.int64)
    rows, terms = np.searchsorted(key, np.arange(n + 1) << bits), (key & ((1 << bits) - 1)).astype(np.uint32)
    step, first = np.diff(terms, prepend=np.uint32(0)), rows[:-1][rows[:-1] < rows[1:]]
    step[first] = terms[first]
    return step, np.diff(np.append(at, len(new))).astype(np.uint32), rows


def _numbers(col) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit numbers of a binary column, and the rows' offsets in them."""
    data, off = T.utf8(col)
    return np.frombuffer(data, np.uint32), off // 4


def _term_ids(col) -> tuple[np.ndarray, np.ndarray]:
    """Terms of all rows from their steps, and the rows' offsets."""
    step, at = _numbers(col)
    total = np.cumsum(step, dtype=np.uint32)  # wraps around, as does the difference
    first = at[:-1][at[:-1] < at[1:]]
    return total - np.repeat(total[first] - step[first], np.diff(np.append(first, len(step)))), at


def encoded(docs: DataFrame, tokenizer: str, end_id: int, bits: int) -> DataFrame:
    """doc_id, ids, terms, tf and number of words of every row."""
    def run(batches):
        enc = encoder(tokenizer, _words_of_pieces(bits), ("words", bits))
        for batch in batches:
            for part in T.slices(batch, "text"):
                ids, off, noted = enc.noted_rows(part.column(1))
                end = np.array([end_id], enc.dtype).tobytes()
                terms, tf, at = _terms(*(noted or _words(*T.utf8(part.column(1)), bits)), bits)
                raw = (ids.tobytes(), terms.tobytes(), tf.tobytes())
                size = ids.itemsize
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([raw[0][a * size:b * size] + end for a, b in zip(off[:-1], off[1:])], pa.binary()),
                     *(pa.array([r[4 * a:4 * b] for a, b in zip(at[:-1], at[1:])], pa.binary()) for r in raw[1:]),
                     pa.array(np.add.reduceat(np.append(tf, 0), at[:-1]) * (at[1:] > at[:-1]), pa.int64())],
                    schema=_STORED)

    return documents_of(docs).mapInArrow(run, "doc_id long, ids binary, terms binary, tf binary, words long")


def document_frequencies(rows: DataFrame, bits: int) -> np.ndarray:
    """Number of documents with each of the ``2 ** bits`` terms, over all rows."""
    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in T.slices(batch, "terms"):
                total += np.bincount(_term_ids(part.column(0))[0], minlength=1 << bits)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    # A task gives up to 2 ** bits rows, whatever it reads: few tasks, but no more than eight files to each.
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-len(rows.inputFiles()) // 8))
    got = rows.select("terms").coalesce(tasks).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << bits, np.int64)
    out[got.column("term").to_numpy()] = got.column("n").to_numpy()
    return out


def order_of(size: np.ndarray, terms: np.ndarray, weight: np.ndarray, at: np.ndarray, idf: np.ndarray,
             window: int, query_terms: int) -> list[int]:
    """Order in which a shard's documents follow one another.

    ``terms`` and BM25 ``weight`` of document i lie at ``at[i]`` to ``at[i + 1]``.
    """
    n = len(size)
    doc = np.repeat(np.arange(n), np.diff(at))
    by_term = np.argsort(terms, kind="stable")
    posting_doc, posting_weight = doc[by_term], weight[by_term]
    names, first = np.unique(terms[by_term], return_index=True)
    first = np.append(first, len(terms))
    place = np.searchsorted(names, terms)
    unused, order, filled, next_row = np.ones(n, bool), [], 0, 0

    def neighbours(i):
        own = slice(at[i], at[i + 1])
        ask = place[own]
        if len(ask) > query_terms:
            ask = ask[np.argpartition(-weight[own], query_terms)[:query_terms]]
        if not len(ask):
            return iter(())
        spans = [slice(first[t], first[t + 1]) for t in ask]
        score = np.bincount(np.concatenate([posting_doc[s] for s in spans]),
                            np.concatenate([posting_weight[s] for s in spans]), minlength=n)
        score[~unused] = 0
        found = np.flatnonzero(score)
        return iter(found[np.argsort(-score[found], kind="stable")].tolist())

    ranked = iter(())
    while len(order) < n:
        i = next((j for j in ranked if unused[j]), None)
        fresh = i is None
        if fresh:
            while not unused[next_row]:
                next_row += 1
            i = next_row
        unused[i] = False
        order.append(i)
        filled += int(size[i])
        if fresh or filled >= window:  # a new seed, or the document that the window's end cuts
            ranked = neighbours(i)
        filled %= window
    return order


def cuts_of(total: int, window: int) -> np.ndarray:
    """Ends of the sequences over ``total`` ids: whole windows, then powers of two."""
    whole, rest = divmod(total, window)
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.cumsum([window] * whole + tail)


def pieces_of(size: np.ndarray, order: list[int], window: int) -> tuple[np.ndarray, ...]:
    """(document, start, length, sequence, offset) of every piece of the documents laid out in ``order``."""
    order = np.array(order, np.int64)
    ends = np.cumsum(size[order])
    cuts = cuts_of(int(ends[-1]), window)
    stops = np.union1d(ends, cuts)
    starts = np.concatenate([[0], stops[:-1]])
    nth, seq = np.searchsorted(ends, starts, side="right"), np.searchsorted(cuts, starts, side="right")
    return (order[nth], starts - (ends - size[order])[nth], stops - starts, seq,
            starts - np.concatenate([[0], cuts[:-1]])[seq])


_HEADS = "row long, size long, query binary, file string"
_SEEDS = "seed long, room long, query binary, whole boolean, list array<struct<row: long, size: long, score: double>>"
_NONE = np.uint32(0xFFFFFFFF)


def _norms(words: np.ndarray, mean: float) -> np.ndarray:
    """BM25 length norm of every row, by its number of words."""
    return (K1 * (1 - B + B * words / mean)).astype(np.float32)


def _weights(idf: np.ndarray, tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.float32)
    return idf * tf * np.float32(K1 + 1) / (tf + norm)


def _columns(part: pa.Table, idf: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and BM25 weights of the rows, and each row's number of distinct terms."""
    terms, at = _term_ids(part.column("terms"))
    tf, n_terms = _numbers(part.column("tf"))[0], np.diff(at)
    return terms, _weights(idf[terms], tf, np.repeat(_norms(part.column("words").to_numpy(), mean), n_terms)), n_terms


def indexed(spark: SparkSession, rows: DataFrame, n_terms: int, shared, mean: float, bits: int, query_terms: int,
            index_rows: int, index_terms: int) -> DataFrame:
    """Write the inverted index; row, size, query (weightiest terms) and index file of every row that has terms."""
    base = scratch_path(spark, "llm-bm25")

    def one(part: pa.Table, path: str) -> pa.RecordBatch:
        terms, weight, n_terms = _columns(part, shared.value, mean)
        at = np.concatenate([[0], np.cumsum(n_terms)])
        query = np.full((len(n_terms), query_terms), _NONE, np.uint32)
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            top = np.argpartition(-weight[a:b], query_terms)[:query_terms] if b - a > query_terms else np.arange(b - a)
            query[i, :len(top)] = terms[a:b][np.sort(top)]
        doc = np.repeat(np.arange(len(n_terms), dtype=np.uint32), n_terms)
        # Order by term, then place: sorting both as one number takes half the time of a stable argsort.
        by_term = np.sort(terms.astype(np.int64) << 32 | np.arange(len(terms))) & 0xFFFFFFFF
        first = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=1 << bits))])
        # Weights in 65,535 steps of the file's greatest one.
        unit = max(float(weight.max(initial=0)), 1e-30) / 65535
        code = np.ceil(weight[by_term] / unit).clip(1, 65535).astype(np.uint16)
        top = np.zeros(1 << bits, np.uint16)
        some = first[:-1] < first[1:]
        top[some] = np.maximum.reduceat(code, first[:-1][some])
        out = io.BytesIO()
        size = part.column("size").to_numpy()
        np.savez(out, first=first.astype(np.uint32), top=top, unit=unit, weight=code,
                 doc=doc[by_term].astype(np.uint16 if len(n_terms) <= 1 << 16 else np.uint32), size=size, row=part.column("row").to_numpy())
        put(path, out.getvalue())
        return pa.RecordBatch.from_arrays(
            [part.column("row").combine_chunks(), pa.array(size), pa.array([q.tobytes() for q in query], pa.binary()),
             pa.array([path] * len(size))], names=["row", "size", "query", "file"])

    def run(batches):
        name, nth, held, n, n_terms = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            for part in T.slices(batch, "terms", index_terms):
                held.append(part)
                n += part.num_rows
                n_terms += part.column(2).nbytes // 4
                if n >= index_rows or n_terms >= index_terms:
                    for cut in _cut(pa.Table.from_batches(held), index_rows):
                        yield one(cut, f"{base}/{name}-{nth}.npz")
                        nth += 1
                    held, n, n_terms = [], 0, 0
        if n:
            for cut in _cut(pa.Table.from_batches(held), index_rows):
                yield one(cut, f"{base}/{name}-{nth}.npz")
                nth += 1

    some = rows.filter("n_terms > 0").select("row", "size", "terms", "tf", "words").coalesce(max(spark.sparkContext.defaultParallelism, -(-n_terms // index_terms)))
    return stored(spark, some.mapInArrow(run, _HEADS), "heads")


def files_of(heads: DataFrame) -> list[str]:
    """Index files (one small entry each), those of few documents first: they fill the seeds' lists, which bound the work in the others."""
    return [file for _, file in sorted((r["count"], r.file) for r in heads.groupBy("file").count().collect())]


def _cut(part: pa.Table, n: int) -> list[pa.Table]:
    return [part.slice(i, n) for i in range(0, part.num_rows, n)]


CHUNK_BITS = 16
BLOCK = 65536  # seeds that go through the index files together: each file is read once for them
COMMON = 512  # terms of an index file of which a seed's score can be added up last
LEFT_OUT = 0.75  # how much of what a list asks for the terms left out may come to


def _bits(marks: list[str], chunk: int) -> np.ndarray:
    """Which rows of a chunk are used, from the latest folder that has the chunk."""
    for folder in reversed(marks):
        try:
            with arrays_of(f"{folder}/{chunk}.npz") as f:
                return np.unpackbits(f["bits"]).astype(bool)
        except FileNotFoundError:
            continue
    return np.zeros(1 << CHUNK_BITS, bool)


def _used(marks: list[str], rows: np.ndarray) -> np.ndarray:
    out, chunk = np.zeros(len(rows), bool), rows >> CHUNK_BITS
    for c in np.unique(chunk).tolist():
        mine = chunk == c
        out[mine] = _bits(marks, c)[rows[mine] & ((1 << CHUNK_BITS) - 1)]
    return out


def _marked(spark: SparkSession, marks: list[str], rows: DataFrame) -> list[str]:
    """``marks`` with a folder in which ``rows`` are used as well: a file for every chunk of rows that gains some."""
    folder = scratch_path(spark, "llm-used")

    def bits(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        used = _bits(marks, key[0].as_py())
        used[part.column("row").to_numpy() & ((1 << CHUNK_BITS) - 1)] = True
        out = io.BytesIO()
        np.savez(out, bits=np.packbits(used))
        put(f"{folder}/{key[0].as_py()}.npz", out.getvalue())
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64())})

    chunk = F.shiftright("row", CHUNK_BITS).alias("chunk")
    rows.select(chunk, "row").groupBy("chunk").applyInArrow(bits, "chunk long").count()
    return [*marks, folder]


def _unused(frame: DataFrame, marks: list[str]) -> DataFrame:
    """Rows of ``frame`` (its first column is the row number) that are not used yet."""
    if not marks:
        return frame

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(~_used(marks, batch.column(0).to_numpy())))

    return frame.mapInArrow(run, frame.schema)


def _mixed(seeds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return T.mix(rows.astype(np.uint64) ^ T.mix(seeds.astype(np.uint64)))


class _Shelf:
    """An index file's documents and their postings.

    The postings of used documents stay until ``trim``; their scores are passed over.
    """

    def __init__(self, path: str, marks: list[str]):
        with arrays_of(path) as kept:
            first, self.doc, self.weight, self.row, self.size, top, self.unit = (
                kept[k] for k in ("first", "doc", "weight", "row", "size", "top", "unit"))
        self.free = ~_used(marks, self.row)
        self.n_free = int(self.free.sum())
        self.both = None  # a posting's document and weight in one number, for what is sorted
        # One more term, which no document has.
        self.first = np.append(first, first[-1]).astype(np.int64)
        self.top = np.append(top, 0)

    def trim(self) -> None:
        """Leave out the used documents and their postings."""
        free, keep = self.free, self.free[self.doc]
        self.first = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[self.first]
        self.doc, self.weight = (np.cumsum(free) - 1).astype(self.doc.dtype)[self.doc[keep]], self.weight[keep]
        self.row, self.size, self.free, self.both = self.row[free], self.size[free], np.ones(self.n_free, bool), None

    def postings(self, asks: np.ndarray) -> np.ndarray:
        """Number of postings that each row of ``asks`` reads."""
        return (self.first[asks + 1] - self.first[asks]).sum(axis=1)

    def without_common(self, asks: np.ndarray, over: np.ndarray) -> tuple[np.ndarray, ...]:
        """(terms to read, terms left out, greatest sum of those) per seed, whose terms come in a falling order of frequency.

        Left out are a seed's commonest terms as long as a document with all
        of them, and no other, would stay well under ``over``.  They are
        places among the ``COMMON`` commonest terms of the file, ``COMMON`` for none.
        """
        size = np.diff(self.first)
        names = np.argpartition(-size, COMMON)[:COMMON] if len(size) > COMMON else np.arange(len(size))
        self.common = names[size[names] * 256 >= len(self.row)]  # a rare term is read in less time than it is looked up
        place = np.full(len(size), COMMON, np.int16)
        place[self.common] = np.arange(len(self.common))
        total, place = np.cumsum(self.top[asks], axis=1, dtype=np.int32), place[asks]
        out = (place < COMMON) & (total <= (over * LEFT_OUT)[:, None])
        return np.where(out, len(size) - 1, asks), np.where(out, place, COMMON), np.where(out, total, 0).max(axis=1)

    def common_weights(self) -> np.ndarray:
        """Weights of all documents for the terms that ``without_common`` may leave out, and a row of none."""
        table = np.zeros((COMMON + 1, len(self.row)), np.uint16)
        for k, (a, b) in enumerate(zip(self.first[self.common].tolist(), self.first[self.common + 1].tolist())):
            table[k, self.doc[a:b]] = self.weight[a:b]
        return table

    def _read(self, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and weight, as one number, of every posting that the rows of ``asks`` read, and how many each reads."""
        if self.both is None:
            self.both = self.doc.astype(np.uint32 if len(self.row) <= 1 << 16 else np.uint64) << 16 | self.weight
        first = self.first[asks].ravel()
        size = self.first[asks + 1].ravel() - first
        at = np.repeat(first - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        return self.both[at], size.reshape(asks.shape).sum(axis=1)

    def _added(self, seed: np.ndarray, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of seed and document, ascending, as numbers of cells, and the sum of each."""
        key = (seed.astype(np.int64) * len(self.row) << 16) + both.astype(np.int64)
        key.sort()
        cell = key >> 16
        starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[:len(cell)])
        return cell[starts], np.add.reduceat(key & 0xFFFF, starts) if len(key) else key

    def all_scores(self, asks: np.ndarray, few: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(seed, document, score) of all scores; ``asks`` has a row of terms per seed.

        Of ``few`` postings the places are sorted; otherwise scores of all documents are held.
        """
        n = len(self.row)
        if few:
            both, size = self._read(asks)
            cell, score = self._added(np.repeat(np.arange(len(asks)), size), both)
        else:
            spans = [slice(a, b) for a, b in zip(self.first[asks].ravel().tolist(), self.first[asks + 1].ravel().tolist())]
            at = np.concatenate([self.doc[s] for s in spans]).astype(np.intp)
            at += np.repeat(np.arange(len(asks)) * n, self.postings(asks))
            score = np.bincount(at, np.concatenate([self.weight[s] for s in spans]), minlength=len(asks) * n)
            cell = np.flatnonzero(score)
            score = score[cell]
        seed, doc = cell // n, cell % n
        free = self.free[doc]
        return seed[free], doc[free], score[free] * self.unit

    def scores_beyond(self, asks: np.ndarray, over: np.ndarray, left: np.ndarray, rest: np.ndarray, table: np.ndarray | None,
                      few: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(seed, document, score) of all scores beyond the seeds' ``over`` (in the file's units).

        Of ``few`` postings, weights are added up for documents whose numbers
        end alike first; only the postings of those that come far enough
        together are sorted and added exactly.  Terms ``left`` out are added
        where their greatest sum, ``rest``, can lift the score beyond ``over``.
        """
        n = len(self.row)
        edge = np.clip(np.floor(over - rest - (rest > 0) / 2), 0, 0xFFFFFFFF).astype(np.uint32)
        both, size = self._read(asks)
        # Twice as many places as postings; at most 2,048 documents in each, so that 32 bits hold their sums.
        width = 1 << np.ceil(np.log2(np.maximum(2 * size, (n >> 11) + 1))).astype(np.int64) if few else np.full(len(size), n)
        at = np.repeat(np.cumsum(width) - width, size)
        at += both >> 16 & np.repeat((width - 1).astype(both.dtype), size) if few else both >> 16
        total = np.zeros(int(width.sum()), np.uint32)
        np.add.at(total, at, (both & 0xFFFF).astype(np.uint32))
        if few:
            some = np.flatnonzero(total[at] > np.repeat(edge, size))
            cell, score = self._added(np.searchsorted(np.cumsum(size), some, side="right"), both[some])
        else:
            cell = np.flatnonzero(total.reshape(len(size), n) > edge[:, None])
            score = total[cell].astype(np.int64)
        seed, doc = cell // n, cell % n
        hit = (score > edge[seed]) & self.free[doc]
        seed, doc, score = seed[hit], doc[hit], score[hit]
        if table is not None:
            tops = np.zeros(COMMON + 1, np.int64)
            tops[:len(self.common)] = self.top[self.common]
            tops = tops[left]
            upto = np.cumsum(tops, axis=1) - tops
            for k in reversed(np.flatnonzero((left < COMMON).any(axis=0)).tolist()):  # the rarest first: it lifts most
                score = score + table[left[seed, k], doc]
                hit = score > (over - upto[:, k])[seed]
                seed, doc, score = seed[hit], doc[hit], score[hit]
        hit = score > over[seed]
        return seed[hit], doc[hit], score[hit] * self.unit


def _best(seed, score, row, size, want: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every seed's best documents until they hold ``want[seed]`` tokens; within a step the order is the seed's own."""
    order = np.lexsort((_mixed(seed, row), -score, seed))
    seed, score, row, size = (x[order] for x in (seed, score, row, size))
    total = np.cumsum(size)
    starts = np.flatnonzero(np.append(True, seed[1:] != seed[:-1])) if len(seed) else np.zeros(0, np.int64)
    before = total - size - np.repeat(total[starts] - size[starts], np.diff(np.append(starts, len(seed))))
    keep = before < want[seed]
    return seed[keep], score[keep], row[keep], size[keep]


_LIST = pa.struct([("row", pa.int64()), ("size", pa.int64()), ("score", pa.float64())])


def _within(names: np.ndarray, sizes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many of a seed's listed documents (``names`` ascending) its room holds, the last in part."""
    total, held = np.cumsum(sizes), np.bincount(names, sizes, minlength=len(room))
    before = total - sizes - (np.cumsum(held) - held)[names]
    return np.bincount(names[before < room[names]], minlength=len(room))


def found(seeds: DataFrame, files: list[str], marks: list[str], depth: int, no_term: int, block: int = BLOCK, cells: int = 1 << 18) -> DataFrame:
    """The seeds with their lists: the best unused documents of the whole index, ``depth`` times what the room holds.

    The first ``n_now`` of a list fill the room.  What is unused of a list
    goes before all that is not in it, so a seed asks again only when that
    doesn't fill its room and the list isn't ``whole`` (all that shares a
    term with the seed).  ``block`` seeds go through the files together;
    ``cells`` scores, twice as many postings and about as many findings
    beyond the lists are held at once.
    """
    def search(asks: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, ...]:
        least = np.zeros(len(asks))  # under it, a full list takes no more
        have = tuple(np.zeros(0, t) for t in (np.int64, np.float64, np.int64, np.int64))
        ordered = False
        for path in files if len(asks) else []:
            shelf = _Shelf(path, marks)
            if not shelf.n_free:
                continue
            if not ordered:  # files are much alike: one order of the seeds' terms, by frequency, serves for all
                asks = np.take_along_axis(asks, np.argsort(shelf.first[asks] - shelf.first[asks + 1], axis=1, kind="stable"), axis=1)
                ordered = True
            # The greatest weights of a seed's terms bound its scores here.
            bound = shelf.top[asks].sum(axis=1, dtype=np.int64) * shelf.unit
            some = np.flatnonzero(bound > least)
            some = some[np.argsort(least[some] > 0, kind="stable")]
            n_open, n_rows, kept, table = int((least[some] == 0).sum()), len(shelf.row), asks[some], None
            left, rest, over = np.full((len(some), 1), COMMON), np.zeros(len(some)), least[some] / shelf.unit
            if n_open < len(some):
                out, full = shelf.without_common(kept[n_open:], over[n_open:]), slice(n_open, None)
                left = np.full(kept.shape, COMMON)
                kept[full], left[full], rest[full] = out
            read = shelf.postings(kept)
            if 2 * read.sum() * (n_rows - shelf.n_free) > len(shelf.doc) * n_rows:
                shelf.trim()
                read = shelf.postings(kept)
                n_rows = len(shelf.row)
            if rest.any():
                table = shelf.common_weights()
            # Lists that are not full take all; of their seeds, those that read far fewer postings than there are documents go first.
            kind = np.where(np.arange(len(some)) >= n_open, 2 + (read * 8 >= n_rows), read * 12 >= n_rows)
            order = np.lexsort((read, kind))
            ends, read, at = np.cumsum(np.bincount(kind, minlength=4)), np.cumsum(read[order]), 0
            fresh, n_fresh, most = [], 0, cells
            while at < len(some):
                k = int(np.searchsorted(ends, at, side="right"))
                end = int(np.searchsorted(read, (read[at - 1] if at else 0) + (cells // 2, 2 * cells, cells // 4, cells // 4)[k], side="right"))
                if k % 2:
                    end = min(end, at + cells // n_rows)
                now = order[at:max(at + 1, min(end, int(ends[k])))]
                at, own = at + len(now), some[now]
                if k < 2:
                    i, d, score = shelf.all_scores(kept[now], not k)
                else:
                    i, d, score = shelf.scores_beyond(kept[now], over[now], left[now], rest[now], table, k == 2)
                if not len(i):
                    continue
                cuts = np.searchsorted(i, np.arange(len(own) + 1))
                long = np.flatnonzero(np.diff(cuts) > 256)
                if len(long):  # the best 64, if they hold what is wanted, and all of their step
                    keep = np.ones(len(i), bool)
                    for k in long.tolist():
                        mine = slice(cuts[k], cuts[k + 1])
                        edge = np.partition(score[mine], -64)[-64]
                        if shelf.size[d[mine]][score[mine] >= edge].sum() >= want[own[k]]:
                            keep[mine] = score[mine] >= edge * (1 - 1 / 16)
                    i, d, score = i[keep], d[keep], score[keep]
                score = np.exp2(np.floor(np.log2(score) * 16) / 16)
                near = score >= least[own[i]]
                fresh.append((own[i[near]], score[near], shelf.row[d[near]], shelf.size[d[near]]))
                n_fresh += len(fresh[-1][0])
                if n_fresh > most:  # near copies find one another by the thousand
                    fresh = [_best(*map(np.concatenate, zip(*fresh)), want)]
                    most = n_fresh = len(fresh[0][0])
                    most += cells + n_fresh
            if not n_fresh:
                continue
            # Only the lists that got something are put in order again.
            got = np.zeros(len(asks), bool)
            for x in fresh:
                got[x[0]] = True
            mine = got[have[0]]
            changed = _best(*map(np.concatenate, zip(tuple(x[mine] for x in have), *fresh)), want)
            have = tuple(np.concatenate([x[~mine], y]) for x, y in zip(have, changed))
            held = np.bincount(changed[0], changed[3], minlength=len(asks))
            last = np.full(len(asks), np.inf)
            np.minimum.at(last, changed[0], changed[1])
            least = np.where(got, np.where(held >= want, last * (1 - 1e-9), 0), least)
        return have

    def one(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        room, whole, lists = part.column("room").to_numpy(), part.column("whole").to_numpy().copy(), part.column("list").combine_chunks()
        names, listed = lists.value_parent_indices().to_numpy(), lists.flatten()
        row, size, score = (listed.field(i).to_numpy() for i in range(3))
        free = ~_used(marks, row)
        names, row, size, score = names[free], row[free], size[free], score[free]
        asking = ~whole & (np.bincount(names, size, minlength=len(room)) < room)
        who = np.flatnonzero(asking)
        asks = np.frombuffer(b"".join(part.column("query").filter(pa.array(asking)).to_pylist()), np.uint32)
        asks = asks.reshape(len(who), len(asks) // max(1, len(who))).astype(np.int64)
        asks[asks == int(_NONE)] = no_term
        got = search(asks, depth * room[who])
        whole[who] = np.bincount(got[0], got[3], minlength=len(who)) < depth * room[who]
        old = ~asking[names]
        names, score, row, size = (np.concatenate(x) for x in zip((names[old], score[old], row[old], size[old]), (who[got[0]], *got[1:])))
        order = np.argsort(names, kind="stable")
        names, score, row, size = names[order], score[order], row[order], size[order]
        lists = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(names, np.arange(len(room) + 1)).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip((row, size, score), _LIST)], fields=list(_LIST)))
        return pa.RecordBatch.from_arrays(
            [*(part.column(c).combine_chunks() for c in ("seed", "room", "query")), pa.array(whole), lists, pa.array(_within(names, size, room), pa.int64())],
            names=["seed", "room", "query", "whole", "list", "n_now"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                held.append(batch.slice(at, block))
                n += held[-1].num_rows
                if n >= block:
                    yield one(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield one(pa.Table.from_batches(held))

    return seeds.select("seed", "room", "query", "whole", "list").mapInArrow(run, f"{_SEEDS}, n_now long")


def _won(asked: DataFrame) -> DataFrame:
    """(row, seed, score, size): what a seed's room holds of its list, each document for the seed that scores it highest."""
    order = Window.partitionBy("seed").orderBy(F.desc("score"), F.xxhash64("seed", "row"))
    wish = asked.filter("n_now > 0").select("seed", "room", F.inline(F.slice("list", F.lit(1), F.col("n_now").cast("int"))))
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return wish.withColumn("before", before).filter("before < room") \
        .groupBy("row").agg(F.max(F.struct("score", F.xxhash64("seed", "row").alias("by"), "seed", "size")).alias("b")) \
        .select("row", "b.seed", "b.score", "b.size")


def members_of(spark: SparkSession, rows: DataFrame, shared, mean: float, bits: int, window: int, query_terms: int,
               shard_tokens: int, shard_rows: int, index_rows: int, index_terms: int, depth: int, spare: int) -> DataFrame:
    """(row, grp, rank) of every row: the group of documents it is packed with, and its place there."""
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("t"), F.sum("n_terms").alias("terms")).first()
    marks, out, sc = [], [], spark.sparkContext
    heads = indexed(spark, rows, totals.terms or 0, shared, mean, bits, query_terms, index_rows, index_terms)
    files = files_of(heads)
    bare = rows.filter("n_terms = 0").select("row", F.col("row").alias("grp"), F.lit(0.0).alias("rank"))
    if totals.n:
        marks = _marked(spark, marks, bare)
    out.append(bare)
    opened, more, nth = None, 1.0, 0
    while True:
        left = _unused(heads.select("row", "size"), marks)
        n, tokens, part = left.agg(F.count(F.lit(1)), F.sum("size"), F.sum(F.least("size", F.lit(window)))).first()
        if n <= 1 or nth and n <= shard_rows and (tokens or 0) <= shard_tokens:  # one round at least, at any size
            break
        room = opened.agg(F.sum("room")).first()[0] or 0 if opened is not None else 0
        # A full group goes half a document beyond its room.
        share = min(1.0, more * max(0, part - room) / (window + part / n / 2) / n)
        mine = F.pmod(F.xxhash64("row", F.lit(nth)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
        drawn = _unused(heads.select("row", "size", "query").filter(mine), marks)
        if not room and drawn.isEmpty():
            drawn = _unused(heads.select("row", "size", "query"), marks).orderBy("row").limit(1)
        drawn = stored(spark, drawn.select(F.col("row").alias("seed"), F.pmod(-F.col("size"), F.lit(window)).alias("room"), "query"), "seeds")
        out.append(drawn.select(F.col("seed").alias("row"), F.col("seed").alias("grp"), F.lit(float("-inf")).alias("rank")))
        fresh = drawn.select("seed", "room", "query", F.lit(False).alias("whole"), F.expr("cast(array() as array<struct<row: long, size: long, score: double>>)").alias("list"))
        seeds = (fresh if opened is None else opened.unionByName(fresh)).filter("room > 0")
        n_seeds, n_drawn = seeds.count(), drawn.count()
        marks = _marked(spark, marks, drawn.select(F.col("seed").alias("row")))
        # As many tasks on every core, each with a block at most.
        blocks = seeds.repartition(sc.defaultParallelism * max(1, -(-n_seeds // (BLOCK * sc.defaultParallelism))), "seed")
        asked = stored(spark, found(blocks, files, marks, depth * spare, 1 << bits), "found")
        won = stored(spark, _won(asked), "won")
        n_won = won.count()
        if n_won < max(1, n_drawn):
            more *= 2  # few neighbours are left: more seeds at once
        out.append(won.select("row", F.col("seed").alias("grp"), (-F.col("score")).alias("rank")))
        marks = _marked(spark, marks, won)
        took = won.groupBy("seed").agg(F.sum("size").alias("took"))
        # A seed without candidates won't find any later.
        opened = stored(spark, asked.filter("n_now > 0").join(took, "seed", "left").select(
            "seed", (F.col("room") - F.coalesce("took", F.lit(0))).alias("room"), "query", "whole", "list").filter("room > 0"), "open")
        nth += 1

    def rest(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        part = pa.Table.from_batches(got)
        terms, weight, n_terms = _columns(part, shared.value, mean)
        size = part.column("size").to_numpy()
        order = np.array(order_of(size, terms, weight, np.concatenate([[0], np.cumsum(n_terms)]), shared.value, window, query_terms))
        # Groups of 16 windows, so that no task lays out all.
        grp = -1 - (np.cumsum(size[order]) - size[order]) // (16 * window)
        yield pa.RecordBatch.from_arrays([pa.array(part.column("row").to_numpy()[order]), pa.array(grp),
                                          pa.array(np.arange(len(order), dtype=np.float64))], names=["row", "grp", "rank"])

    # What is left is at most one shard, so its row numbers are few.
    last = rows.select("row", "size", "terms", "tf", "words").join(F.broadcast(_unused(heads.select("row"), marks)), "row", "left_semi").repartition(1).sortWithinPartitions("row")
    out.append(stored(spark, last.mapInArrow(rest, "row long, grp long, rank double"), "rest"))
    every = out[0]
    for frame in out[1:]:
        every = every.unionByName(frame)
    return every


def placed(spark: SparkSession, rows: DataFrame, members: DataFrame) -> DataFrame:
    """doc_id, ids, size, grp, rank and row of every row; places go by files of 65,536 rows, so no ids are shuffled."""
    base = scratch_path(spark, "llm-places")

    def keep(key, part):
        order = np.argsort(part.column("row").to_numpy())
        out, path = io.BytesIO(), f"{base}/{key[0].as_py()}.npz"
        np.savez(out, **{c: part.column(c).to_numpy()[order] for c in ("row", "grp", "rank")})
        put(path, out.getvalue())
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64())})

    chunk = F.shiftright("row", 16).alias("chunk")
    members.select(chunk, "row", "grp", "rank").groupBy("chunk").applyInArrow(keep, "chunk long").count()

    def run(batches):
        last, known = None, None
        for batch in batches:
            row = batch.column(3).to_numpy()
            grp, rank = np.zeros(len(row), np.int64), np.zeros(len(row))
            for c in np.unique(row >> 16).tolist():
                if c != last:
                    with arrays_of(f"{base}/{c}.npz") as f:
                        last, known = c, {k: f[k] for k in ("row", "grp", "rank")}
                mine = row >> 16 == c
                at = np.searchsorted(known["row"], row[mine])
                grp[mine], rank[mine] = known["grp"][at], known["rank"][at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(grp), pa.array(rank), batch.column(3)],
                                             names=["doc_id", "ids", "size", "grp", "rank", "row"])

    return rows.select("doc_id", "ids", "size", "row").mapInArrow(run, "doc_id long, ids binary, size long, grp long, rank double, row long")


def parts_of(size: np.ndarray, grp: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length): every group's whole windows, then what the groups have beyond."""
    at = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]]))
    total = np.add.reduceat(size, at)
    nth = np.cumsum(np.concatenate([[0], grp[1:] != grp[:-1]]))
    ends = np.cumsum(size)
    ends -= (np.cumsum(total) - total)[nth]
    main = np.clip((total - total % window)[nth] - (ends - size), 0, size)
    doc = np.arange(len(size))
    doc, start, length = np.concatenate([doc, doc]), np.concatenate([0 * main, main]), np.concatenate([main, size - main])
    return doc[length > 0], start[length > 0], length[length > 0]


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, window: int = 2048,
         bits: int = 18, query_terms: int = 16, shard_tokens: int = 2_500_000, shard_rows: int = 4096,
         with_ids: bool = False, index_rows: int = 32768, index_terms: int = 5_000_000, depth: int = 1, spare: int = 2) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (u32 if asked for)."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    tokenizer = tokenizer or default_path()
    kind = np.dtype(encoder(tokenizer).dtype)
    width = kind.itemsize
    rows = encoded(docs, tokenizer, end_id, bits).withColumn("row", F.monotonically_increasing_id()) \
        .withColumn("size", (F.length("ids") / width).cast("long")).withColumn("n_terms", (F.length("terms") / 4).cast("long"))
    rows = stored(spark, rows, "encoded", compression="zstd")
    df = document_frequencies(rows, bits)
    lengths = rows.agg(F.count(F.lit(1)), F.sum("words")).first()
    mean = max(1.0, float(lengths[1] or 0) / max(1, lengths[0]))
    idf = np.log(1 + (lengths[0] - df + 0.5) / (df + 0.5)).astype(np.float32)
    shared = spark.sparkContext.broadcast(idf)  # 2 ** bits numbers
    members = members_of(spark, rows, shared, mean, bits, window, query_terms, shard_tokens, shard_rows, index_rows,
                         index_terms, depth, spare)

    def one(part: pa.Table, shard: int) -> pa.RecordBatch:
        raw = part.column("ids").to_pylist()
        doc, begin, length = parts_of(part.column("size").to_numpy(), part.column("grp").to_numpy(), window)
        nth, start, length, seq, offset = pieces_of(length, np.arange(len(doc)), window)
        doc, start = doc[nth], start + begin[nth]
        ids = [np.frombuffer(raw[d], kind)[s:s + n].astype("<u4").tobytes() for d, s, n in zip(doc, start, length)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").combine_chunks().take(pa.array(doc)), pa.array(start), pa.array(length),
             pa.array([zlib.crc32(x) for x in ids], pa.int64()), part.column("size").combine_chunks().take(pa.array(doc)),
             pa.array(seq + (shard << 28)), pa.array(offset), pa.array(ids if with_ids else [None] * len(ids), pa.binary())],
            schema=_OUT)

    def run(batches):
        shard, held, n_ids, n_rows = TaskContext.get().partitionId() << 12, [], 0, 0
        for batch in batches:
            for part in T.slices(batch, "ids", width * shard_tokens // 8):
                held.append(part)
                n_rows += part.num_rows
                n_ids += part.column(1).nbytes // width
                if n_ids >= shard_tokens or n_rows >= shard_rows:
                    lot = pa.Table.from_batches(held)
                    grp = lot.column("grp").to_numpy()
                    whole = int(np.argmax(grp == grp[-1]))  # the last group may go on
                    if whole:
                        yield one(lot.slice(0, whole), shard)
                        shard += 1
                        lot = lot.slice(whole)
                    held, n_ids, n_rows = lot.to_batches(), lot.column("ids").nbytes // width, lot.num_rows
        if n_rows:
            yield one(pa.Table.from_batches(held), shard)

    laid = placed(spark, rows, members).repartition("grp").sortWithinPartitions("grp", "rank", "row")
    return laid.mapInArrow(run, OUT)


def digest(result: DataFrame) -> DataFrame:
    """Contract columns of ``op8``."""
    return result.select(*_COLUMNS)

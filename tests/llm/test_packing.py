import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import encode, packing
from tidemark.sources.tables import read_table

TOK = Tokenizer.from_file(encode.default_path())


def check(spark, rows, window=2048, **kw):
    """Every id lies in exactly one piece, and sequences are gapless and need no padding."""
    docs = spark.createDataFrame([(d, t, 1, b"") for d, t in rows], "doc_id long, text string, shard int, ids binary")
    got = packing.pack(spark, docs, window=window, with_ids=True, **kw).collect()
    by_seq, texts = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0 and r.ids_crc32 == zlib.crc32(r.ids)
        by_seq[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id, r.doc_tokens].append((r.start, ids))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    want = Counter((d, tuple(TOK.encode(t or "", add_special_tokens=False).ids + [1])) for d, t in rows)
    if max(Counter((d, len(i)) for d, i in want.elements()).values(), default=0) <= 1:
        assert Counter((d, tuple(i for _, x in sorted(p) for i in x)) for (d, _), p in texts.items()) == want
    assert sum(r.length for r in got) == sum(len(i) * n for (_, i), n in want.items())
    return got


@pytest.mark.parametrize("kw", [{}, {"window": 64, "shard_tokens": 3000}, {"shard_rows": 7}])
def test_whole_table(spark, small, kw):
    check(spark, [tuple(r) for r in read_table(spark, small, "documents").select("doc_id", "text").collect()], **kw)


def test_odd_rows(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, " \n"), (4, "long text " * 40_000), (5, "é" * 3000)]
    assert len(check(spark, rows)) > 20
    check(spark, [(7, "same text")] * 9 + [(7, None)] * 3)
    assert check(spark, []) == []


def test_neighbours_share_a_window(spark):
    rnd = random.Random(1)
    topics = [[f"{c}{rnd.randrange(400)}" for _ in range(200)] for c in ("bra", "ost", "lin", "zug")]
    rows = [(i, " ".join(rnd.choice(topics[i % 4]) for _ in range(60))) for i in range(800)]
    by_seq = defaultdict(Counter)
    for r in check(spark, rows, window=1024):
        by_seq[r.sequence_id][r.doc_id % 4] += r.length
    same = sum(c.most_common(1)[0][1] for c in by_seq.values()) / sum(map(sum, (c.values() for c in by_seq.values())))
    assert same > 0.8  # a quarter by chance


def test_frequencies_cover_all_rows(spark):
    docs = spark.createDataFrame([(i, f"common w{i}") for i in range(50)], "doc_id long, text string").repartition(5)
    rows = packing.encoded(docs, encode.default_path(), 1, 18)
    df = packing.document_frequencies(rows, 18)
    assert df.max() == 50 and df.sum() == 100


@pytest.mark.parametrize("n", [400, 1200])
def test_neighbours_come_from_the_whole_table(spark, n):
    # The eight documents of a topic lie an eighth of the table apart, in other shards and partitions.
    rnd = random.Random(n)
    topics = n // 8
    rows = [(i, " ".join(f"t{i % topics}w{rnd.randrange(30)}" for _ in range(40))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    by_seq = defaultdict(Counter)
    got = packing.pack(spark, docs, window=1024, shard_rows=n // 10, index_rows=n // 5).collect()
    for r in got:
        by_seq[r.sequence_id][r.doc_id % topics] += r.length
    assert sum(r.length for r in got) == sum(len(TOK.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    same = sum(c.most_common(1)[0][1] for c in by_seq.values()) / sum(map(sum, (c.values() for c in by_seq.values())))
    assert same > 0.5  # within one shard, no document has a neighbour


def test_near_copies_end_in_few_rounds(spark):
    rows = [(i, f"the very same text of all with one own word x{i}" * 3) for i in range(600)] + [(None, "")] * 300
    check(spark, rows, window=256, shard_rows=40, index_rows=200)


def test_groups_are_whole_windows_and_rests():
    size, grp = np.array([5, 6, 3, 20, 1]), np.array([1, 1, 2, 3, 3])
    doc, start, length = packing.parts_of(size, grp, 8)
    assert list(zip(doc.tolist(), start.tolist(), length.tolist())) == [
        (0, 0, 5), (1, 0, 3), (3, 0, 16), (1, 3, 3), (2, 0, 3), (3, 16, 4), (4, 0, 1)]


class _Frame:
    """Runs what ``found`` maps over one batch, in this process."""

    def __init__(self, batch):
        self.batch = batch

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):
        return list(run([self.batch]))


def _near_copies(path, n, seeds):
    """An index file of ``n`` documents that all share 16 terms, and ``seeds`` that ask for those."""
    rng = np.random.default_rng(5)
    weight = rng.integers(60_000, 65_536, 16 * n).astype(np.uint16)
    top = weight.reshape(16, n).max(axis=1)
    np.savez(path, first=(np.arange(17) * n).astype(np.uint32), top=top, unit=1e-4, weight=weight,
             doc=np.tile(np.arange(n, dtype=np.uint16), 16), size=np.full(n, 100), row=np.arange(n))
    nothing = pa.array([[]] * seeds, pa.list_(packing._LIST))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(seeds) + n), pa.array(np.full(seeds, 250)), pa.array([np.arange(16, dtype=np.uint32).tobytes()] * seeds, pa.binary()),
         pa.array([False] * seeds), nothing], names=["seed", "room", "query", "whole", "list"])


def test_near_copies_are_not_held_all_at_once(tmp_path):
    path = str(tmp_path / "0.npz")
    batch = _near_copies(path, 4000, 1500)
    tracemalloc.start()
    try:
        got = packing.found(_Frame(batch), [path], [], 1, 16)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.num_rows for b in got) >= 1500
    assert peak < 100 << 20  # 6,000,000 findings of 32 bytes


def test_a_list_that_fills_the_room_is_not_searched_again(tmp_path, monkeypatch):
    path = str(tmp_path / "0.npz")
    batch = _near_copies(path, 300, 40)
    used = np.zeros(1 << packing.CHUNK_BITS, bool)
    monkeypatch.setattr(packing, "_bits", lambda marks, chunk: used)
    first, = packing.found(_Frame(batch), [path], [], 4, 16)
    # The reference: all 300 by their steps; a prefix fills four rooms.
    lists = first.column("list").to_pylist()
    assert all(len(x) == 10 for x in lists) and first.column("n_now").to_pylist() == [3] * 40
    again = first.select(["seed", "room", "query", "whole", "list"])
    used[[x["row"] for x in lists[0][:5]]] = True
    second, = packing.found(_Frame(again), [], [], 4, 16)  # no file to ask
    left = [[x["row"] for x in y if not used[x["row"]]] for y in lists]
    for had, now, n in zip(left, second.column("list").to_pylist(), second.column("n_now").to_pylist()):
        if len(had) >= 3:
            assert [x["row"] for x in now] == had and n == 3
    assert second.column("n_now").to_pylist()[0] == 3
    # A list that is used up asks the index.
    used[[x["row"] for x in lists[0]]] = True
    third, = packing.found(_Frame(again), [path], [], 4, 16)
    assert third.column("n_now").to_pylist()[0] == 3
    assert not {x["row"] for x in third.column("list").to_pylist()[0]} & {x["row"] for x in lists[0]}


def _random_index(folder, rng, files, n, terms):
    """Index files of random documents, few terms of which are common, and their dense weights by row."""
    weights, paths = [], []
    for f in range(files):
        own = np.zeros((terms + 1, n), np.uint16)
        for t in range(terms):
            docs = rng.random(n) < (0.6 if t < 6 else 0.004)
            own[t, docs] = rng.integers(1, 200 if t < 6 else 60_000, int(docs.sum()))
        name, doc = np.nonzero(own[:terms])
        first = np.searchsorted(name, np.arange(terms + 1))
        paths.append(str(folder / f"{f}.npz"))
        np.savez(paths[-1], first=first.astype(np.uint32), top=own[:terms].max(axis=1), unit=1e-4, weight=own[name, doc],
                 doc=doc.astype(np.uint16), size=rng.integers(50, 400, n), row=np.arange(n) + f * n)
        weights.append(own)
    return paths, np.concatenate(weights, axis=1).astype(np.int64)


def _asking(rng, seeds, terms):
    """Seeds that ask for rare terms only, for rare and common ones, or for common ones."""
    asks = np.full((seeds, 16), packing._NONE, np.uint32)
    for i in range(seeds):
        some = [rng.choice(np.arange(6, terms), 5, replace=False), rng.choice(6, 4, replace=False)]
        own = np.concatenate([some[:1], some, some[1:]][i % 3])
        asks[i, :len(own)] = np.sort(own)
    return asks, pa.RecordBatch.from_arrays(
        [pa.array(np.arange(seeds) + 10 ** 6), pa.array(rng.integers(300, 1500, seeds)), pa.array([a.tobytes() for a in asks], pa.binary()),
         pa.array([False] * seeds), pa.array([[]] * seeds, pa.list_(packing._LIST))], names=["seed", "room", "query", "whole", "list"])


@pytest.mark.parametrize("share", [0.0, 0.3, 0.95])
def test_search_equals_scores_of_all_documents(tmp_path, monkeypatch, share):
    rng = np.random.default_rng(int(share * 100))
    files, n, terms = 4, 2000, 300
    paths, weights = _random_index(tmp_path, rng, files, n, terms)
    used = rng.random(1 << packing.CHUNK_BITS) < share
    monkeypatch.setattr(packing, "_bits", lambda marks, chunk: used)
    asks, batch = _asking(rng, 300, terms)
    out, = packing.found(_Frame(batch), paths, [], 2, terms, cells=1 << 13)
    sizes = np.concatenate([np.load(p)["size"] for p in paths])
    for i, (got, whole) in enumerate(zip(out.column("list").to_pylist(), out.column("whole").to_pylist())):
        own = asks[i][asks[i] != packing._NONE].astype(int)
        score = np.where(used[:files * n], 0, weights[own].sum(axis=0)) * 1e-4
        some = np.flatnonzero(score > 0)
        steps = np.exp2(np.floor(np.log2(score[some]) * 16) / 16)
        want = packing._best(np.zeros(len(some), np.int64) + i, steps, some, sizes[some], 2 * batch.column("room").to_numpy())
        assert [(x["row"], x["size"]) for x in got] == list(zip(want[2].tolist(), want[3].tolist()))
        assert np.allclose([x["score"] for x in got], want[1])
        assert whole == (sizes[some].sum() < 2 * batch.column("room")[i].as_py())


def test_seeds_with_few_postings_hold_no_score_of_every_document(tmp_path, monkeypatch):
    rng = np.random.default_rng(9)
    paths, _ = _random_index(tmp_path, rng, 3, 4000, 300)
    _, batch = _asking(rng, 300, 300)
    held, count = [], np.bincount
    monkeypatch.setattr(packing.np, "bincount", lambda x, *a, minlength=0, **k: (held.append(minlength), count(x, *a, minlength=minlength, **k))[1])
    packing.found(_Frame(batch), paths, [], 1, 300)
    assert sum(held) < 0.8 * 300 * 3 * 4000  # a third reads rare terms only


def test_terms_are_stored_by_their_steps(spark):
    rows = [(1, "b a c a"), (2, None), (3, ""), (4, "a"), (5, "z y x a b c d e f g")]
    got = packing.encoded(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), encode.default_path(), 1, 18).toArrow()
    terms, at = packing._term_ids(got.column("terms"))
    own = [terms[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert [len(x) for x in own] == [3, 0, 0, 1, 10] and all(x == sorted(set(x)) for x in own)
    assert set(own[3]) < set(own[0]) < set(own[4]) and got.column("words").to_pylist() == [4, 0, 0, 1, 10]
    step = np.frombuffer(b"".join(got.column("terms").to_pylist()), np.uint32)
    assert step[0] == own[0][0] and (step[1:3] == np.diff(own[0])).all()


def test_words_of_known_pieces_are_not_hashed_again(monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["Don't", "a1b2", "(Élan)", "x,y", "日本,語", "plain", "w-w", "É1"]) for _ in range(300)) for _ in range(20)] + [None, "", "<|endoftext|> a b a"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    monkeypatch.setattr(packing, "documents_of", lambda docs: docs)
    run = lambda b: pa.Table.from_batches(packing.encoded(_Frame(b), encode.default_path(), 1, 18))
    batch, special = batch.slice(0, len(texts) - 1), batch
    for part in (special, batch):
        got = run(part)
        own = packing._words(*packing.T.utf8(part.column(1)), 18)
        want = packing._terms(*own, 18)
        assert got.column("words").to_pylist() == np.diff(own[1]).tolist()
        for name, all_of in (("terms", want[0]), ("tf", want[1])):
            assert b"".join(got.column(name).to_pylist()) == all_of.tobytes()
    hashed, usual = [], packing.T.span_hashes
    monkeypatch.setattr(packing.T, "span_hashes", lambda data, *a: (hashed.append(len(data)), usual(data, *a))[1])
    run(batch)
    assert sum(hashed) <= sum(len((t or "").encode()) for t in texts)  # once, for the lookup


def test_numbers_of_keys_that_meet_in_a_place():
    table = encode._Numbers(4)
    keys = np.array([1, 2, 3, (1 << 64) - 1, (1 << 64) - 2], np.uint64)  # the last ones go round the end
    assert table.add(keys).tolist() == [0, 1, 2, 3, 4] and table.find(keys[::-1]).tolist() == [4, 3, 2, 1, 0]
    more = np.arange(10, 5000, dtype=np.uint64)
    assert (table.find(more) == -1).all()
    table.add(more)
    assert (table.find(more) == np.arange(5, 4995)).all() and table.find(keys).tolist() == [0, 1, 2, 3, 4]
    lists = encode._Lists(np.uint16)
    lists.add(np.arange(6), np.array([1, 0, 2, 3]))
    got, at = lists.spread(np.array([3, 0, 1, 2] * 20_000))
    assert got.tolist() == [3, 4, 5, 0, 1, 2] * 20_000 and at[:5].tolist() == [0, 3, 4, 4, 6]


def test_small_index_files_are_asked_first(spark):
    heads = spark.createDataFrame([(i, f) for f, n in (("a", 30), ("b", 2), ("c", 9), ("d", 9)) for i in range(n)], "row long, file string")
    assert packing.files_of(heads) == ["b", "c", "d", "a"]
    assert packing.files_of(heads.limit(0)) == []


def test_an_index_file_is_read_once_for_many_seeds(tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    paths, _ = _random_index(tmp_path, rng, 2, 100, 40)
    _, batch = _asking(rng, 400, 40)
    opened, usual = [], packing._Shelf.__init__
    monkeypatch.setattr(packing._Shelf, "__init__", lambda self, path, marks: (opened.append(path), usual(self, path, marks))[1])
    many = pa.Table.from_batches([batch] * 100).combine_chunks().to_batches()[0]
    assert sum(b.num_rows for b in packing.found(_Frame(many), paths, [], 1, 40)) == 40_000
    assert len(opened) == 2


def test_only_postings_that_come_far_enough_are_sorted(tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    paths, _ = _random_index(tmp_path, rng, 6, 3000, 300)
    _, batch = _asking(rng, 300, 300)
    read, ordered, usual_read, usual = [], [], packing._Shelf._read, packing._Shelf._added
    monkeypatch.setattr(packing._Shelf, "_read", lambda self, asks: (got := usual_read(self, asks), read.append(len(got[0])))[0])
    monkeypatch.setattr(packing._Shelf, "_added", lambda self, seed, both: (ordered.append(len(both)), usual(self, seed, both))[1])
    packing.found(_Frame(batch), paths, [], 1, 300)
    assert 0 < sum(ordered) < 0.5 * sum(read)

"""Substring dedup by relative Lempel-Ziv parsing against every document of smaller doc_id.

The reference is the whole corpus, cut into index blocks. Every window of `window` words is
hashed; a window's block follows from the smallest five-word hash inside it, so runs of
neighbouring windows, and equal windows everywhere, fall into the same block. A block
lists, for each distinct window, its first place in the corpus (smallest doc_id, then
position). Windows are joined by the 64-bit hash of that smallest phrase and 32 bits of their own hash (96 bits: 0.003
false pairs expected among the 2e13 windows of 100 TB); no reference text is compared. The runs of
a document are merged into factors afterwards: from a window known from a smaller doc_id the
factor runs on as long as the next window's first place continues in the same reference
document, so text copied from a document that itself copied an older one can be several
factors where a longest match would be one; what is removed is the same. Factors of `window` words or more are the duplicate
spans; the words of a document outside them are kept.

Tasks read documents in chunks of at most `chunk_words` words (or one longer document) and resolve repeats
inside a chunk themselves: a window goes to its block only for the chunk's smallest doc_id
that has it. A passage in very many documents thus costs one entry a chunk, not one a document.
Blocks hold about `block_bytes` of text each, so their number grows with the corpus. A first
pass counts the windows of each block; one of more than `split_windows` (many different windows
that share a phrase) is split by window hash, so equal windows still meet and results stay. A task settles its blocks one
after the other, so the number of tasks is bounded (`MAX_TASKS`) whatever the number of blocks; of a block it holds the
windows of `SLICE_WINDOWS` at a time (or of one phrase), and kept texts leave in batches of `TRIM_BYTES`. What a chunk sends is
packed: a phrase hash a run, four bytes a window, and the documents and places of the runs as compressed columns.

Edge cases: NULL or empty texts have no words and keep nothing; texts of fewer than
`window` words are kept whole; rows with a NULL doc_id are kept whole and are no
reference; repeated rows with one doc_id never remove each other; an empty table gives an
empty result; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areabook.llm.common import KEY, left_join, stager
from areabook.llm.textstats import rolling, word_hashes

WINDOW = 13
ANCHOR = 5
CHUNK_WORDS = 1 << 19
BLOCK_BYTES = 6 << 20
SPLIT_WINDOWS = 1 << 21
_MIX = np.uint64(0xD6E8FEB86659FD93)
MAX_TASKS = 1 << 16
SLICE_WINDOWS = 1 << 17
TRIM_BYTES = 4 << 20
ENTRY = "block long, runs binary, hashes binary, done binary"
FACTOR = "doc_id long, text_key long, start int, n_windows int, ref_doc long, ref_start int"
_HIT = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<i4"), ("n", "<i4"), ("ref", "<i8"), ("at", "<i4")])


def _anchors(h: np.ndarray, window: int) -> np.ndarray:
    """The smallest anchor hash inside each window."""
    a = rolling(h, ANCHOR)
    n = len(h) - window + 1
    low = a[:n].copy()
    for k in range(1, window - ANCHOR + 1):
        np.minimum(low, a[k:k + n], out=low)
    return low


def _block_of(anchor: np.ndarray, blocks: int) -> np.ndarray:
    """Index block of each window, from its anchor."""
    low = anchor ^ (anchor >> np.uint64(32))
    low *= _MIX
    return ((low >> np.uint64(33)) % np.uint64(blocks)).astype(np.int64)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, one behind the other, compressed (each as differences: they grow slowly)."""
    raw = b"".join(np.diff(c, prepend=c.dtype.type(0)).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes, types: list[str]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    types_ = [np.dtype(t) for t in types]
    n, at, out = len(raw) // sum(t.itemsize for t in types_), 0, []
    for t in types_:
        out.append(np.cumsum(np.frombuffer(raw, t, n, at), dtype=t))
        at += n * t.itemsize
    return out


def _breaks(*conditions: np.ndarray) -> np.ndarray:
    """First rows of runs: where any of the arrays says that a row does not continue the one before."""
    new = np.zeros(len(conditions[0]) + 1, dtype=bool)
    new[0] = True
    for c in conditions:
        new[1:] |= c
    return np.flatnonzero(new)


def _hits(doc, key, pos, n, ref, at) -> np.ndarray:
    """Runs of `n` windows known from a reference, merged along the reference; rows in text order."""
    if not len(doc):
        return np.empty(0, dtype=_HIT)
    d = np.diff
    first = _breaks(d(doc) != 0, d(key) != 0, d(pos) != n[:-1], d(ref) != 0, d(at) != n[:-1])
    out = np.empty(len(first), dtype=_HIT)
    for name, v in (("doc", doc), ("key", key), ("start", pos), ("ref", ref), ("at", at)):
        out[name] = v[first]
    out["n"] = np.add.reduceat(n, first)
    return out


def _first_places(place: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each window, the smallest place of those with its hash. A place is one number: the
    document's rank, then the position in 32 bits."""
    order = np.argsort(h)
    same = h[order]
    head = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
    del same
    least = np.minimum.reduceat(place[order], head)
    first = np.empty_like(place)
    first[order] = np.repeat(least, np.diff(np.append(head, len(order))))
    return first


class _Chunk:
    """Windows of the documents read so far in a task."""

    def __init__(self, window: int, blocks: int, split: dict[int, int]):
        self.window, self.blocks, self.parts, self.words = window, blocks, [], 0
        self.split_ids = np.array(sorted(split), dtype=np.int64)
        self.split_into = np.array([split[b] for b in sorted(split)], dtype=np.int64)

    def _spread(self, block, h, doc, known):
        """Blocks with the part of a split one in them: new windows by hash, settled ones by document."""
        if not len(self.split_ids):
            return block
        i = np.minimum(np.searchsorted(self.split_ids, block), len(self.split_ids) - 1)
        k = np.where(self.split_ids[i] == block, self.split_into[i], 1)
        by_hash = ((h * _MIX) >> np.uint64(33)).astype(np.int64) % k
        return block + self.blocks * np.where(known, doc % k, by_hash)

    def add(self, doc: int, key: int, text: str) -> None:
        h = word_hashes(text.encode().split())
        self.words += len(h)
        if len(h) >= self.window:
            self.parts.append((doc, key, rolling(h, self.window), _anchors(h, self.window)))

    def rows(self):
        """One entry a block: runs and hashes of the windows it must place, and what is settled here."""
        if not self.parts:
            return None
        sizes = np.array([len(p[2]) for p in self.parts])
        docs, keys = (np.array([p[c] for p in self.parts], dtype=np.int64) for c in (0, 1))
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        pos = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
        h, anchor = np.concatenate([p[2] for p in self.parts]), np.concatenate([p[3] for p in self.parts])
        self.parts, self.words = [], 0
        ranked, rank = np.unique(docs, return_inverse=True)
        first = _first_places((rank << 32)[row] | pos, h)
        known = first >> 32 < rank[row]
        block = self._spread(_block_of(anchor, self.blocks), h, docs[row], known)
        order = np.argsort(block, kind="stable")       # text order stays inside a block
        bounds = np.flatnonzero(np.concatenate(([True], np.diff(block[order]) != 0)))
        out = {"block": [], "runs": [], "hashes": [], "done": []}
        for i, j in zip(bounds, np.append(bounds[1:], len(order))):
            rows = order[i:j]
            new, old = rows[~known[rows]], rows[known[rows]]
            f = _breaks(np.diff(row[new]) != 0, np.diff(pos[new]) != 1, np.diff(anchor[new]) != 0) if len(new) else new
            at = new[f] if len(new) else new
            out["block"].append(int(block[rows[0]]))
            out["runs"].append(_pack(docs[row[at]], keys[row[at]], pos[at], np.diff(np.append(f, len(new))).astype(np.int32)))
            out["hashes"].append(anchor[at].tobytes() + (h[new] >> np.uint64(32)).astype(np.uint32).tobytes())
            hits = _hits(docs[row[old]], keys[row[old]], pos[old], np.ones(len(old), dtype=np.int32),
                         ranked[first[old] >> 32], first[old].astype(np.int32))
            out["done"].append(_pack(*[np.ascontiguousarray(hits[c]) for c in _HIT.names]))
        return pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("block", pa.int64()), ("runs", pa.binary()), ("hashes", pa.binary()), ("done", pa.binary())]))


def _counts(window: int, blocks: int, chunk_words: int):
    """Windows a block, of about `chunk_words` words at a time."""
    def total(found):
        block, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(block), pa.array(n.astype(np.int64))], ["block", "n"])

    def run(batches):
        found, words = [], 0
        for b in batches:
            for text in b.column(0):
                h = word_hashes(text.as_py().encode().split())
                if len(h) >= window:
                    found.append(_block_of(_anchors(h, window), blocks))
                    words += len(h)
                if words >= chunk_words:
                    yield total(found)
                    found, words = [], 0
        if found:
            yield total(found)
    return run


def _entries(window: int, blocks: int, chunk_words: int, split: dict[int, int]):
    def run(batches):
        chunk = _Chunk(window, blocks, split)
        for b in batches:
            for doc, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                chunk.add(doc, key, text.as_py())
                if chunk.words >= chunk_words and (got := chunk.rows()) is not None:
                    yield got
        if (got := chunk.rows()) is not None:
            yield got
    return run


def _slices(anchor: np.ndarray, n: np.ndarray):
    """The runs of a block by phrase, about SLICE_WINDOWS windows at a time; a phrase stays together."""
    order = np.argsort(anchor, kind="stable")
    phrases = np.append(np.flatnonzero(np.concatenate(([True], np.diff(anchor[order]) != 0))), len(order))
    ends = np.cumsum(n[order])[phrases[1:] - 1]
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_WINDOWS, "right")))
        yield order[phrases[at]:phrases[to]]
        at = to


def _placed(doc, key, start, n, anchor, h) -> np.ndarray:
    """The runs of windows known from a smaller doc_id, of all windows of a block."""
    docs, rank = np.unique(doc, return_inverse=True)
    ahead, found = np.cumsum(n) - n, []
    for runs in _slices(anchor, n) if len(n) else ():
        m = n[runs]
        row = np.repeat(np.arange(len(runs), dtype=np.int32), m)
        step = np.arange(len(row)) - (np.cumsum(m) - m)[row]
        pos = start[runs][row] + step
        phrase = np.unique(anchor[runs], return_inverse=True)[1].astype(np.uint64) << np.uint64(32)
        first = _first_places((rank[runs] << 32)[row] | pos, phrase[row] | h[ahead[runs][row] + step])
        k = np.flatnonzero(first >> 32 < rank[runs][row])
        if len(k):
            f = _breaks(np.diff(row[k]) != 0, np.diff(pos[k]) != 1, np.diff(first[k]) != 1)
            found.append((runs[row[k[f]]], pos[k[f]], np.diff(np.append(f, len(k))), first[k[f]]))
    if not found:
        return np.empty(0, dtype=_HIT)
    run, pos, m, first = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((pos, run))                     # text order again
    run, pos, m, first = run[order], pos[order], m[order], first[order]
    return _hits(doc[run], key[run], pos, m, docs[first >> 32], first.astype(np.int32))


def _settle(group: pd.DataFrame) -> pd.DataFrame:
    """One index block: places all its windows and returns the runs known from a smaller doc_id."""
    cols, anchors, hashes, out = [], [], [], []
    for runs, data, done in zip(group["runs"], group["hashes"], group["done"]):
        cols.append(_unpack(runs, ["<i8", "<i8", "<i4", "<i4"]))
        n = len(cols[-1][0])
        anchors.append(np.frombuffer(data, np.uint64, n))
        hashes.append(np.frombuffer(data, np.uint32, -1, 8 * n))
        done = _unpack(done, [_HIT[c].str for c in _HIT.names])
        out.append(np.empty(len(done[0]), dtype=_HIT))
        for name, v in zip(_HIT.names, done):
            out[-1][name] = v
    doc, key, start, n = (np.concatenate(c) for c in zip(*cols))
    out.append(_placed(doc, key, start, n.astype(np.int64), np.concatenate(anchors), np.concatenate(hashes)))
    hits = np.concatenate(out)
    return pd.DataFrame({"doc_id": hits["doc"], "text_key": hits["key"], "start": hits["start"], "n_windows": hits["n"],
                         "ref_doc": hits["ref"], "ref_start": hits["at"]})


def entries(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, chunk_words: int = CHUNK_WORDS,
            split_windows: int = SPLIT_WINDOWS) -> tuple[DataFrame, int]:
    """(what each chunk sends to each index block or part of one, the number of those)."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    size = known.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    blocks = max(1, -(-size // block_bytes))
    split = {}
    if size // 2 > split_windows:                       # a word has two bytes at least, with the blank before it
        n = known.select("text").mapInArrow(_counts(window, blocks, chunk_words), "block long, n long").groupBy("block").agg(F.sum("n").alias("n"))
        # at most one row for split_windows windows of the corpus
        split = {r.block: -(-2 * r.n // split_windows) for r in n.filter(F.col("n") > split_windows).collect()}
    rows = known.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(_entries(window, blocks, chunk_words, split), ENTRY), blocks + sum(split.values()) - len(split)


def pieces(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """Runs of windows known from a smaller doc_id: (doc_id, text_key, start, n_windows, ref_doc, ref_start)."""
    sent, blocks = entries(docs, window, **options)
    # tasks grow with the corpus up to a bound; beyond it a task has several blocks, sorted and settled one by one
    tasks = max(min(blocks, MAX_TASKS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return sent.repartition(tasks, "block").groupBy("block").applyInPandas(_settle, FACTOR)


def parse(start: np.ndarray, n: np.ndarray, ref: np.ndarray, at: np.ndarray, window: int) -> list[tuple]:
    """Greedy factors (start, words, ref_doc, ref_start) from runs of known windows: a run is taken as
    far as it goes; it goes on over block borders while text and reference continue."""
    out: list[tuple] = []
    for i in np.argsort(start, kind="stable"):
        s, m, r, a = int(start[i]), int(n[i]), int(ref[i]), int(at[i])
        if out and out[-1][2] == r and s - out[-1][0] == a - out[-1][3] and s <= out[-1][0] + out[-1][1] - window + 1:
            last = out[-1]
            out[-1] = (last[0], max(last[1], s + m + window - 1 - last[0]), r, last[3])
        else:
            out.append((s, m + window - 1, r, a))
    return out


def _cut(batch: pa.RecordBatch, text: int):
    """The batch in slices of about TRIM_BYTES of text (or one longer document)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TRIM_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _trim(window: int):
    fields = ("start", "n_windows", "ref_doc", "ref_start")

    def kept_of(b):
        ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column(3)), 0).to_numpy())
        flat = b.column(3).flatten()
        runs = [flat.field(c).to_numpy(zero_copy_only=False) for c in fields]
        n_words, removed, kept, factors, upto, at = [], [], [], [], [0], 0
        for text, end in zip(b.column(2), ends.tolist()):
            words = (text.as_py() or "").encode().split()
            found = parse(*(c[at:end] for c in runs), window) if end > at else []
            n_words.append(len(words))
            gone = 0
            if found:
                mask = np.zeros(len(words), dtype=bool)
                for s, m, _, _ in found:
                    mask[s:s + m] = True
                gone = int(mask.sum())
                words = [w for w, x in zip(words, mask.tolist()) if not x]
            removed.append(gone)
            kept.append(b" ".join(words).decode())
            factors += found
            upto.append(len(factors))
            at = end
        types = [("start", pa.int32()), ("n_words", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]
        columns = list(zip(*factors)) if factors else [()] * len(types)
        struct = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types)], fields=[pa.field(*t) for t in types])
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
             pa.ListArray.from_arrays(pa.array(upto, pa.int32()), struct)],
            ["doc_id", "text_key", "n_words", "n_removed", "kept_text", "factors"])

    def run(batches):
        for b in batches:
            yield from map(kept_of, _cut(b, 2))
    return run


def dedup(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """One row a document: doc_id, text_key, n_words, n_removed, kept_text (kept words, one space
    between), factors (start, n_words, ref_doc, ref_start)."""
    st = stager(docs.sparkSession, "rlz")
    found = st.stage(pieces(docs, window, **options), "pieces")
    row = F.struct("start", "n_windows", "ref_doc", "ref_start")
    per = found.groupBy(*KEY).agg(F.collect_list(row).alias("runs"))     # as many as a document has runs
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return left_join(base, per, KEY).select(*KEY, "text", "runs").mapInArrow(_trim(window), (
        "doc_id long, text_key long, n_words long, n_removed long, kept_text string, "
        "factors array<struct<start: int, n_words: int, ref_doc: bigint, ref_start: int>>"))

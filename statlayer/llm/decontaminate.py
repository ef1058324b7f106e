"""Benchmark decontamination by q-gram lemma filtering with banded alignment.

Texts are compared in normal form: lower case, every run of characters that are neither letters, digits
nor non-ASCII one space. A segment is any stretch of ``SEGMENT`` bytes of a benchmark item (a shorter item is one
segment); a leak is a segment that begins or ends with a q-gram it shares with a document and stands there within
``EDIT_SHARE`` of its length in edits. So a verbatim passage of ``SEGMENT`` bytes leaks wherever it was cut from.
Items shorter than ``EDITED`` bytes leak only where they stand letter by letter, as whole words.

* q-gram lemma: a segment of m bytes within k edits shares at least m + 1 - (k + 1) q of its q-grams, on
  diagonals that differ by at most k. All q-grams of a slice of documents are looked up at once in a
  bitmap; stretches with enough hits are expanded to (item, diagonal) pairs, counted in overlapping
  diagonal bands of width 2k + 1 (started every k + 1); of bands that reach the bound the segments are kept whose
  shared q-grams do.
* Every kept region is verified by banded alignment (the segment against any stretch of the region).

The benchmark is a stated query set: it is read in blocks of ``BLOCK_BYTES``, each block is one broadcast
index and one pass over the documents, so what is broadcast is bounded whatever its size.

Defined results: null and empty texts leak nothing; items shorter than a q-gram (``Q`` bytes in normal form) or null
are no evidence and are passed over; equal items each report; of segments that verify, the one with most shared
q-grams is reported (ties: the first in the item); repeated rows each report (``leaks``) or go (``keep_unleaked``);
very long texts are searched whole; empty tables give none, or all documents. Extra columns are ignored or kept.
"""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import keep_rows, map_rows, share, strings

Q = 8
SEGMENT = 96
EDIT_SHARE = 0.08
EDITED = 32                    # shorter items allow no edits
BLOCK_BYTES = 1 << 20          # about a million q-grams, 60 MB while the index is sorted
BITMAP_BITS = 22
MIX = np.uint64(0x9E3779B97F4A7C15)

_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def normal_bytes(text: str) -> bytes:
    """Normal form as UTF-8 bytes."""
    return re.sub(rb" {2,}", b" ", text.lower().encode("utf-8", "replace").translate(_TABLE)).strip(b" ")


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram at every position as one 64-bit number (Q = 8 bytes)."""
    if len(data) < Q:
        return np.empty(0, dtype=np.uint64)
    return np.ndarray(shape=(len(data) - Q + 1,), dtype="<u8", buffer=data, strides=(1,))


def budget(m: int) -> tuple[int, int]:
    """(edits allowed, q-grams that must be shared) for a segment of m bytes."""
    k = int(EDIT_SHARE * m) if m >= EDITED else 0
    while k and m + 1 - (k + 1) * Q < Q:
        k -= 1
    return k, max(1, m + 1 - (k + 1) * Q)


class Index:
    """A block of items, and where each q-gram stands in them."""

    def __init__(self, items: list[tuple[object, str]]):
        self.items, self.texts = [], []
        keys, owner, offs = [], [], []
        for item, text in items:
            data = normal_bytes(text)
            if len(data) < Q:
                continue
            g = grams(np.frombuffer(data, dtype=np.uint8)).copy()
            keys.append(g)
            owner.append(np.full(len(g), len(self.items), dtype=np.int64))
            offs.append(np.arange(len(g), dtype=np.int64))
            self.items.append(item)
            self.texts.append(data)
        self.size = np.array([min(len(t), SEGMENT) for t in self.texts], dtype=np.int64)        # of an item's segments
        self.bounds = np.array([budget(int(m)) for m in self.size], dtype=np.int64).reshape(-1, 2)
        if not keys:
            return
        keys, owner, offs = map(np.concatenate, (keys, owner, offs))
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.many = np.unique(keys[order], return_index=True, return_counts=True)
        self.segs, self.offs = owner[order], offs[order]           # a q-gram's item (its segments are cut when searched) and place
        self.base = max(map(len, self.texts))                        # keeps diagonals positive
        self.bitmap = np.zeros(1 << BITMAP_BITS, dtype=bool)
        self.bitmap[self._slot(self.keys)] = True
        # the weakest demand of any segment, for the first look at a stretch of text
        self.least = int(self.bounds[:, 1].min())
        self.reach = SEGMENT + int(self.bounds[:, 0].max())

    @staticmethod
    def _slot(keys):
        return (keys * MIX) >> np.uint64(64 - BITMAP_BITS)

    def search(self, docs: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(document number, item number, position, edits, shared q-grams) of every verified leak; one a
        document and item, of its segment with the most shared q-grams that verifies."""
        if not self.items:
            return []
        data = np.frombuffer(b"\0".join(docs) + b"\0" * Q, dtype=np.uint8)
        ends = np.cumsum([len(d) + 1 for d in docs])
        g = grams(data)
        hit = np.flatnonzero(self.bitmap[self._slot(g)])
        if not len(hit):
            return []
        at = np.searchsorted(self.keys, g[hit])
        at[at == len(self.keys)] = 0
        ok = self.keys[at] == g[hit]
        hit, at = hit[ok], at[ok]
        # a leak needs ``least`` hits within ``reach`` positions: keep hits that have them around
        n = self.least
        if len(hit) < n:
            return []
        tight = hit[n - 1:] - hit[:len(hit) - n + 1] < self.reach
        live = np.zeros(len(hit) + 1, dtype=np.int64)
        np.add.at(live, np.flatnonzero(tight), 1)
        np.add.at(live, np.flatnonzero(tight) + n, -1)
        live = np.cumsum(live)[:-1] > 0
        hit, at = hit[live], at[live]
        if not len(hit):
            return []
        many = self.many[at]
        pos = np.repeat(hit, many)
        index = np.repeat(self.first[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        seg, off = self.segs[index], self.offs[index]
        # first only the raw counts of (item, diagonal band), to leave the few bands that can matter;
        # bands span two steps of k + 1 diagonals and start every step, so each hit counts in two
        band = (pos - off + self.base) // (self.bounds[seg, 0] + 1)
        name = seg << 40 | band
        names = np.sort(np.concatenate([name, name - 1]))
        edge = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1], [True]]))
        rich = names[edge[:-1]][np.diff(edge) >= self.bounds[names[edge[:-1]] >> 40, 1]]
        if not len(rich):
            return []
        seg2, pos2, off2, both = [], [], [], []
        for one in (name, name - 1):
            near = np.searchsorted(rich, one)
            near[near == len(rich)] = 0
            in_ = rich[near] == one
            seg2.append(seg[in_])
            pos2.append(pos[in_])
            off2.append(off[in_])
            both.append((one & ((1 << 40) - 1))[in_])
        seg2, pos2, off2, both = map(np.concatenate, (seg2, pos2, off2, both))
        doc2 = np.searchsorted(ends, pos2, side="right")
        order = np.lexsort((off2, both, seg2, doc2))
        seg2, doc2, pos2, off2, both = (x[order] for x in (seg2, doc2, pos2, off2, both))
        # a q-gram of the item counts once a band
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (seg2[1:] != seg2[:-1]) | (doc2[1:] != doc2[:-1]) | (both[1:] != both[:-1]) | (off2[1:] != off2[:-1])
        seg2, doc2, off2, both = (x[fresh] for x in (seg2, doc2, off2, both))
        new = np.ones(len(seg2), dtype=bool)
        new[1:] = (seg2[1:] != seg2[:-1]) | (doc2[1:] != doc2[:-1]) | (both[1:] != both[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(seg2))
        # bands in which some segment reaches its bound
        last = np.arange(len(seg2)) + self.bounds[seg2, 1] - 1
        inside = last < np.repeat(stop, stop - start)
        inside[inside] = off2[last[inside]] - off2[inside] <= self.size[seg2[inside]] - Q
        found, known = [], set()
        for i in np.flatnonzero(np.add.reduceat(inside.astype(np.int64), start)):
            a, b = start[i], stop[i]
            s, d = int(seg2[a]), int(doc2[a])
            if (d, s) in known:
                continue
            leak = self.verified(docs[d], s, int(both[a]), off2[a:b], int(ends[d - 1]) if d else 0)
            if leak:
                known.add((d, s))
                found.append((d, s, *leak))
        return found

    def verified(self, doc: bytes, s: int, band: int, offs: np.ndarray, begin: int) -> tuple[int, int, int] | None:
        """(position, edits, shared q-grams) of an item's best segment in a band of a document, from the places of the
        item's q-grams that the band holds."""
        text, m, (k, bound) = self.texts[s], int(self.size[s]), self.bounds[s].tolist()
        starts = np.unique(np.concatenate([offs, offs + Q - m]))
        starts = starts[(starts >= 0) & (starts <= len(text) - m)]
        shared = np.searchsorted(offs, starts + m - Q, side="right") - np.searchsorted(offs, starts)
        for j in np.lexsort((starts, -shared)):
            if shared[j] < bound:
                return None
            at = int(starts[j])
            low = band * (k + 1) - self.base - begin + at - k
            high = min(len(doc), low + m + 5 * k + 2)
            low = max(0, low)
            edits, where = align(text[at:at + m], doc[low:high], k)
            if edits <= k and (m >= EDITED or whole_words(doc, low + where, m)):
                return low + where, edits, int(shared[j])
        return None


def whole_words(doc: bytes, at: int, m: int) -> bool:
    """Whether a stretch is not cut out of longer words."""
    return doc[at - 1:at] in (b"", b" ") and doc[at + m:at + m + 1] in (b"", b" ")


def align(pattern: bytes, region: bytes, k: int) -> tuple[int, int]:
    """(least edits, start of the best stretch) of the pattern against any stretch of the region; k + 1
    if there are more than k. Columns beyond the band of diagonals a region of this size allows cannot
    occur, so each row is one vector."""
    at = region.find(pattern)
    if at >= 0:
        return 0, at
    m, n = len(pattern), len(region)
    if n + k < m:
        return k + 1, 0
    r = np.frombuffer(region, dtype=np.uint8)
    line = np.arange(n + 1)
    prev, born = np.zeros(n + 1, dtype=np.int64), line.copy()    # edits, and where the stretch began
    for i, c in enumerate(pattern, 1):
        swap, drop = prev[:-1] + (r != c), prev[1:] + 1
        cur = np.concatenate([[i], np.minimum(swap, drop)])
        own = np.concatenate([[0], np.where(swap <= drop, born[:-1], born[1:])])
        # an inserted region byte costs one: running minimum of cur - column
        level = np.minimum.accumulate(cur - line)
        src = np.maximum.accumulate(np.where(cur - line == level, line, 0))
        cur, own = level + line, own[src]
        if cur.min() > k:
            return k + 1, 0
        prev, born = cur, own
    end = int(prev.argmin())
    return int(prev[end]), int(born[end])


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """Lists of (item id, text) of at most about ``BLOCK_BYTES`` each."""
    rows = benchmark.select(F.col(id_col).alias("id_"), F.col(text_col).cast("string").alias("text")).where("id_ is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-int(total) // BLOCK_BYTES) or 1
    for n in range(count):
        part = rows.where(F.pmod(F.xxhash64("id_", "text"), F.lit(count)) == n) if count > 1 else rows
        yield sorted((r["id_"], r["text"]) for r in part.collect())


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, position (byte in the document's normal form), edits, shared: one row a document and item."""
    spark: SparkSession = docs.sparkSession
    item = benchmark.schema["item_id"].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    rows = docs.select(F.col("doc_id").alias("id_"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["id_"].dataType.simpleString()
    out = None
    for block in blocks(benchmark):
        shipped = share(spark, Index(block))

        def worker(shipped=shipped):
            import pyarrow as pa

            index = shipped()

            def work(batch):
                ids = batch.column("id_").to_pylist()
                found = index.search([normal_bytes(t or "") for t in strings(batch.column("text"))])
                return pa.RecordBatch.from_arrays(
                    [pa.array([ids[d] for d, *_ in found], type=batch.column("id_").type),
                     pa.array([index.items[s] for _, s, *_ in found], type=item_type),
                     pa.array([p for _, _, p, _, _ in found], type=pa.int64()),
                     pa.array([e for *_, e, _ in found], type=pa.int32()),
                     pa.array([n for *_, n in found], type=pa.int32())],
                    names=["id_", "item_id", "position", "edits", "shared"])
            return work

        part = map_rows(rows, worker, f"id_ {kind}, item_id {item}, position bigint, edits int, shared int")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id_", "doc_id")


def keep_unleaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no segment of any item, all columns as they are."""
    for block in blocks(benchmark):
        shipped = share(docs.sparkSession, Index(block))

        def judge(shipped=shipped):
            index = shipped()

            def clean(text):
                texts = [normal_bytes(t or "") for t in strings(text)]
                bad = {d for d, *_ in index.search(texts)}
                return [i not in bad for i in range(len(texts))]
            return clean

        docs = keep_rows(docs, judge, "text")
    return docs

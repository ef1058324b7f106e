"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

Whole texts are cut by the tokenizer's pattern into pieces; distinct pieces of a slice are encoded
together. Pieces of one length class stand as rows of a padded id matrix. Each round every row merges its
leftmost pair of smallest rank: pair ranks come from a hashed table (open addressing), the merged cell
replaces the pair, and the row is compacted by one cell. Rows without a mergeable pair leave the matrix.
Pieces beyond ``LONG_PIECE`` bytes (a text without any break) run the same merges over a heap, so that one
huge piece costs n log n.

Defined results: null text counts as empty (0 tokens, empty bytes); text that is not valid UTF-8 is read
with replacement characters; repeated rows are encoded each. Only the id and text columns are read.
"""
from __future__ import annotations

import base64
import heapq

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, share, strings

LONG_PIECE = 512           # bytes; longer pieces use the heap instead of the matrices
MATRIX_CELLS = 1 << 19     # cells of one matrix at once
CACHE_PIECES = 150_000     # encoded pieces a task remembers; the memory is emptied when full
NONE = np.int32(2 ** 31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(n) for t, n in (line.split() for line in f if line.strip())}


class PairTable:
    """(left id, right id) -> merged id, by open addressing over numpy arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        keys = (np.array(left, dtype=np.uint64) << np.uint64(32)) | np.array(right, dtype=np.uint64)
        merged = np.array(merged, dtype=np.int32)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.vals = np.full(size, NONE, dtype=np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):               # each round the first comer takes a free slot, the others move on
            free = self.keys[slot[todo]] == np.iinfo(np.uint64).max
            first = np.unique(np.where(free, slot[todo], -1), return_index=True)
            won = todo[first[1][first[0] >= 0]]
            self.keys[slot[won]], self.vals[slot[won]] = keys[won], merged[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left, right):
        """Merged id of each pair, ``NONE`` where there is none; negative ids are padding."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.int64) & 0xFFFFFFFF).astype(np.uint64)
        out = np.full(keys.shape, NONE, dtype=np.int32)
        flat, res = keys.ravel(), out.reshape(-1)
        live = np.flatnonzero(((left >= 0) & (right >= 0)).ravel())
        slot = self._slot(flat[live])
        while len(live):
            found = self.keys[slot]
            hit = found == flat[live]
            res[live[hit]] = self.vals[slot[hit]]
            on = ~hit & (found != np.iinfo(np.uint64).max)
            live, slot = live[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


class Encoder:
    """Encodes pieces of bytes; ``vocabulary[id]`` gives the bytes back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.whole, self.pairs = ranks, PairTable(ranks)
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.vocabulary = {n: t for t, n in ranks.items()}
        self.pair_rank = None
        self.cache: dict[str, bytes] = {}

    def encode_matrix(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32 bits) of pieces of about one length."""
        n, width = len(pieces), max(map(len, pieces))
        ids = np.full((n, width), -1, dtype=np.int32)
        lens = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        ids[np.arange(width)[None, :] < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rank = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(n), [b""] * n

        def finish(done):
            for r, cells in zip(rows[done], ids[done]):
                out[r] = cells[cells >= 0].astype("<u4").tobytes()

        while len(rows):
            if ids.shape[1] == 1:
                finish(np.ones(len(rows), dtype=bool))
                break
            at = rank.argmin(axis=1)           # the leftmost of equal ranks
            best = rank[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                finish(done)
                rows, ids, rank, at, best = rows[~done], ids[~done], rank[~done], at[~done], best[~done]
                if not len(rows):
                    break
            k, w = len(rows), ids.shape[1]
            line = np.arange(k)
            ids[line, at] = best
            gone = np.ones((k, w), dtype=bool)
            gone[line, at + 1] = False
            ids = ids[gone].reshape(k, w - 1)   # compaction: every row loses the pair's right cell
            if w == 2:
                rank = rank[:, :0]
                continue
            gone = np.ones((k, w - 1), dtype=bool)
            gone[line, at] = False
            rank = rank[gone].reshape(k, w - 2)
            for side in (at - 1, at):           # pairs left and right of the merged cell
                ok = (side >= 0) & (side < w - 2)
                r, c = line[ok], side[ok]
                rank[r, c] = self.pairs.ranks(ids[r, c], ids[r, c + 1])
        return out

    def encode_long(self, piece: bytes) -> bytes:
        """The same merges over a linked list and a heap of (rank, position)."""
        if self.pair_rank is None:
            used = self.pairs.vals != NONE
            self.pair_rank = dict(zip(self.pairs.keys[used].tolist(), self.pairs.vals[used].tolist()))
        look = self.pair_rank.get
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := look(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue                        # one of the cells has changed since
            ids[i], alive[j], nxt[i] = r, False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (m := look(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (m, x, ids[x], ids[y]))
        return np.array([x for x, on in zip(ids, alive) if on], dtype="<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that are not remembered yet."""
        new = pieces.difference(self.cache)
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            new = pieces
        buckets: dict[int, list[str]] = {}
        for p in new:
            raw = p.encode()
            known = self.whole.get(raw)
            if known is not None:
                self.cache[p] = known.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                self.cache[p] = self.encode_long(raw)
            else:                               # a class a length up to 16, then steps of an eighth
                size = len(raw)
                step = max(1, 1 << max(0, size.bit_length() - 4))
                buckets.setdefault(-(-size // step) * step, []).append(p)
        for width, group in buckets.items():
            rows = max(1, MATRIX_CELLS // width)
            for at in range(0, len(group), rows):
                part = group[at:at + rows]
                self.cache.update(zip(part, self.encode_matrix([p.encode() for p in part])))

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        pieces = [self.split(t) for t in texts]
        self.learn(set().union(*pieces))
        look = self.cache.__getitem__
        return [b"".join(map(look, p)) for p in pieces]

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids."""
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """id, n_tokens, ids (binary, little-endian unsigned 32 bits) and, if asked for, the decoded bytes.

    The rank file (about a megabyte, its size is fixed by the tokenizer) is read on the driver and
    turned into the pair table there; that table of fixed size is broadcast.
    """
    tables = share(docs.sparkSession, Encoder(load_ranks(ranks_path), pattern))

    def worker():
        import pyarrow as pa

        coder = tables()

        def work(batch):
            texts = [t or "" for t in strings(batch.column("text"))]
            ids = coder.encode_texts(texts)
            cols = [batch.column("id_"), pa.array([len(b) // 4 for b in ids], type=pa.int64()), pa.array(ids, type=pa.binary())]
            names = ["id_", "n_tokens", "ids"]
            if decoded:
                cols.append(pa.array([coder.decode(b) for b in ids], type=pa.binary()))
                names.append("decoded")
            return pa.RecordBatch.from_arrays(cols, names=names)
        return work

    rows = docs.select(F.col(id_col).alias("id_"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id_"].dataType.simpleString()
    out = map_rows(rows, worker, f"id_ {kind}, n_tokens bigint, ids binary" + ", decoded binary" * decoded)
    return out.withColumnRenamed("id_", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """id, decoded (binary) from packed ids; null ids decode to empty bytes."""
    ranks = share(encoded.sparkSession, load_ranks(ranks_path))

    def run(batches):
        import pyarrow as pa

        names = {n: t for t, n in ranks().items()}
        for batch in batches:
            out = [b"".join(map(names.__getitem__, np.frombuffer(b or b"", dtype="<u4").tolist())) for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id_"), pa.array(out, type=pa.binary())], names=["id_", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id_"), "ids")
    kind = rows.schema["id_"].dataType.simpleString()
    return rows.mapInArrow(run, f"id_ {kind}, decoded binary").withColumnRenamed("id_", id_col)

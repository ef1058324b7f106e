"""Edit-aware token counts: a segment tree of pre-token runs per document.

The tokenizer's pattern cuts a text into pieces, each of which is encoded by itself, so a text's token
count is a sum over pieces. A document's tree has a leaf for every ``LEAF`` pieces with the number of
characters and tokens under it, and sums of both in every inner node. An edit (position, characters
deleted, text inserted) finds its first leaf by descending on the character sums, cuts the text anew from
there until the new cuts meet the end of an old leaf behind the edit, encodes those pieces only, replaces
the leaves in question and updates the sums above them. Everything before and behind keeps its counts.

A cut depends on the text up to one character behind the piece (and on ``MARGIN`` characters at most for
fixed alternatives such as contractions); a cut inside a run of white space depends on what follows the run.
Therefore the region begins with the first leaf that ends at or behind the character before the edit, or with
an earlier one if white space stands before that leaf, and a cut that reaches the end of the text seen so far is made again with more of it.

Defined results: null text counts as empty (0 tokens); edits beyond the end are moved to it, null edit
lists change nothing; a null inserted text is empty; repeated rows are counted each. Extra columns are
ignored.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .bpe import Encoder, load_ranks
from .common import map_rows, share, strings

LEAF = 16
MARGIN = 8


class Sums:
    """Segment tree over leaves: characters and tokens of every node, root at 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = max(1, 1 << (max(1, len(chars)) - 1).bit_length())
        self.chars, self.tokens = ([0] * self.size + list(x) + [0] * (self.size - len(x)) for x in (chars, tokens))
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def first_ending_at(self, pos: int) -> tuple[int, int]:
        """(leaf, its start) of the first leaf whose end is at or behind a character position."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if start + self.chars[node] < pos:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Replace a leaf and update the sums on its path."""
        node = leaf + self.size
        dc, dt = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += dc
            self.tokens[node] += dt
            node //= 2


class TokenTree:
    """Text with its leaves; ``encoded`` counts the pieces that were encoded since the tree was built."""

    def __init__(self, text: str, chars: list[int], tokens: list[int], coder: Encoder, match):
        self.text, self.coder, self.match = text, coder, match
        self.leaves = [[c, t] for c, t in zip(chars, tokens)] or [[0, 0]]
        self.sums = Sums(*zip(*self.leaves))
        self.encoded = 0

    @property
    def n_tokens(self) -> int:
        return self.sums.tokens[1]

    def count(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece. An edit brings a handful of new pieces: too few for matrices, so they run
        the same merges over the heap."""
        cache, coder = self.coder.cache, self.coder
        for p in set(pieces).difference(cache):
            raw = p.encode()
            known = coder.whole.get(raw)
            cache[p] = coder.encode_long(raw) if known is None else known.to_bytes(4, "little")
        return [len(cache[p]) // 4 for p in pieces]

    def edit(self, pos: int, deleted: int, inserted: str) -> None:
        pos = min(max(pos, 0), len(self.text))
        deleted = min(max(deleted, 0), len(self.text) - pos)
        leaf, start = self.sums.first_ending_at(max(0, pos - 1))       # the cut before 're depends on two characters
        # a cut inside white space looks past the run's end: begin before the run
        while leaf and (not self.leaves[leaf - 1][0] or start and self.text[start - 1].isspace()):
            leaf -= 1
            start -= self.leaves[leaf][0]
        new = self.text[:pos] + inserted + self.text[pos + deleted:]
        shift = len(inserted) - deleted
        last, end = leaf, start + self.leaves[leaf][0]         # old coordinates
        while last + 1 < len(self.leaves) and end < pos + deleted:
            last += 1
            end += self.leaves[last][0]
        pieces, at = [], start
        while True:
            whole = last + 1 == len(self.leaves)
            stop = len(new) if whole else end + shift
            while at < stop:                                    # cut up to the end of the old leaf
                seen = len(new) if whole else min(len(new), stop + MARGIN)
                while True:
                    m = self.match(new, at, seen)
                    if m.end() < seen - MARGIN or seen == len(new):
                        break
                    seen = min(len(new), 2 * seen - at + MARGIN)
                pieces.append(m.group())
                at = m.end()
            if at == stop:
                break
            last += 1                                           # the cuts don't meet here: on to the next leaf
            end += self.leaves[last][0]
        counts = self.count(pieces)
        self.encoded += len(pieces)
        fresh = [[sum(map(len, pieces[i:i + LEAF])), sum(counts[i:i + LEAF])] for i in range(0, len(pieces), LEAF)]
        self.text = new
        old = last - leaf + 1
        if len(fresh) <= old:                                   # unused leaves stay with nothing under them
            fresh += [[0, 0]] * (old - len(fresh))
            for i, (c, t) in enumerate(fresh):
                self.leaves[leaf + i] = [c, t]
                self.sums.put(leaf + i, c, t)
        else:                                                   # more leaves: the sums above are laid out anew
            self.leaves[leaf:last + 1] = fresh
            self.sums = Sums(*zip(*self.leaves))


def leaves_of(pieces: list[str], counts: np.ndarray) -> tuple[list[int], list[int]]:
    """Characters and tokens of each leaf."""
    if not pieces:
        return [], []
    start = np.arange(0, len(pieces), LEAF)
    size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    return np.add.reduceat(size, start).tolist(), np.add.reduceat(counts, start).tolist()


def build(coder: Encoder, texts: list[str], match) -> list[TokenTree]:
    """Trees of whole texts; distinct pieces are encoded once."""
    pieces = [coder.split(t) for t in texts]
    coder.learn(set().union(*pieces))
    look = coder.cache.__getitem__
    out = []
    for text, own in zip(texts, pieces):
        counts = np.fromiter(map(len, map(look, own)), dtype=np.int64, count=len(own)) // 4
        out.append(TokenTree(text, *leaves_of(own, counts), coder, match))
    return out


def attach(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """doc_id, text, edits (in order of ``seq``) from a table of edits (doc_id, seq, pos, deleted, inserted)."""
    own = edits.where("doc_id is not null").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "pos", "deleted", "inserted"))).alias("edits_"))
    listed = F.transform("edits_", lambda e: F.struct(e["pos"].cast("long").alias("pos"), e["deleted"].cast("long").alias("deleted"),
                                                      e["inserted"].alias("inserted")))
    return docs.select("doc_id", "text").join(own, "doc_id", "left").select("doc_id", "text", listed.alias("edits"))


def edit_list(*edits: tuple[Column, Column, Column]) -> Column:
    """The ``edits`` column from (position, deleted, inserted) expressions."""
    return F.array(*[F.struct(p.cast("long").alias("pos"), d.cast("long").alias("deleted"), t.alias("inserted")) for p, d, t in edits])


def count_with_edits(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens (before), n_edits, n_tokens_edited (after all edits), n_reencoded
    (pieces encoded for the edits) and edited_text for rows of doc_id, text, edits."""
    tables = share(docs.sparkSession, Encoder(load_ranks(ranks_path), pattern))

    def worker():
        import pyarrow as pa
        import regex

        coder, match = tables(), regex.compile(pattern).match

        def work(batch):
            texts = [t or "" for t in strings(batch.column("text"))]
            rows = []
            for tree, edits in zip(build(coder, texts, match), batch.column("edits").to_pylist()):
                before, edits = tree.n_tokens, edits or []
                for e in edits:
                    tree.edit(e["pos"] or 0, e["deleted"] or 0, e["inserted"] or "")
                rows.append((before, len(edits), tree.n_tokens, tree.encoded, tree.text))
            names = ["n_tokens", "n_edits", "n_tokens_edited", "n_reencoded", "edited_text"]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([batch.column("id_")] + [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)],
                                              names=["id_", *names])
        return work

    rows = docs.select(F.col("doc_id").alias("id_"), F.col("text").cast("string").alias("text"), "edits")
    kind = rows.schema["id_"].dataType.simpleString()
    out = map_rows(rows, worker, f"id_ {kind}, n_tokens bigint, n_edits int, n_tokens_edited bigint, n_reencoded bigint, edited_text string")
    return out.withColumnRenamed("id_", "doc_id")

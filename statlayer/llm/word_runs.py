"""Periodic runs of words by online dyadic square catching.

A square is a stretch of words said twice in a row; squares of one period that overlap merge into a run: the
longest stretch in which words ``period`` apart are identical. ``SquareCatcher`` reads words as they are appended:

* Catchers. Every completed block of B = 1, 2, 4, ... words at a multiple of B is a catcher for squares whose
  period lies in [2B, 4B) (one more level with B = 1 is for period 1). The left half of such a square holds a
  whole block, and the block's copy stands one period behind it.
* Suffix comparisons. An appended word ends one suffix of B words a level. The suffix is compared with the two
  blocks of the level that stand 2B to 4B before it, by 64-bit hashes of windows that double from level to
  level. Words may be appended one at a time or many at once; a call handles all its words level by level in
  numpy, and a level keeps only its last 5B window hashes.
* Squares. Equal comparisons at consecutive blocks and one distance are one stretch. Its ends are found on the
  words themselves, so a hash that happens to be equal makes no run. A stretch that reaches the last word stays
  open and grows with the words that follow.
* Runs. A comparison inside a run already known whose period is at most B can only repeat a multiple of that
  period and is passed over; of stretches with the same ends the smallest period is kept. What is left are the
  maximal runs with their smallest period.

The work is n log n for n words, the memory in proportion to n. Many short documents are appended to one stream
with a mark between them that equals no word; streams hold documents of about one length, which bounds the levels.

Defined results: null, empty and blank texts have no words, no run and an empty collapsed text; repeated rows are
searched each; very long texts are appended in parts of ``PART_WORDS``; runs are listed by start, then period,
which settles ties; an empty table gives an empty table. Other columns stay, unless they have the names of the
results (``n_words``, ``runs``, ``collapsed``), which are replaced.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .common import slices

PART_WORDS = 1 << 18       # words appended at once
STREAM_WORDS = 1 << 17     # short documents are searched together in streams of about so many words
MIX_LEFT, MIX_RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two windows that stand side by side, from theirs."""
    h = left * MIX_LEFT + (right ^ right >> np.uint64(31)) * MIX_RIGHT
    return h ^ h >> np.uint64(29)


def same_until(words: np.ndarray, at: int, period: int, stop: int) -> int:
    """First place from ``at`` on, or ``stop``, whose word differs from the word ``period`` before it."""
    step = 32
    while at < stop:
        end = min(stop, at + step)
        bad = np.flatnonzero(words[at:end] != words[at - period:end - period])
        if len(bad):
            return at + int(bad[0])
        at, step = end, step * 2
    return stop


def same_from(words: np.ndarray, at: int, period: int) -> int:
    """Smallest place from which on, up to ``at``, all words equal the word ``period`` behind them."""
    step = 32
    while at > 0:
        start = max(0, at - step)
        bad = np.flatnonzero(words[start:at] != words[start + period:at + period])
        if len(bad):
            return start + int(bad[-1]) + 1
        at, step = start, step * 2
    return 0


class Level:
    """The catchers of one block size: the window hashes that can still be compared."""

    def __init__(self, size: int, first: int, last: int):
        self.size, self.first, self.last = size, first, last      # periods [first, last)
        self.hashes, self.at = np.empty(0, dtype=np.uint64), 0    # of windows starting at ``at``, ``at`` + 1, ...

    def add(self, hashes: np.ndarray) -> None:
        """Hashes of the windows that the appended words complete; too old ones go."""
        keep = self.at + max(0, len(self.hashes) - 5 * self.size)
        self.hashes, self.at = np.concatenate([self.hashes[keep - self.at:], hashes]), keep

    def catch(self, start: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, periods) of the windows from ``start`` on that equal a block of this level."""
        places, size = np.arange(start, self.at + len(self.hashes), dtype=np.int64), self.size
        found = []
        for back in range(self.first // size, self.last // size):
            block = (places // size - back) * size
            own = block >= 0
            x, block = places[own], block[own]
            hit = self.hashes[x - self.at] == self.hashes[block - self.at]
            found.append((x[hit], x[hit] - block[hit]))
        return np.concatenate([x for x, _ in found]), np.concatenate([p for _, p in found])


class SquareCatcher:
    """Runs of an integer sequence that is appended to; ``least`` periods long at least (2: all squares)."""

    def __init__(self, least: int = 2, longest: int | None = None):
        self.least, self.longest = least, longest                  # longest: no period above it
        self.words, self.n = np.empty(1024, dtype=np.int64), 0
        self.levels = [Level(1, 1, 2), Level(1, 2, 4)]
        self.open: dict[int, tuple[int, int]] = {}                 # period -> (start, end) of a stretch at the last word
        self.closed: dict[tuple[int, int], int] = {}               # (start, end) -> period

    def append(self, words: np.ndarray) -> None:
        """Read further words."""
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            self.words = np.concatenate([self.words[:old], np.empty(max(self.n, 2 * old) - old, dtype=np.int64)])
        self.words[old:self.n] = words
        text = self.words[:self.n]
        grown = []
        for period, (start, end) in list(self.open.items()):
            end = same_until(text, end, period, self.n)
            self.settle(period, start, end)
            if end - start >= self.least * period:
                grown.append((period, start, end))
        reach = np.zeros(self.n, dtype=np.int64)                   # how far runs known by now cover from a place on
        known, below = [], None
        for k in range(64):
            if k == len(self.levels):
                size = self.levels[-1].size * 2
                if size > self.n:
                    break
                self.levels.append(Level(size, 2 * size, 4 * size))
            level = self.levels[k]
            if self.longest is not None and level.first > self.longest:
                break
            size = level.size
            # windows of this size that the appended words complete
            start = level.at + len(level.hashes)
            if size == 1:
                h = text[start:].astype(np.uint64)
                fresh = joined(h, h)
            else:
                lower = below.hashes[start - below.at:]
                fresh = joined(lower[:-(size // 2)], lower[size // 2:]) if len(lower) > size // 2 else lower[:0]
            level.add(fresh)
            places, periods = level.catch(start)
            free = reach[places - periods] < places + size
            found = [(s, e) for p, s, e in grown if level.first <= p < level.last]
            if free.any():
                found += self.caught(text, level, places[free], periods[free])
            # the next level passes over what runs of the levels before this one cover: their periods are at most its size
            if known:
                for s, e in known:
                    reach[s] = max(reach[s], e)
                np.maximum.accumulate(reach, out=reach)
            known, below = found, level

    def caught(self, text: np.ndarray, level: Level, places: np.ndarray, periods: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of the comparisons that were equal; returns the bounds of those that are runs."""
        runs, size = [], level.size
        order = np.lexsort((places, periods))
        places, periods = places[order], periods[order]
        new = np.concatenate([[True], (np.diff(periods) != 0) | (np.diff(places) != size)])
        first, last = places[new], places[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(places) - 1]])]
        # a run of ``least`` periods holds at least so many whole blocks; at the last word more may follow
        whole = (last - first) // size + 1 >= ((self.least - 1) * level.first - size + 1) // size
        spans = zip(*(x[whole | (last + 2 * size > self.n)].tolist() for x in (periods[new], first, last)))
        for p, a, b in ((p, *ends) for p, a, b in spans for ends in self.checked(text, p, a, b, size)):
            if p in self.open and self.open[p][0] <= a - p:
                continue
            start, end = same_from(text, a - p, p), same_until(text, b + size, p, self.n)
            self.settle(p, start, end)
            if end - start >= self.least * p:
                runs.append((start, end))
        return runs

    @staticmethod
    def checked(text: np.ndarray, p: int, a: int, b: int, size: int) -> list[tuple[int, int]]:
        """The stretch of windows a to b, or those of its windows that are equal by their words, not only by hash."""
        if same_until(text, a, p, b + size) == b + size:
            return [(a, b)]
        return [(x, x) for x in range(a, b + 1, size) if same_until(text, x, p, x + size) == x + size]

    def settle(self, period: int, start: int, end: int) -> None:
        """Note a stretch: open if it reaches the last word, else a run if it is long enough."""
        self.open.pop(period, None)
        if end == self.n:
            self.open[period] = (start, end)
        elif end - start >= self.least * period:
            key = (start, end)
            self.closed[key] = min(period, self.closed.get(key, period))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs so far, by start, then period."""
        found = dict(self.closed)
        for p, (s, e) in self.open.items():
            if e - s >= self.least * p:
                found[s, e] = min(p, found.get((s, e), p))
        return sorted((s, e - s, p) for (s, e), p in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when every run is cut to its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


class Searcher:
    """Runs of a task's texts (bytes or None)."""

    def __init__(self, periods: int, words: int):
        self.periods, self.least_words = periods, words

    def search(self, texts: list[bytes | None]) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
        """(words, runs) of each text."""
        split = [(t or b"").split() for t in texts]
        names: dict[bytes, int] = {}
        ids = [np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int64, count=len(words)) for words in split]
        out: list[list] = [[] for _ in texts]
        by_length: dict[int, list[int]] = {}
        for i, own in enumerate(ids):
            if len(own) >= max(2, self.least_words):
                by_length.setdefault(len(own).bit_length(), []).append(i)
        for length, members in by_length.items():
            stream, size = [], 0
            for i in members:
                stream.append(i)
                size += len(ids[i]) + 1
                if size >= STREAM_WORDS:
                    self.stream(ids, stream, out, 1 << length)
                    stream, size = [], 0
            if stream:
                self.stream(ids, stream, out, 1 << length)
        return list(zip(split, out))

    def stream(self, ids: list[np.ndarray], members: list[int], out: list[list], longest: int) -> None:
        """Search some texts as one stream, a mark of its own behind each."""
        catcher, starts, at = SquareCatcher(self.periods, longest // self.periods), [], 0
        parts = []
        for k, i in enumerate(members):
            starts.append(at)
            parts += [ids[i], np.array([-1 - k])]
            at += len(ids[i]) + 1
        whole = np.concatenate(parts)
        for a in range(0, len(whole), PART_WORDS):
            catcher.append(whole[a:a + PART_WORDS])
        for start, length, period in catcher.runs():
            if length >= self.least_words:
                k = int(np.searchsorted(starts, start, side="right")) - 1
                out[members[k]].append((start - starts[k], length, period))


def find_runs(docs: DataFrame, periods: int = 4, words: int = 6, text: str = "text") -> DataFrame:
    """All columns, and n_words, runs (array of start, length, period, by start and period) of at least ``periods``
    periods and ``words`` words, collapsed (the text's words joined by one space, every run cut to its first period)."""
    names = [c for c in docs.columns if c.lower() not in ("n_words", "runs", "collapsed")]
    source = docs.select(*[docs[f"`{c}`"] for c in names], docs[f"`{text}`"].cast("string").cast("binary").alias("_".join(names) + "_"))
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                                                             T.StructField("collapsed", T.StringType())])

    def run(batches):
        import pyarrow as pa

        searcher = Searcher(periods, words)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=[str(i) for i in range(batch.num_columns)])
            for part in slices(batch, str(len(names))):
                n, runs, kept = [], [], []
                for own, found in searcher.search(part.column(len(names)).to_pylist()):
                    n.append(len(own))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    kept.append(b" ".join([w for w, k in zip(own, kept_words(len(own), found).tolist()) if k] if found else own))
                made = [pa.array(n, type=pa.int64()), pa.array(runs, type=kind), pa.array(kept, type=pa.binary()).cast(pa.string(), safe=False)]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], *made], names=schema.names)

    return source.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period (ties: smallest start, then period); null without runs."""
    def better(best, r):
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def run_lines(runs: Column) -> Column:
    """Every run as a line ``start,length,period``, by start, then period."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")

"""Language ID: a bidirectional gated recurrent network over bytes, trained here in numpy.

A text is cut at white space; each token, lower-cased, is a byte sequence (longer ones in windows of
``WINDOW`` bytes). The network reads a sequence in both directions, labels EVERY byte position with a
distribution over the learned languages, and a document's probabilities are the mean over all positions
of the whole text. Equal tokens have equal labels, so a task runs each distinct token of a slice once and
weighs it by its occurrences: the result is that of labelling every position.

Training is backpropagation through time with Adam on a bounded sample: about ``SAMPLE_DOCS`` documents a
language (by a hash of the id, no shuffle) and ``SAMPLE_TOKENS`` tokens of each.

Defined results: null text or text without a letter -> ``und`` with score 0; if nothing could be learned
every text is ``und``; repeated rows are labelled each; null lang or id trains nothing. Extra columns are
ignored (``predict``) or kept as they are (``keep_known``).
"""
from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import fold, keep_rows, map_rows, share, strings

WINDOW = 24
HIDDEN = 16
SAMPLE_DOCS, SAMPLE_TOKENS = 300, 60
EPOCHS, BATCH, RATE = 4, 256, 0.01
CACHE_TOKENS = 120_000
ROWS_AT_ONCE = 2048
UNKNOWN = "und"
KEEP_SCORE = 0.4               # the pipeline keeps a document whose best language reaches this


def windows(token: str) -> list[bytes]:
    """The byte sequences of a token."""
    raw = token.encode("utf-8", "replace")
    return [raw] if len(raw) <= WINDOW else [raw[i:i + WINDOW] for i in range(0, len(raw), WINDOW)]


class BiGru:
    """Parameters per direction: byte table [256, 3H] (update, reset, candidate), state matrix [H, 3H]."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, self.h = langs, hidden
        g = 3 * hidden
        self.p = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (256, g)).astype(np.float32)
            self.p["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, g)).astype(np.float32)
        self.p["o"] = rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32)
        self.p["c"] = np.zeros(len(langs), dtype=np.float32)

    def _run(self, x, d, keep=None):
        """States of one direction over time-major bytes [T, n]; ``keep`` collects what the way back needs."""
        h, wx, u = self.h, self.p["x" + d], self.p["u" + d]
        steps, n = x.shape
        out = np.empty((steps, n, h), dtype=np.float32)
        s = np.zeros((n, h), dtype=np.float32)
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            a = wx[x[t]]
            zr = s @ u[:, :2 * h]
            zr += a[:, :2 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)                # the logistic curve by tanh
            zr += 1
            zr *= 0.5
            z, r = zr[:, :h], zr[:, h:]
            v = s @ u[:, 2 * h:]
            c = r * v
            c += a[:, 2 * h:]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((t, s, z, r, v, c))
            s = c + z * (s - c)
            out[t] = s
        return out

    def labels(self, x):
        """Probabilities [T, n, languages] of every position."""
        e = self._run(x, "f") @ self.p["o"][:self.h]
        e += self._run(x, "b") @ self.p["o"][self.h:]
        e += self.p["c"]
        e -= e.max(axis=2, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(axis=2, keepdims=True)
        return e

    def sums(self, sequences: list[bytes]) -> np.ndarray:
        """Position probabilities summed over each sequence [n, languages]."""
        out = np.zeros((len(sequences), len(self.langs)), dtype=np.float32)
        lens = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
        order = np.argsort(lens, kind="stable")
        at = np.searchsorted(lens[order], 1)
        while at < len(order):
            size = lens[order[at]]
            end = min(np.searchsorted(lens[order], size, side="right"), at + ROWS_AT_ONCE)
            rows = order[at:end]
            x = np.frombuffer(b"".join([sequences[i] for i in rows]), dtype=np.uint8).reshape(len(rows), size).T
            out[rows] = self.labels(x).sum(axis=0)
            at = end
        return out

    def gradient(self, x, y):
        """Cross-entropy gradient, mean over all positions of a batch of equal length (x [T, n], y [n])."""
        h, steps, n = self.h, *x.shape
        keep = {"f": [], "b": []}
        hs = {d: self._run(x, d, keep[d]) for d in "fb"}
        both = np.concatenate([hs["f"], hs["b"]], axis=2)
        e = both @ self.p["o"] + self.p["c"]
        e -= e.max(axis=2, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(axis=2, keepdims=True)
        loss = -np.log(np.maximum(e[:, np.arange(n), y], 1e-9)).mean()
        e[:, np.arange(n), y] -= 1
        e /= steps * n
        grad = {"o": both.reshape(-1, 2 * h).T @ e.reshape(-1, e.shape[2]), "c": e.sum(axis=(0, 1))}
        back = e @ self.p["o"].T
        for k, d in enumerate("fb"):
            u = self.p["u" + d]
            gx, gu = np.zeros_like(self.p["x" + d]), np.zeros_like(u)
            ds = np.zeros((n, h), dtype=np.float32)
            for t, s, z, r, v, c in reversed(keep[d]):     # s: state before the step
                ds = ds + back[t][:, k * h:(k + 1) * h]
                dc = ds * (1 - z) * (1 - c * c)
                dz = ds * (s - c) * z * (1 - z)
                dr = dc * v * r * (1 - r)
                da = np.concatenate([dz, dr, dc], axis=1)  # at the byte table
                du = np.concatenate([dz, dr, dc * r], axis=1)
                np.add.at(gx, x[t], da)
                gu += s.T @ du
                ds = ds * z + du @ u.T
            grad["x" + d], grad["u" + d] = gx, gu
        return loss, grad

    def fit(self, tokens: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> list[float]:
        """Adam over batches of tokens of one length; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        lens = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            order = rng.permutation(len(tokens))
            order = order[np.argsort(lens[order], kind="stable")]
            cuts = np.flatnonzero(np.diff(lens[order])) + 1
            batches = [g[i:i + BATCH] for g in np.split(order, cuts) for i in range(0, len(g), BATCH)]
            rate, total = RATE * (1 - epoch / epochs) + 1e-3, 0.0
            for b in rng.permutation(len(batches)):
                rows = batches[b]
                x = np.frombuffer(b"".join([tokens[i] for i in rows]), dtype=np.uint8).reshape(len(rows), -1).T
                loss, grad = self.gradient(x, y[rows])
                total += loss * len(rows)
                step += 1
                for k, g in grad.items():
                    m[k] += 0.1 * (g - m[k])
                    v2[k] += 0.001 * (g * g - v2[k])
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
            losses.append(total / max(1, len(tokens)))
        return losses


def training_tokens(docs: DataFrame, holdout: tuple[int, int] = (3, 1)) -> tuple[list[bytes], list[str]]:
    """Tokens with their language from a bounded, hash-chosen sample outside the held-out fold."""
    parts, held = holdout
    rows = docs.select(F.col("doc_id").alias("id_"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")) \
        .where("id_ is not null and lang is not null and text is not null").where(fold(F.col("id_"), parts) != held)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    scale = 1 << 30
    quota = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(scale * min(1.0, SAMPLE_DOCS / n))))])
    chosen = rows.where(F.pmod(F.xxhash64("id_"), F.lit(scale)) < F.element_at(quota, F.col("lang")))

    def pick(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for i, text in zip(batch.column("id_").to_pylist(), strings(batch.column("text"))):
                tokens = text.lower().split()
                rng = np.random.default_rng(zlib.crc32(str(i).encode()))
                at = rng.integers(0, len(tokens), SAMPLE_TOKENS) if tokens else []
                found.append([w for k in at for w in windows(tokens[k])[:4]])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, type=pa.list_(pa.binary()))], names=["lang", "tokens"])

    got = chosen.select("lang", "id_", "text").mapInArrow(pick, "lang string, tokens array<binary>").collect()
    tokens = sorted((bytes(t), r["lang"]) for r in got for t in r["tokens"])    # one order, however tasks finish
    return [t for t, _ in tokens], [lang for _, lang in tokens]


def train(docs: DataFrame, holdout: tuple[int, int] = (3, 1)) -> BiGru:
    """Fit the network on the sample of training rows."""
    tokens, langs = training_tokens(docs, holdout)
    names = sorted(set(langs))
    net = BiGru(names)
    if tokens:
        number = {k: i for i, k in enumerate(names)}
        net.fit(tokens, np.array([number[k] for k in langs]))
    return net


class Labeller:
    """Document probabilities with a memory of token sums."""

    def __init__(self, net: BiGru):
        self.net, self.cache, self.table = net, {}, np.zeros((0, len(net.langs) + 1), dtype=np.float32)

    def learn(self, tokens: set[str]) -> None:
        new = list(tokens.difference(self.cache))
        if len(self.cache) + len(new) > CACHE_TOKENS:
            self.cache, self.table, new = {}, self.table[:0], list(tokens)
        pieces = [windows(t) for t in new]
        flat = [b for p in pieces for b in p]
        if not flat:
            return
        sums = self.net.sums(flat)
        starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
        size = np.fromiter((sum(map(len, p)) for p in pieces), dtype=np.float32, count=len(pieces))
        rows = np.c_[np.add.reduceat(sums, starts, axis=0), size].astype(np.float32)
        first = len(self.table)
        self.table = np.concatenate([self.table, rows])
        self.cache.update(zip(new, range(first, first + len(new))))

    def documents(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, probability) of each text."""
        net = self.net
        tokens = [t.lower().split() if t and net.langs else [] for t in texts]
        self.learn(set().union(*tokens))
        look, out = self.cache.__getitem__, []
        for text, own in zip(texts, tokens):
            if not own or not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0))
                continue
            total = self.table[np.fromiter(map(look, own), dtype=np.int64, count=len(own))].sum(axis=0, dtype=np.float64)
            best = int(total[:-1].argmax())
            out.append((net.langs[best], float(min(1.0, total[best] / total[-1]))))
        return out


def predict(docs: DataFrame, net: BiGru) -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    shipped = share(docs.sparkSession, net)

    def worker():
        import pyarrow as pa

        labeller = Labeller(shipped())

        def work(batch):
            found = labeller.documents(strings(batch.column("text")))
            return pa.RecordBatch.from_arrays(
                [batch.column("id_"), pa.array([x for x, _ in found], type=pa.string()), pa.array([p for _, p in found], type=pa.float64())],
                names=["id_", "lang_pred", "score"])
        return work

    rows = docs.select(F.col("doc_id").alias("id_"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["id_"].dataType.simpleString()
    return map_rows(rows, worker, f"id_ {kind}, lang_pred string, score double").withColumnRenamed("id_", "doc_id")


def keep_known(docs: DataFrame, net: BiGru, least: float = KEEP_SCORE) -> DataFrame:
    """Rows in a learned language with at least that score, all columns as they are."""
    shipped = share(docs.sparkSession, net)

    def judge():
        labeller = Labeller(shipped())
        return lambda text: [lang != UNKNOWN and p >= least for lang, p in labeller.documents(strings(text))]

    return keep_rows(docs, judge, "text")

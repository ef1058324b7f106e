"""Mixing against a plain computation of targets, packing and permutations."""
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlayer.llm import mixing
from statlayer.llm.queries import REGISTRY

from .conftest import SF, prose


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Share out by weight, stop at the limits, share the excess out again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, free = dict.fromkeys(order, 0.0), [s for s in order]
    rest = share * sum(sizes.values())
    while free and rest > 1e-9:
        whole = sum(weight[s] for s in free)
        for s in free:
            got[s] += rest * weight[s] / whole
        rest = sum(max(0.0, got[s] - repeats * sizes[s]) for s in free)
        for s in free:
            got[s] = min(got[s], repeats * sizes[s])
        free = [s for s in free if got[s] < repeats * sizes[s]]
    return got


def check(docs, mix):
    """Contract, targets and the mix's texts, from the rows (doc_id, text, source)."""
    rows = mix.taken().collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _, _ in docs)
    sizes, source_of = defaultdict(int), {}
    for i, text, source in docs:
        sizes[source] += len(words_of(text))
    want = plain_targets(sizes)
    taken = defaultdict(int)
    by_id = defaultdict(list)
    for i, text, source in docs:
        by_id[i].append((len(words_of(text)), source))
    for r in rows:
        assert any(r["size"] == n and r["source_size"] == sizes[s] and np.isclose(r["target"], want[s]) for n, s in by_id[r["doc_id"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
    spans = mix.spans().join(mix.packed.select("row", "source_no"), "row").groupBy("source_no").agg(F.sum("n_words").alias("n")).collect()
    target = {r["source_no"]: r["target"] for r in mix.sources.collect()}
    for r in spans:
        taken[r["source_no"]] = r["n"]
    assert all(taken[no] == round(t) for no, t in target.items())
    return rows


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_and_its_inverse(size):
    for key in (0, 5, 2**63 + 11):
        p = mixing.permuted(np.arange(size), size, np.uint64(key))
        assert sorted(p.tolist()) == list(range(size))
        assert mixing.permuted(p, size, np.uint64(key), back=True).tolist() == list(range(size))
    sizes = np.array([size, 10, size])
    assert mixing.permuted(np.zeros(3), sizes, np.full(3, 9))[0] == mixing.permuted([0], size, 9)[0]


@pytest.mark.parametrize("block, slots, groups", [(512, 1024, 1024), (16, 8, 1024), (5, 32, 2)])
def test_mix_meets_its_targets(spark, rng, monkeypatch, block, slots, groups):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", slots)
    monkeypatch.setattr(mixing, "GROUPS", groups)
    names = ["web", "web", "web", "Books", "code", "ärgern", "z", None]
    docs = [(i, prose(rng, rng.choice([0, 1, 5, 40, 90])) if i % 11 else None, rng.choice(names)) for i in range(300)]
    docs += [(1, "x " * 700, "one"), (2, "", "nothing"), (2, "few words", "few"), (2, "few words", "few"), (None, "no id here", "web")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    mix = mixing.mix(frame)
    rows = check(docs, mix)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(frame.repartition(5)).taken().collect()))
    # slots are numbered without gaps, a slot's text are its block's words, and no block is said more than twice
    arranged = mix.slots.collect()
    total = len(arranged)
    assert {(r["shard"], r["slot"]) for r in arranged} == {(k // slots, k % slots) for k in range(total)}
    assert max(Counter((r["source_no"], r["block"]) for r in arranged).values()) <= 2
    said = {(r["shard"], r["slot"]): r["text"].split(" ") for r in mix.texts(frame).collect()}
    assert all(len(said[r["shard"], r["slot"]]) == r["words"] <= block for r in arranged)
    numbers = {r["source"]: r["source_no"] for r in mix.sources.collect()}
    whole = defaultdict(Counter)
    for r in arranged:
        whole[r["source_no"]].update(said[r["shard"], r["slot"]])
    for source, no in numbers.items():
        have = Counter(w for _, t, s in docs if s == source for w in words_of(t))
        assert all(n <= 2 * have[w] for w, n in whole[no].items())


def test_draws_are_multinomial(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 100)
    frame = spark.createDataFrame([(0, 6000), (1, 3000), (2, 1000)], "source_no long, n_slots long")
    for groups in (2, 1024):
        monkeypatch.setattr(mixing, "GROUPS", groups)
        rows = mixing.drawn(frame, 10_000, 3).collect()
        shards, first = Counter(), []
        for r in rows:
            shards[r["shard"]] += r["draws"]
            if r["source_no"] == 0:
                first.append(r["draws"])
        assert set(shards.values()) == {100} and len(shards) == 100
        assert abs(np.mean(first) - 60) < 2 and 15 < np.var(first) < 40           # 100 * 0.6 * 0.4 = 24


def test_empty_tables_and_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "even"))
    check([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], mixing.mix(docs))
    assert mixing.mix(docs.where("false")).taken().count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "  ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.mix(blank).taken().collect()] == [(0, 0, 0.0, 0)] * 2


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    mix = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = check(docs, mix)
    assert sorted(rows) == sorted(REGISTRY["op11_source_mix"][0](spark, SF).collect())

"""Periodic runs against brute force, and the registered query against a plain computation of its contract."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from statlayer.llm import word_runs
from statlayer.llm.queries import REGISTRY

from .conftest import SF


def plain_runs(words, periods, least):
    """Maximal stretches by their definition, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, periods * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(rng, n):
    letters = rng.choice([1, 2, 3, 5])
    words = [rng.randint(0, letters) for _ in range(rng.randint(0, n))]
    for _ in range(rng.randint(0, 3)):
        block = [rng.randint(0, letters) for _ in range(rng.randint(1, 14))]
        many = block * rng.randint(2, 8)
        at = rng.randint(0, len(words))
        words[at:at] = many[:len(many) - rng.randint(0, len(block) - 1)]
    return words


@pytest.mark.parametrize("way", ["one word at a time", "in parts", "at once"])
def test_catcher_finds_the_runs_however_words_are_appended(way):
    rng = random.Random(5)
    for _ in range(250):
        words, periods = repetitive(rng, 80), rng.choice([2, 3, 4])
        catcher, own, at = word_runs.SquareCatcher(periods), np.array(words, dtype=np.int64), 0
        while at < len(own):
            step = {"one word at a time": 1, "in parts": rng.randint(1, 20), "at once": len(own)}[way]
            catcher.append(own[at:at + step])
            at += step
            if way == "in parts":
                assert catcher.runs() == plain_runs(words[:at], periods, 0)
        assert catcher.runs() == plain_runs(words, periods, 0)


def test_equal_hashes_make_no_run(monkeypatch):
    monkeypatch.setattr(word_runs, "joined", lambda left, right: (left + right) % np.uint64(7))
    rng = random.Random(6)
    for _ in range(60):
        words = repetitive(rng, 60)
        catcher = word_runs.SquareCatcher(2)
        catcher.append(np.array(words, dtype=np.int64))
        got, want = set(catcher.runs()), set(plain_runs(words, 2, 0))
        assert got <= want


def test_many_documents_in_one_stream(monkeypatch):
    monkeypatch.setattr(word_runs, "STREAM_WORDS", 200)
    monkeypatch.setattr(word_runs, "PART_WORDS", 64)
    rng = random.Random(8)
    texts = [repetitive(rng, rng.choice([0, 3, 40, 300])) for _ in range(300)]
    got = word_runs.Searcher(4, 6).search([" ".join(map(str, t)).encode() for t in texts])
    assert [r for _, r in got] == [plain_runs(t, 4, 6) for t in texts]


def test_long_texts_stay_fast_and_small():
    found = word_runs.Searcher(4, 6).search([b"a " * 400_000, b"a b c " * 100_000, b" ".join(b"%d" % i for i in range(300_000))])
    assert [r for _, r in found] == [[(0, 400_000, 1)], [(0, 300_000, 3)], []]


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    rows = word_runs.find_runs(odd_docs.withColumnRenamed("rep", "runs")).collect()
    assert len(rows) == odd_docs.count() and all(r["n_words"] == len((r["text"] or "").encode().split()) for r in rows)
    assert [(r["n_words"], r["runs"], r["collapsed"]) for r in rows if r["doc_id"] in (2, 3, 4)] == [(0, [], "")] * 3
    assert word_runs.find_runs(no_docs).count() == 0
    got = word_runs.find_runs(spark.createDataFrame([(1, "x  la la la\tla la la la y")], "id int, body string"), text="body").first()
    assert [tuple(r) for r in got["runs"]] == [(1, 7, 1)] and got["collapsed"] == "x la y"


def test_query_against_its_contract(spark):
    got = {r["doc_id"]: r for r in REGISTRY["op12_word_runs"][0](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    seen = 0
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000 and h % 10:
            continue                                   # brute force is quadratic
        runs = plain_runs(words, 4, 6)
        drop = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (best[1] * 1000 // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest()
        seen += bool(runs)
    assert seen > 5

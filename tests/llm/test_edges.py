"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""
import pytest

from statlayer.llm import ann_search, bpe, decontaminate, langid, license_scan, near_dup, quality_rules, token_tree, toxicity, url_rules
from statlayer.llm.queries import three_edits, tokenizer


@pytest.fixture(params=["odd", "none"])
def docs(request, odd_docs, no_docs):
    return odd_docs if request.param == "odd" else no_docs


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "a sentence of the benchmark that nobody should ever train on, long enough"), (2, None), (None, "x"), (3, "")],
                                 "item_id long, text string")


def test_bpe(docs):
    rows = bpe.encode(docs, *tokenizer(), decoded=True).collect()
    assert len(rows) == docs.count()
    assert sorted(bytes(r["decoded"]) for r in rows) == sorted((r["text"] or "").encode() for r in docs.collect())
    back = bpe.decode(bpe.encode(docs, *tokenizer()), tokenizer()[0])
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in docs.collect())


def test_language(docs):
    net = langid.train(docs)
    rows = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(docs, net).collect()}
    assert {x for i, x in rows if i in (2, 3, 4, 5)} <= {"und"}
    kept = langid.keep_known(docs, net, 0.0)
    assert kept.columns == docs.columns
    if docs.count():
        assert {r["doc_id"] for r in kept.collect()} == {0, 1, 6, 7, 8, 9, 10, None}


def test_toxicity(docs, labels):
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.keep_clean(docs, model, 1.1).count() == docs.count()
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_toxicity_without_labels(docs, labels):
    model = toxicity.train(docs, labels.where("false"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} <= {0.0}


def test_quality(docs, labels):
    model = quality_rules.train(docs, labels)
    rows = quality_rules.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = quality_rules.train(docs, labels.where("false"))
    assert {r["score"] for r in quality_rules.score(docs, none).collect()} <= {0.5}


def test_near_duplicates(docs):
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    if rows:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None}
        assert got[0][1:] == (0, True) and got[1][1:] == (0, False) and got[10][1:] == (0, False)
        assert got[2] == (0, 2, True) and got[3] == (0, 3, True) and got[4] == (0, 4, True) and got[9] == (1, 9, True)
        assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2
    kept = near_dup.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    if rows:
        assert sorted(ids, key=str) == sorted([0, 2, 3, 4, 5, 6, 7, 8, 9, None, None], key=str)


def test_decontamination(docs, benchmark):
    assert decontaminate.leaks(docs, benchmark).count() == 0
    assert decontaminate.keep_unleaked(docs, benchmark).count() == docs.count()
    assert decontaminate.leaks(docs, benchmark.where("false")).count() == 0


def test_token_tree(docs):
    rows = token_tree.count_with_edits(docs.withColumn("edits", three_edits()), *tokenizer()).collect()
    assert len(rows) == docs.count()
    plain = {r["doc_id"]: r["n_tokens"] for r in bpe.encode(docs, *tokenizer()).collect()}
    assert all(plain[r["doc_id"]] == r["n_tokens"] for r in rows if r["doc_id"] is not None)


def test_license(docs):
    found = license_scan.scan(docs, license_scan.train(docs))
    assert found.where("confirmed").count() == 0


def test_urls(spark):
    urls = ["HTTP://WWW.Example.ORG/es/x?y", "http://example.org", "no address", None, "", "://", "http://a.com/fr/" + "b" * 50_000, "http://x.org/de\n/y"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string, verdict string")
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.url_verdicts(pages).collect()}
    assert rows[0] == rows[8] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert rows[1] == ("example.org", "", None, "allow")
    assert rows[2] == rows[3] == rows[4] == rows[5] == ("", "", None, "allow")
    assert rows[6][2:] == ("com/fr/", "allow") and rows[7][:3] == ("x.org", "/de\n/y", "org/")
    assert url_rules.url_verdicts(pages.where("false")).count() == 0


def test_url_rules_in_several_sets(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    key = lambda: sorted(map(str, url_rules.url_verdicts(pages).collect()))
    one = key()
    monkeypatch.setattr(url_rules, "RULES_AT_ONCE", 3)
    assert key() == one
    assert {r["verdict"] for r in url_rules.url_verdicts(pages, rules=()).collect()} == {"allow"}


def test_search(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (20, [1.0, 0.0]),
            (20, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [-3.0, 1.0]), (9, [1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame([(i, v, "q", 1.0) for i, v in rows], "vec_id long, embedding array<float>, query_id string, score double")
    got = {}
    for r in ann_search.nearest(table).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [0, 20]
    assert sorted(got[0])[:3] == [(1, 7, 1.0), (2, 20, 1.0), (3, 1, 0.5)] and sorted(got[20])[:2] == [(1, 0, 1.0), (2, 7, 1.0)]
    assert ann_search.nearest(table.where("false")).count() == 0

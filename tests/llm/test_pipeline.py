"""The corpus pipeline against a plain composition of its decisions."""
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from statlayer.llm import langid
from statlayer.llm.queries import REGISTRY

from .conftest import SF
from .test_against_plain import jaccard_components


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        sizes.append(docs.count())
        assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "near_duplicates":
            want = jaccard_components({r["doc_id"]: r["text"] for r in before.collect()})
            assert {r["doc_id"] for r in docs.collect()} == {i for i, (_, c) in want.items() if i == c}
    assert sizes[0] > sizes[3] > sizes[4] > 0.5 * sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    sums = docs.select("doc_id", F.sha2("text", 256).alias("text_sha256")).join(last, "doc_id")
    assert sums.count() == docs.count() and sums.where("decoded_sha256 <> text_sha256").count() == 0


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_registered_queries_run(spark):
    want = {"op1": {"query_id", "rank", "vec_id", "score"}, "op3": {"page_id", "host", "path", "rule", "verdict"},
            "op5": {"doc_id", "n_shingles", "component_id", "kept"}, "op7": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
            "op6": {"doc_id", "held_out", "score", "predicted"}, "op8": {"doc_id", "held_out", "score", "predicted"},
            "op10": {"doc_id", "held_out", "lang_pred", "score"},
            "op11": {"doc_id", "size", "source_size", "target", "taken"},
            "op12": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
            "op13": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}}
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{n}" for n in range(1, 14)}
    for name, (query, _) in REGISTRY.items():
        df = query(spark, SF)
        assert want.get(name.split("_")[0], set()) <= set(df.columns)
        if name.startswith(("op6", "op8", "op10")):
            parts, held = {"op6": (4, 2)}.get(name.split("_")[0], (3, 1))
            rows = df.collect()
            assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
            assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == held) for r in rows)


def test_sql_twins(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, (query, sql) in REGISTRY.items():
        if sql:
            want = con.execute(sql).df()
            got = query(spark, SF).toPandas()[list(want.columns)]
            key = list(want.columns)[0]
            a, b = (x.sort_values(key).reset_index(drop=True).astype(object).where(lambda d: d.notna(), None) for x in (want, got))
            assert a.equals(b), name


def test_language_score_is_the_mean_over_positions():
    net = langid.BiGru(["a", "b"])
    labeller = langid.Labeller(net)
    (lang, score), = labeller.documents(["two words Two"])
    sums = net.sums([b"two", b"words", b"two"]).sum(axis=0) / 11
    assert lang == net.langs[int(sums.argmax())] and np.isclose(score, sums.max(), atol=1e-5)

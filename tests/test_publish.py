"""Publishing: partial loads, old run ids, repeated keys, failed runs."""
import pytest

from statlayer.errors import PublishError
from statlayer.publish import warehouse as W


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k int, v string")


def got(spark, base, name):
    return sorted((r.k, r.v) for r in W.read_current(spark, base, name).collect())


def test_partial_loads_carry_other_tables_forward(spark, tmp_path):
    base = str(tmp_path)
    W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (1, "x")), ["k"]), W.TableLoad("b", rows(spark, (1, "y")), ["k"], "dimension")], batch_id="2")
    W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (2, "z")), ["k"])], batch_id="3")
    W.load_warehouse(spark, base, [W.TableLoad("c", rows(spark, (9, "new")), ["k"])], batch_id="4")
    assert got(spark, base, "a") == [(2, "z")] and got(spark, base, "b") == [(1, "y")] and got(spark, base, "c") == [(9, "new")]
    assert W.read_current(spark, base, "d") is None
    assert {r.batch_id for r in W.read_current(spark, base, "b").collect()} == {"2"}


def test_a_stream_batch_does_not_hide_later_runs(spark, tmp_path):
    base = str(tmp_path)
    for batch, v in (("stream0000000001", "s"), ("20260101T000000Z", "run"), ("20250101T000000Z", "older run again")):
        W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (1, v)), ["k"])], batch_id=batch)
        assert got(spark, base, "a") == [(1, v)] and W.current_batch(spark, base) == batch


def test_rerun_of_one_batch_id(spark, tmp_path):
    base = str(tmp_path)
    for v in ("one", "two"):
        W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (1, v), (2, v)), ["k"], "dimension")], batch_id="same")
    W.load_warehouse(spark, base, [W.TableLoad("b", rows(spark, (1, "b")), ["k"])], batch_id="same")
    assert got(spark, base, "a") == [(1, "two"), (2, "two")]
    assert sorted((r.table_name, r.rows_upserted) for r in W.read_audit(spark, base).collect()) == [("a", 2), ("b", 1)]


def test_repeated_incoming_keys_are_refused(spark, tmp_path):
    base = str(tmp_path)
    W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (1, "x")), ["k"], "dimension")], batch_id="1")
    for kind in ("fact", "dimension"):
        with pytest.raises(PublishError, match="repeats keys"):
            W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (1, "p"), (1, "q")), ["k"], kind)], batch_id="2")
    assert got(spark, base, "a") == [(1, "x")] and W.current_batch(spark, base) == "1"
    assert [r.batch_id for r in W.read_audit(spark, base).collect()] == ["1"]


def test_two_publishers_lose_nothing(spark, tmp_path, monkeypatch):
    """Another publisher commits between this one's reading and its commit, twice."""
    base, create, others = str(tmp_path), W._Files.create, []

    def late(files, name, text):
        if len(others) < 2:
            others.append(len(others))
            monkeypatch.setattr(W._Files, "create", create)
            W.load_warehouse(spark, base, [W.TableLoad("dim", rows(spark, (len(others), "other")), ["k"], "dimension"),
                                           W.TableLoad(f"own{len(others)}", rows(spark, (1, "o")), ["k"])], batch_id=f"other{len(others)}")
            monkeypatch.setattr(W._Files, "create", late)
        return create(files, name, text)

    monkeypatch.setattr(W._Files, "create", late)
    counts = W.load_warehouse(spark, base, [W.TableLoad("dim", rows(spark, (2, "mine"), (7, "mine")), ["k"], "dimension"),
                                            W.TableLoad("fact", rows(spark, (5, "f")), ["k"])], batch_id="mine")
    assert counts == {"dim": (2, 0), "fact": (1, 0)}
    assert got(spark, base, "dim") == [(1, "other"), (2, "mine"), (7, "mine")]          # merged with what came between
    assert got(spark, base, "fact") == [(5, "f")] and got(spark, base, "own1") == got(spark, base, "own2") == [(1, "o")]
    assert sorted((r.seq, r.batch_id) for r in W.commits(spark, base).collect()) == [(1, "other1"), (2, "other2"), (3, "mine")]
    assert sorted(r.audit_id for r in W.read_audit(spark, base).collect()) == list(range(1, 7))


def test_publishers_side_by_side(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    base = str(tmp_path)
    load = lambda i: W.load_warehouse(spark, base, [W.TableLoad("dim", rows(spark, (i, "v")), ["k"], "dimension"),
                                                    W.TableLoad(f"t{i}", rows(spark, (i, "v")), ["k"])], batch_id=f"b{i}")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(load, range(4)))
    assert got(spark, base, "dim") == [(i, "v") for i in range(4)] and all(got(spark, base, f"t{i}") == [(i, "v")] for i in range(4))
    assert sorted(r.seq for r in W.commits(spark, base).collect()) == [1, 2, 3, 4]


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    files = W._Files(spark, str(tmp_path))
    assert files.create("_commits/000000000001.json", "{}") and not files.create("_commits/000000000001.json", "other")
    assert files.read("_commits/000000000001.json") == "{}" and [n for n, _, _ in files.names("_commits") if n.startswith(".0")] == []


def test_clean_up_after_a_crash(spark, tmp_path):
    from pyspark.sql import functions as F
    base = str(tmp_path)
    W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (1, "x")), ["k"])], batch_id="1")
    bad = spark.range(3).select(F.col("id").alias("k"), F.raise_error(F.lit("disk gone")).alias("v"))
    with pytest.raises(Exception):
        W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (2, "y")), ["k"]), W.TableLoad("b", bad, ["k"])], batch_id="2")
    left = {f"a/{n}" for n, _, _ in W._Files(spark, base).names("a")} - {W.current_commit(spark, base).tables["a"]}
    assert len(left) == 1 and W.remove_unnamed(spark, base) == []                        # too young
    gone = W.remove_unnamed(spark, base, least_age_s=0)
    assert left <= set(gone) and all(n.startswith(("a/", "b/")) for n in gone)
    assert got(spark, base, "a") == [(1, "x")] and W.remove_unnamed(spark, base, least_age_s=0) == []
    for i in (3, 4):
        W.load_warehouse(spark, base, [W.TableLoad("a", rows(spark, (i, "z")), ["k"])], batch_id=str(i))
    assert len(W.remove_unnamed(spark, base, keep=1, least_age_s=0)) == 2 and got(spark, base, "a") == [(4, "z")]

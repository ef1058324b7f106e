"""The driver contract: entry() runs, queries() and oracle_sql() agree on names, and every query equals
its DuckDB twin (rows, column names, column types, values) on the smallest driver tables."""
import os
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from statlayer.plans.catalogue import REGISTRY  # noqa: E402
from check_oracle import TABLES, digest, family  # noqa: E402

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return con


def test_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "share_of_world_pct" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries()) and len(E.queries()) >= 40
    assert set(REGISTRY) <= set(E.oracle_sql())


def test_entry_without_the_optional_parts():
    """The entry imports and keeps the other queries when the training-data folder and the pipeline are gone."""
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('statlayer.llm'):\n"
            "            raise ModuleNotFoundError(name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "print(len(e.queries()), len(e.oracle_sql()), [n for n in e.queries() if n[:2] == 'op' and n[2].isdigit()])")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert out.stdout.split("\n")[0] == f"{len(REGISTRY)} {len(REGISTRY)} []", out.stderr[-500:]


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, D)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert {f.name: family(f.dataType.simpleString()) for f in sdf.schema.fields} == \
        {c[0]: family(str(c[1])) for c in res.description}
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, dcols)[0]

"""Raw reads that must fail rather than lose rows, and the completeness gate."""
import hashlib
import json

import pytest

from statlayer.errors import ExtractionError
from statlayer.sources import files as src

HEAD = "Area Code,Area Code (M49),Area,Item Code,Item,Element,Source,Unit,Year,Value,Flag\n"
GOOD = "171,'608,Philippines,5060,Rice,Emissions,T1,kt,2023,45.1,E\n"


def stats(spark, tmp_path, *rows):
    path = tmp_path / f"s{len(list(tmp_path.iterdir()))}.csv"
    path.write_text(HEAD + "".join(rows))
    return src.read_stats_csv(spark, str(path)).collect()


def test_good_rows_and_blank_cells(spark, tmp_path):
    rows = stats(spark, tmp_path, GOOD, GOOD.replace("45.1", " "), GOOD.replace("45.1", ""), GOOD.replace("45.1", " 7 "))
    assert [r.Value for r in rows] == [45.1, None, None, 7.0] and rows[0]["Area Code"] == 171


@pytest.mark.parametrize("bad", [GOOD.replace("45.1", "abc"), "171,'608,Philippines\n", GOOD.strip() + ",x,y\n", GOOD.replace("2023", "20x3")])
def test_bad_rows_fail_the_read(spark, tmp_path, bad):
    with pytest.raises(Exception, match="not a number|MALFORMED|[Mm]alformed"):
        stats(spark, tmp_path, GOOD, bad)


@pytest.mark.parametrize("doc", [[{"message": [{"id": "120", "value": "bad"}]}], {"a": 1}, [{"page": 1, "pages": 1}], [{"page": 1, "pages": 1}, "text"]])
def test_malformed_pages_fail_the_read(spark, tmp_path, doc):
    (tmp_path / "page_1.json").write_text(json.dumps(doc))
    with pytest.raises(Exception, match="not a page"):
        src.read_pages(spark, str(tmp_path)).collect()


def test_incomplete_pulls_are_refused(spark, tmp_path):
    pull = tmp_path / "pulled=2026-01-01"
    pull.mkdir()
    (pull / "page_1.json").write_text(json.dumps([{"page": 1, "pages": 2, "per_page": 1, "total": 2}, [{"value": 1.0}]]))
    with pytest.raises(ExtractionError, match="incomplete"):
        src.require_complete_pages(spark, str(pull))
    for path in (tmp_path, pull):
        with pytest.raises(ExtractionError):
            src.complete_pull(spark, str(path))
    (pull / "_manifest.json").write_text("{}")
    assert src.complete_pull(spark, str(tmp_path)).endswith("pulled=2026-01-01") and src.complete_pull(spark, str(pull)) == str(pull)


def test_statistics_file_needs_its_marker(spark, tmp_path):
    for name in ("a_2025.csv", "a_2026.csv"):
        (tmp_path / name).write_text(HEAD + GOOD)
    with pytest.raises(ExtractionError):
        src.complete_file(spark, str(tmp_path))
    (tmp_path / "a_2025.csv.meta.json").write_text("{}")
    assert src.complete_file(spark, str(tmp_path)).endswith("a_2025.csv")
    with pytest.raises(ExtractionError):
        src.complete_file(spark, str(tmp_path / "a_2026.csv"))


def test_manifest_streams_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(src, "CHUNK", 1000)
    for n in (1, 10, 12345):
        (tmp_path / f"f{n}.bin").write_bytes(b"x" * n)
    got = {r.file: (r.size_bytes, r.sha256, r.url) for r in src.file_manifest(spark, str(tmp_path), url="u").collect()}
    assert got == {f"f{n}.bin": (n, hashlib.sha256(b"x" * n).hexdigest(), "u") for n in (1, 10, 12345)}

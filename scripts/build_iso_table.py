"""Regenerate statlayer/resources/iso3166_1.csv from the public ISO 3166-1 list.

The list comes from the Debian/Ubuntu ``iso-codes`` package (JSON form), the same public data set
that common country-code libraries wrap. Run once when the standard changes:

    python scripts/build_iso_table.py [/usr/share/iso-codes/json/iso_3166-1.json]
"""
from __future__ import annotations

import csv
import json
import sys
from pathlib import Path

SOURCE = Path("/usr/share/iso-codes/json/iso_3166-1.json")
TARGET = Path(__file__).resolve().parents[1] / "statlayer" / "resources" / "iso3166_1.csv"
COLUMNS = ["numeric", "alpha_3", "alpha_2", "name", "official_name", "common_name"]


def main(source: Path = SOURCE) -> Path:
    entries = json.loads(source.read_text(encoding="utf-8"))["3166-1"]
    entries.sort(key=lambda e: e["alpha_3"])
    with open(TARGET, "w", encoding="utf-8", newline="") as f:
        writer = csv.DictWriter(f, fieldnames=COLUMNS, extrasaction="ignore")
        writer.writeheader()
        for e in entries:
            writer.writerow({c: e.get(c, "") for c in COLUMNS})
    return TARGET


if __name__ == "__main__":
    print(main(Path(sys.argv[1]) if len(sys.argv) > 1 else SOURCE))

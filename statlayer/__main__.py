"""Command line: run the layered pipeline, all steps or the listed ones.

    python -m statlayer run --matrix sheet.csv --pages pulls/ --stats stats.csv --out /shared/agri \
        [--step stage --step validate_staging ...] [--run-id 20260101T000000Z] [--edition 2026]

``--pages`` may be the folder holding ``pulled=<date>`` snapshots: the latest complete one is used; a pull
without its marker is refused. ``--stats`` is a file, or a folder of files, with ``<file>.meta.json`` beside it.
"""
from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    from statlayer.plans import layers as PL
    from statlayer.session import get_spark, input_bytes, size_parallelism
    from statlayer.settings import Settings
    from statlayer.sources.files import complete_file, complete_pull

    parser = argparse.ArgumentParser(prog="statlayer")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run the pipeline")
    run.add_argument("--matrix", required=True)
    run.add_argument("--matrix-format", default="csv", choices=["csv", "parquet"])
    run.add_argument("--pages", required=True)
    run.add_argument("--stats", required=True)
    run.add_argument("--out", required=True, help="base folder on shared storage")
    run.add_argument("--step", action="append", choices=PL.STEPS, help="run only these steps (repeatable)")
    run.add_argument("--run-id", default=None, help="reuse an earlier run's folders")
    run.add_argument("--edition", type=int, default=Settings().edition)
    run.add_argument("--country-mapping", help="CSV (wb_code, edgar_code, reason) in place of the listed mapping")
    run.add_argument("--area-mapping", help="CSV (fao_area_code, fao_area, edgar_code, reason) in place of the listed mapping")
    run.add_argument("--threshold", action="append", default=[], metavar="NAME=VALUE", help="a data-quality threshold (repeatable)")
    args = parser.parse_args(argv)

    spark = get_spark("statlayer-run")
    size_parallelism(spark, input_bytes(spark, args.matrix, args.pages, args.stats))   # partitions from input size
    cfg = Settings.with_thresholds(args.threshold, edition=args.edition, country_mapping=args.country_mapping, area_mapping=args.area_mapping)
    pages, stats = complete_pull(spark, args.pages), complete_file(spark, args.stats)
    paths = PL.run(spark, PL.RawInputs(args.matrix, pages, stats, args.matrix_format), args.out,
                   steps=args.step, cfg=cfg, run_id=args.run_id)
    print(json.dumps({"run_id": paths.run_id, "base": paths.base, "warehouse": paths.warehouse}))
    return 0


if __name__ == "__main__":
    sys.exit(main())

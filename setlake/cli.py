"""Command line: ``python -m setlake.cli preflight|run``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from setlake.paths import DataPaths
from setlake.plans.extract import BATCH_ROWS, MAX_WORKERS
from setlake.sources.files import pbf_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="setlake", description="Coverage of a raw identity universe by two sets of successful text.")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("preflight", "validate roots and list the raw files"), ("run", "extract, join and classify")):
        sub = commands.add_parser(name, help=text)
        for root in ("data", "raw-pbf", "wikidata", "website"):
            sub.add_argument(f"--{root}-root", required=True)
        sub.add_argument("--volume-root", help="outputs must lie in this folder")
    sub.add_argument("--run-id", required=True)
    sub.add_argument("--workers", type=int, default=1, choices=range(1, MAX_WORKERS + 1))
    sub.add_argument("--batch-rows", type=int, default=BATCH_ROWS)
    sub.add_argument("--ring-rule", default="first3", choices=("first3", "distinct3"))
    sub.add_argument("--master", help="Spark master; left to spark-submit where absent")
    resume = sub.add_mutually_exclusive_group()
    resume.add_argument("--resume", dest="resume", action="store_true", default=True)
    resume.add_argument("--fresh", dest="resume", action="store_false")
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    try:
        paths = DataPaths.from_values(data_root=args.data_root, raw_pbf_root=args.raw_pbf_root, wikidata_root=args.wikidata_root, website_root=args.website_root, volume_root=args.volume_root)
    except ValueError as why:
        parser.error(str(why))
    if args.command == "preflight":
        files = pbf_files(paths.raw_pbf_root)
        if not files:
            parser.error(f"no regular *.osm.pbf files found under {paths.raw_pbf_root}")
        print(f"data root: {paths.data_root}\nraw PBF files: {len(files)}")
        for path in files:
            print(f"{path.name}\t{path.stat().st_size} bytes")
        return 0
    if args.batch_rows < 1:
        parser.error("--batch-rows must be positive")
    from setlake.plans.stages import run_analysis
    from setlake.session import session

    result = run_analysis(session(master=args.master), paths, args.run_id, batch_rows=args.batch_rows, workers=args.workers, resume=args.resume, ring_rule=args.ring_rule)
    print(f"completed run: {result.run_root}\nraw polygon universe: {result.overlap.row_count}\noverlap summary: {result.overlap.summary_path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

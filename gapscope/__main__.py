"""Command line: run the batch job or any registered query.

    python -m gapscope list
    python -m gapscope query q4_by_state /root/testdata/sf0.01 [--rows 20]
    python -m gapscope batch /root/testdata/sf0.01 [--open-data PATH]

The master is whatever ``spark-submit`` or the Spark configuration names;
``--master local[*]`` sets one by hand.  Shuffles are sized from the input's
bytes unless ``--shuffle-partitions`` is given.
"""

from __future__ import annotations

import argparse
import sys


def _session(args):
    from .session import apply_scale_settings, build_session
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    if args.shuffle_partitions is None:
        apply_scale_settings(spark, args.sf_dir, spark.sparkContext.defaultParallelism)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gapscope")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered query keys")
    q = sub.add_parser("query", help="show one registered query")
    q.add_argument("key")
    q.add_argument("sf_dir")
    q.add_argument("--rows", type=int, default=20)
    b = sub.add_parser("batch", help="end-to-end batch job, then the previews")
    b.add_argument("sf_dir")
    b.add_argument("--open-data", default=None, help="optional open-data CSV to land")
    args = p.parse_args(argv)

    from .plans.registry import SPARK
    from .session import Lease
    if args.cmd == "list":
        print("\n".join(SPARK))
        return 0
    spark = _session(args)
    try:
        if args.cmd == "query":
            if args.key not in SPARK:
                print(f"unknown key {args.key!r}; see `python -m gapscope list`", file=sys.stderr)
                return 2
            with Lease(spark) as lease:
                SPARK[args.key](spark, args.sf_dir).show(args.rows, truncate=False)
            lease.release()
        else:
            from .plans.batch import run_batch_job
            run = run_batch_job(spark, args.sf_dir, open_data_path=args.open_data)
            print(f"manifest: {run.manifest_path}")
            for name, path in run.export_paths.items():
                print(f"export {name}: {path}")
            for label, path in {**run.check_paths, **run.preview_paths}.items():
                print(f"-- {label}")
                spark.read.parquet(path).show(truncate=False)
            for name, path in run.reject_paths.items():
                print(f"rejects of {name}: {path}")
            if run.failed:
                run.outcomes().where("status IN ('failed', 'not run')").show(truncate=False)
                return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

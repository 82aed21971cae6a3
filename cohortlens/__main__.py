"""Command line: run the stages over a raw transactions file.

    python -m cohortlens --input raw.csv --out /shared/out            # all stages
    python -m cohortlens --out /shared/out --stage clusters --k 4     # one stage

Reads the raw table (CSV with a header by default, explicit schema), runs
cleaning, RFM, features, the k sweep and final KMeans, profiles, activity
timing and the chart tables (``plans.batch``), and overwrites each stage's
tables under ``--out``. ``--stage`` runs one stage over the tables earlier
stages left in ``--out``, as the reference's separate scripts do. Prints one
line per written table.

On a cluster, ``--out`` and ``spark.checkpoint.dir`` must be shared folders;
the master and resources come from ``spark-submit`` unless ``--master`` is
given.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from cohortlens.config import ClusterConfig, RFMConfig, TxConfig
from cohortlens.plans.batch import STAGES


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cohortlens", description=__doc__.splitlines()[0])
    p.add_argument("--input", help="raw transactions (file or folder); needed by the clean stage")
    p.add_argument("--stage", default="all", choices=["all", *STAGES], help="run one stage only")
    p.add_argument("--out", required=True, help="folder for the stage tables (overwritten)")
    p.add_argument("--input-format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="format of the written tables")
    p.add_argument(
        "--date-format", default="auto",
        help="InvoiceDate pattern, e.g. 'M/d/yyyy H:mm', or 'iso'; by default the one format that reads all dates",
    )
    p.add_argument("--k", type=int, default=ClusterConfig.final_k, help="final number of clusters")
    p.add_argument("--k-min", type=int, default=ClusterConfig.k_min)
    p.add_argument("--k-max", type=int, default=ClusterConfig.k_max)
    p.add_argument("--n-init", type=int, default=ClusterConfig.n_init, help="KMeans restarts per k")
    p.add_argument("--buckets", type=int, default=RFMConfig.buckets, help="buckets of the customer tables")
    p.add_argument("--seed", type=int, default=ClusterConfig.seed)
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument(
        "--conf", action="append", default=[], metavar="KEY=VALUE",
        help="Spark setting, repeatable (e.g. spark.checkpoint.dir=/shared/ckpt)",
    )
    return p


def main(argv: Sequence[str] | None = None) -> dict[str, str]:
    parser = _parser()
    args = parser.parse_args(argv)
    stages = STAGES if args.stage == "all" else (args.stage,)
    if "clean" in stages and not args.input:
        parser.error("--input is required to run the clean stage")
    from cohortlens.plans.batch import run_stages
    from cohortlens.session import build_session
    from pyspark.sql import functions as F

    from cohortlens.sources.files import read_raw_transactions, read_table, require_columns
    from cohortlens.sources.schema import raw_transactions_schema

    conf = {}
    for item in args.conf:
        key, sep, value = item.partition("=")
        if not sep or not key:
            parser.error(f"--conf expects KEY=VALUE, got {item!r}")
        conf[key] = value
    spark = build_session(args.master, app_name="cohortlens", extra_conf=conf)
    cfg = TxConfig(date_format=None if args.date_format == "iso" else args.date_format)
    raw = None
    if args.input and args.input_format == "csv":
        raw = read_raw_transactions(spark, args.input, cfg)
    elif args.input:
        # Parquet keeps its own types (e.g. a timestamp date, a long quantity):
        # read them, then cast to the raw schema the cleaning rules expect.
        fields = raw_transactions_schema(cfg).fields
        found = require_columns(read_table(spark, args.input, "cleaning", "parquet"), [f.name for f in fields], "cleaning")
        raw = found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
    kcfg = ClusterConfig(
        final_k=args.k, k_min=args.k_min, k_max=args.k_max, n_init=args.n_init, seed=args.seed
    )
    paths = run_stages(spark, raw, args.out, cfg=cfg, rcfg=RFMConfig(buckets=args.buckets), kcfg=kcfg, fmt=args.format, stages=stages)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    return paths


if __name__ == "__main__":
    main(sys.argv[1:])

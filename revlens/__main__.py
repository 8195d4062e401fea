"""Jobs for ``spark-submit`` or ``python -m revlens``.

    ingest PRODUCTS REVIEWS LANDING [--partitions N]
    build  LANDING WAREHOUSE [--as-of YYYY-MM-DD] [--namespace NAME]
"""

from __future__ import annotations

import argparse
import datetime as dt

from revlens.plans.build import build
from revlens.plans.ingest import ingest
from revlens.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="revlens", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("ingest")
    for name in ("products", "reviews", "landing"):
        load.add_argument(name)
    load.add_argument("--partitions", type=int)
    run = jobs.add_parser("build")
    for name in ("landing", "warehouse"):
        run.add_argument(name)
    run.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    run.add_argument("--namespace")
    args = parser.parse_args(argv)
    spark = build_session(app=f"revlens-{args.job}")
    if args.job == "ingest":
        ingest(spark, args.products, args.reviews, args.landing, args.partitions)
    else:
        as_of = args.as_of or dt.datetime.now(dt.timezone.utc).date()
        build(spark, args.landing, args.warehouse, as_of, namespace=args.namespace)


if __name__ == "__main__":
    main()

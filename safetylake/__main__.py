"""Command line: run the pipeline, or answer one dashboard request.

  python -m safetylake pipeline --products P --enforcement E --adverse A --out DIR [--database DB]
  python -m safetylake publish --products P --enforcement E --adverse A --out DIR [--database DB]
  python -m safetylake stats --gold DIR
  python -m safetylake enforcement --gold DIR [--search TERM] [--limit N] [--like]
  python -m safetylake adverse-events --gold DIR [--limit N]
  python -m safetylake adverse-by-product --gold DIR
  python -m safetylake products --gold DIR [--search TERM] [--limit N] [--like]

``pipeline`` replaces the tables in DIR; ``publish`` adds a version with its change
feeds and switches readers to it. ``--gold`` takes either folder.

Input feeds are JSON Lines folders; a single-line JSON array file also reads
as one record per element; --multiline reads pretty-printed whole-file arrays.
The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings (master, checkpoint folder, memory) come from spark-submit or the
environment. Responses print as one JSON document.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from safetylake.plans import endpoints, pipeline, runs


def _gold(spark: SparkSession, root: str, name: str):
    run = runs.current(spark, root)
    return spark.read.parquet(f"{run.path if run else root.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="safetylake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("pipeline", "publish"):
        p = sub.add_parser(name)
        for src in ("products", "enforcement", "adverse"):
            p.add_argument(f"--{src}", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--database")
        p.add_argument("--multiline", action="store_true")
    for name in ("stats", "enforcement", "adverse-events", "adverse-by-product", "products"):
        q = sub.add_parser(name)
        q.add_argument("--gold", required=True, help="folder holding the gold tables")
        if name in ("enforcement", "products"):
            q.add_argument("--search", default="")
            q.add_argument("--limit", type=int, default=50)
            q.add_argument("--like", action="store_true", help="treat %% and _ as wildcards")
        if name == "adverse-events":
            q.add_argument("--limit", type=int, default=30)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("safetylake").getOrCreate()
    if args.cmd in ("pipeline", "publish"):
        sources = {"products": args.products, "enforcement": args.enforcement, "adverse": args.adverse}
        out: dict = {}
        if args.cmd == "publish":
            out["version"] = runs.publish(spark, sources, args.out, multiline=args.multiline).version
            paths = runs.paths(spark, args.out)
        else:
            paths = pipeline.run(spark, sources, args.out, multiline=args.multiline)
        out["tables"] = paths
        if args.database:
            out["registered"] = pipeline.register_tables(spark, paths, args.database)
    else:
        prod = _gold(spark, args.gold, "gold_product_catalog")
        rec = _gold(spark, args.gold, "gold_enforcement_actions")
        summ = _gold(spark, args.gold, "gold_adverse_events_summary")
        mode = "like" if getattr(args, "like", False) else "literal"
        out = {
            "stats": lambda: endpoints.stats(prod, rec, summ),
            "enforcement": lambda: endpoints.enforcement(rec, args.search, args.limit, mode),
            "adverse-events": lambda: endpoints.adverse_events(summ, args.limit),
            "adverse-by-product": lambda: endpoints.adverse_events_by_product(summ),
            "products": lambda: endpoints.products(prod, args.search, args.limit, mode),
        }[args.cmd]()
    json.dump(out, sys.stdout, indent=2)
    sys.stdout.write("\n")
    return 0


if __name__ == "__main__":
    sys.exit(main())

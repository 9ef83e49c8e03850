"""Command-line jobs: ``python -m stratum <command> ...`` (or ``spark-submit``).

    ingest  --raw R --bronze B --feed cust_info [--by-position] [--archive A]
    silver  --bronze B --silver S [--as-of 2024-06-30] [--append | --incremental]
    gold    --silver S --gold G [--upsert]
    run     --raw R --bronze B --silver S --gold G [--as-of ...] [--upsert] [--by-position] [--incremental]

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings (including ``spark.checkpoint.dir``) are whatever the launcher
provides. Each command prints one JSON line describing what it did.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from stratum.plans import layers
from stratum.session import ensure_checkpoint_dir
from stratum.sources.feeds import FEED_COLUMNS


def _roots(a: argparse.Namespace) -> layers.Roots:
    return layers.Roots(raw=getattr(a, "raw", None) or "", bronze=getattr(a, "bronze", None) or "",
                        silver=getattr(a, "silver", None) or "", gold=getattr(a, "gold", None) or "",
                        archive=getattr(a, "archive", None))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stratum")
    sub = p.add_subparsers(dest="command", required=True)

    ing = sub.add_parser("ingest", help="stream new raw files of one feed into bronze")
    ing.add_argument("--raw", required=True)
    ing.add_argument("--bronze", required=True)
    ing.add_argument("--feed", required=True, choices=sorted(FEED_COLUMNS))
    ing.add_argument("--by-position", action="store_true")
    ing.add_argument("--archive")
    ing.add_argument("--timeout", type=float, help="seconds; without it, until all files are taken")

    sil = sub.add_parser("silver", help="rebuild the six silver tables")
    sil.add_argument("--bronze", required=True)
    sil.add_argument("--silver", required=True)
    sil.add_argument("--as-of")
    how = sil.add_mutually_exclusive_group()
    how.add_argument("--append", action="store_true")
    how.add_argument("--incremental", action="store_true")

    gol = sub.add_parser("gold", help="rebuild or merge the gold tables")
    gol.add_argument("--silver", required=True)
    gol.add_argument("--gold", required=True)
    gol.add_argument("--upsert", action="store_true")
    gol.add_argument("--match-null-keys", action="store_true", help="with --upsert: a null key equals a null key")

    run = sub.add_parser("run", help="ingest, silver and gold in order")
    for name in ("raw", "bronze", "silver", "gold"):
        run.add_argument(f"--{name}", required=True)
    run.add_argument("--archive")
    run.add_argument("--as-of")
    run.add_argument("--upsert", action="store_true")
    run.add_argument("--by-position", action="store_true")
    run.add_argument("--incremental", action="store_true")
    run.add_argument("--match-null-keys", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"stratum-{a.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    roots = _roots(a)
    if a.command == "ingest":
        from stratum.streaming import by_name, ingest
        run = ingest.ingest_feed if a.by_position else by_name.ingest_feed_by_name
        tracked = {} if a.by_position else {"schema_location": roots.bronze_layouts(a.feed)}
        res = run(spark, roots.raw_feed(a.feed), roots.bronze_data(a.feed),
                  roots.bronze_checkpoint(a.feed), a.feed, timeout_s=a.timeout,
                  archive_dir=roots.raw_archive(a.feed), **tracked)
        out = {"feed": res.feed, "batches": res.batches, "rows": res.rows, "new_layouts": res.new_layouts}
    elif a.command == "silver":
        rep = layers.build_silver(spark, roots, as_of=a.as_of,
                                  mode="append" if a.append else "overwrite",
                                  incremental=a.incremental)
        out = {"silver_versions": rep.silver_versions}
    elif a.command == "gold":
        rep = layers.build_gold(spark, roots, mode="upsert" if a.upsert else "replace", match_null_keys=a.match_null_keys)
        out = {"gold_versions": rep.gold_versions}
    else:
        rep = layers.run_all(spark, roots, as_of=a.as_of,
                             mode="upsert" if a.upsert else "replace", by_name=not a.by_position,
                             incremental=a.incremental, match_null_keys=a.match_null_keys)
        out = {"ingested_rows": rep.ingested_rows, "new_layouts": rep.new_layouts, "silver_versions": rep.silver_versions,
               "gold_versions": rep.gold_versions}
    out = {"command": a.command, **out}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])

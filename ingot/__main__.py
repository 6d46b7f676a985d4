"""Command line: the pipeline and its per-layer flows.

    python -m ingot run          --source 'in/*.csv' --root LAKE
    spark-submit --py-files ingot.zip ingot/__main__.py run --source 's3://b/in/*.csv' --root s3://b/lake
    python -m ingot bronze       --source DIR_OR_GLOB --root LAKE [--limit-per-file 10000]
    python -m ingot increment    --source DIR_OR_GLOB --root LAKE   (only these files, all layers)
    python -m ingot stream       --source DIR --root LAKE           (new files since last run)
    python -m ingot silver|gold  --root LAKE
    python -m ingot dq           --root LAKE [--layer bronze|silver|gold] [--preview 20]

`dq` shows each check's result (counts, profiles as metric rows, and a
bounded preview of violating rows) instead of fetching every row.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from ingot.operators import quality as Q
from ingot.plans import medallion as M
from ingot.plans import sinks as S
from ingot.session import build_session


def _show_checks(checks: dict, layer: str, preview: int) -> None:
    for name, df in checks.items():
        print(f"\n--- {layer}: {name} ---")
        if len(df.columns) > 3 and name in ("nulls_and_distincts", "fact_nulls_unknowns",
                                             "unknown_values"):
            Q.report(df, layer, name).show(100, truncate=False)
        elif name in ("invalid_ids", "referential_integrity", "event_key_duplicates"):
            n = df.count()
            print(f"{n} rows" + (f"; first {min(n, preview)}:" if n else ""))
            if n:
                df.orderBy(*df.columns).limit(preview).show(preview, truncate=False)
        else:
            df.show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ingot")
    ap.add_argument("command", choices=["run", "increment", "stream", "bronze", "silver", "gold", "dq"])
    ap.add_argument("--source", help="CSV file, folder or glob (run, bronze)")
    ap.add_argument("--root", required=True, help="shared folder holding the tables")
    ap.add_argument("--limit-per-file", type=int, default=None)
    ap.add_argument("--on-error", default="quarantine", choices=["quarantine", "skip_file", "fail"])
    ap.add_argument("--fact-mode", default="append", choices=["append", "overwrite"])
    ap.add_argument("--fail-on", default="", help="comma list of check names that gate the run")
    ap.add_argument("--layer", default=None, choices=["bronze", "silver", "gold"])
    ap.add_argument("--preview", type=int, default=20)
    ap.add_argument("--recreate", action="store_true")
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size of the input; sizes shuffle partitions and splits")
    args = ap.parse_args(argv)

    spark = build_session(input_bytes=args.input_bytes)
    lh = S.Lakehouse(spark, args.root)
    if args.command == "run":
        result = M.run_medallion(
            spark, args.source, args.root, args.limit_per_file, args.on_error, args.fact_mode,
            tuple(x for x in args.fail_on.split(",") if x) or None, args.recreate,
        )
        result["checks"] = {f"{k[0]}.{k[1]}": v for k, v in result["checks"].items()}
        print(json.dumps(result, default=str, indent=2))
        return 0
    lh.create(recreate=args.recreate)
    if args.command == "increment":
        print(json.dumps(M.load_bronze_increment(lh, args.source, args.limit_per_file,
                                                 args.on_error), indent=2))
    elif args.command == "stream":
        from ingot.streaming.incremental import ingest_new_files

        ingest_new_files(lh, args.source, on_error=args.on_error, downstream=True)
        print(f"bronze now holds {lh.table(S.BRONZE).count()} rows")
    elif args.command == "bronze":
        rep = M.load_bronze(lh, args.source, args.limit_per_file, args.on_error)
        print(f"bronze: {rep.rows_loaded} rows appended, {rep.rows_rejected} rejected")
        M.bronze_file_counts(lh).orderBy("source_file").show(truncate=False)
    elif args.command == "silver":
        M.load_silver(lh)
        print(f"silver: refreshed, {lh.table(S.SILVER).count()} rows")
    elif args.command == "gold":
        print(f"dim_products: refreshed, {M.load_dim_products(lh)} events without product id")
        print(f"fact_ecommerce: {M.load_fact(lh, args.fact_mode)} rows loaded")
    elif args.command == "dq":
        layers = [args.layer] if args.layer else ["bronze", "silver", "gold"]
        flows = {"bronze": M.bronze_checks, "silver": M.silver_checks, "gold": M.gold_checks}
        for layer in layers:
            _show_checks(flows[layer](lh), layer, args.preview)
        M.dq_summary(lh).orderBy(F.col("layer"), F.col("check_name")).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Command-line entry for the layer jobs, meant for ``spark-submit`` (the cluster decides master,
executors and ``spark.checkpoint.dir``; ship the package with ``--py-files``).

    spark-submit lakestrata/jobs.py plan   --landing <landing>
    spark-submit lakestrata/jobs.py bronze --landing <landing> --bronze <bronze> [--files-per-day N | --per-day-plan]
    spark-submit lakestrata/jobs.py stream --landing <landing> --bronze <bronze> --checkpoint <ckpt> --schema-from <bronze>
    spark-submit lakestrata/jobs.py silver --bronze <bronze> --silver <silver> --contracts <contracts> [--days 2017-01-01:2017-01-31]
    spark-submit lakestrata/jobs.py ingest  --landing <landing> --bronze <bronze> --load 2017-01    # new files only, committed
    spark-submit lakestrata/jobs.py refresh --bronze <bronze> --silver <silver> --contracts <contracts>  # changed days only
    spark-submit lakestrata/jobs.py compact --table <table> [--target-bytes N]
    spark-submit lakestrata/jobs.py gold   --silver <silver> --gold <gold> --model <detector> [--days …] [--no-languages]
    spark-submit lakestrata/jobs.py gold   … --labelled-text <table> --text-col text --label-col lang [--save-model <detector>]
"""

from __future__ import annotations

import argparse
import json

from lakestrata.plans import bronze as bronze_plan
from lakestrata.plans import silver
from lakestrata.session import build_session, release_scratch


def _plan(spark, args) -> None:
    files = bronze_plan.list_landing(spark, args.landing)
    row = bronze_plan.plan_layout(files).first()
    print(json.dumps(row.asDict()))


def _bronze(spark, args) -> None:
    files = bronze_plan.list_landing(spark, args.landing)
    # a known schema skips the inference pass over every JSON byte
    schema = bronze_plan.read_bronze(spark, args.schema_from).drop("day").schema if args.schema_from else None
    plan = bronze_plan.per_day_plan(files)
    if not args.per_day_plan:
        # one count for every day (the original layout), still placed one (day, file) per task
        n = args.files_per_day or bronze_plan.plan_layout(files).first().files_per_day
        plan = {day: n for day in plan}
    bronze_plan.ingest_bronze(spark, args.landing, args.bronze, plan, schema=schema, mode=args.mode, sampling_ratio=args.sampling_ratio)
    bad = bronze_plan.corrupt_rows(bronze_plan.read_bronze(spark, args.bronze))
    print(json.dumps({"corrupt_lines": bad}))


def _stream(spark, args) -> None:
    from lakestrata.streaming.ingest import landing_stream, run_bronze_stream

    schema = bronze_plan.read_bronze(spark, args.schema_from).drop("day").schema
    events = landing_stream(spark, args.landing, schema, max_files_per_trigger=args.max_files_per_trigger)
    days = max(1, -(-args.max_files_per_trigger // 24))  # hourly files: 24 per day
    run_bronze_stream(events, args.bronze, args.checkpoint, files_per_batch_day=args.files_per_day or 1,
                      days_per_batch=days)


def _days(args) -> tuple[str, str] | None:
    if not args.days:
        return None
    first, _, last = args.days.partition(":")
    return first, last or first


def _silver(spark, args) -> None:
    bronze = bronze_plan.read_bronze(spark, args.bronze)
    if days := _days(args):
        day = bronze["day"].cast("string")
        bronze = bronze.where((day >= days[0]) & (day <= days[1]))
    types = tuple(args.types.split(",")) if args.types else silver.EVENT_TYPES
    keep = tuple(args.keep.split(",")) if args.keep else ()
    profile = silver.profile_bronze(bronze)
    contracts = silver.ensure_contracts(spark, bronze, args.contracts, event_types=types, keep=keep, profile=profile)
    written = silver.build_silver(spark, bronze, contracts, args.silver, event_types=types, profile=profile)
    print(json.dumps(written))


def _ingest(spark, args) -> None:
    from lakestrata.plans import lake

    version = lake.ingest_landing(spark, args.landing, args.bronze, args.load, sampling_ratio=args.sampling_ratio)
    print(json.dumps({"version": version}))


def _refresh(spark, args) -> None:
    from lakestrata.plans import lake

    types = tuple(args.types.split(",")) if args.types else silver.EVENT_TYPES
    keep = tuple(args.keep.split(",")) if args.keep else ()
    print(json.dumps(lake.refresh_silver(spark, args.bronze, args.silver, args.contracts, event_types=types, keep=keep)))


def _compact(spark, args) -> None:
    from lakestrata.plans import lake

    print(json.dumps({"version": lake.compact(spark, args.table, target_bytes=args.target_bytes, key=args.key)}))


def _gold(spark, args) -> None:
    from lakestrata.plans.build_gold import build_gold
    from lakestrata.plans.language import load_detector, save_detector, train_language_detector

    model = None
    if args.model:
        model = load_detector(args.model)
    elif args.labelled_text:
        model = train_language_detector(spark.read.parquet(args.labelled_text), args.text_col, args.label_col)
        if args.save_model:
            save_detector(model, args.save_model)
    written = build_gold(
        spark, args.silver, args.gold, model=model, threshold=args.threshold, languages=not args.no_languages, days=_days(args)
    )
    print(json.dumps(written))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lakestrata.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    p = sub.add_parser("plan")
    p.add_argument("--landing", required=True)
    p = sub.add_parser("bronze")
    p.add_argument("--landing", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--files-per-day", type=int)
    p.add_argument("--per-day-plan", action="store_true")
    p.add_argument("--schema-from", help="an existing bronze table whose schema the JSON follows")
    p.add_argument("--sampling-ratio", type=float, help="share of the rows schema inference reads")
    p.add_argument("--mode", default="errorifexists")
    p = sub.add_parser("stream")
    p.add_argument("--landing", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--schema-from", required=True, help="an existing bronze table whose schema the JSON follows")
    p.add_argument("--files-per-day", type=int)
    p.add_argument("--max-files-per-trigger", type=int, default=48)
    p = sub.add_parser("silver")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--contracts", required=True)
    p.add_argument("--days", help="first:last day, both included (default: all)")
    p.add_argument("--keep", help="comma-separated columns to keep although their name says link or avatar")
    p.add_argument("--types", help="comma-separated event types (default: the 13 standard ones)")
    p = sub.add_parser("ingest")
    p.add_argument("--landing", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--load", required=True, help="name of this load, e.g. its month")
    p.add_argument("--sampling-ratio", type=float)
    p = sub.add_parser("refresh")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--contracts", required=True)
    p.add_argument("--keep")
    p.add_argument("--types")
    p = sub.add_parser("compact")
    p.add_argument("--table", required=True)
    p.add_argument("--target-bytes", type=int, default=bronze_plan.TARGET_FILE_BYTES)
    p.add_argument("--key", default="id", help="column whose hash spreads a day over its files")
    p = sub.add_parser("gold")
    p.add_argument("--silver", required=True)
    p.add_argument("--gold", required=True)
    p.add_argument("--labelled-text", help="Parquet table of labelled text to train the language detector")
    p.add_argument("--text-col", default="text")
    p.add_argument("--label-col", default="lang")
    p.add_argument("--threshold", type=float, default=0.1)
    p.add_argument("--model", help="a stored language detector")
    p.add_argument("--save-model", help="where to store the detector trained on --labelled-text")
    p.add_argument("--no-languages", action="store_true", help="leave out the two language datasets")
    p.add_argument("--days", help="first:last day, both included (default: all)")
    args = parser.parse_args(argv)
    spark = build_session(app_name=f"lakestrata-{args.job}")
    job = {
        "plan": _plan, "bronze": _bronze, "stream": _stream, "ingest": _ingest, "refresh": _refresh, "compact": _compact,
        "silver": _silver, "gold": _gold,
    }
    try:
        job[args.job](spark, args)
    finally:
        release_scratch(spark)


if __name__ == "__main__":
    main()

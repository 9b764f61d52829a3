"""End to end: hourly landing JSON → layout plan → bronze → contracts → silver → gold."""

import gzip
import json
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakestrata.plans import bronze as bronze_plan
from lakestrata.plans import gold, silver
from lakestrata.sinks.parquet import write_partitioned
import example_views as tv
from lakestrata.streaming.ingest import landing_stream, run_bronze_stream

TYPES = ("click", "error", "purchase", "signup", "view")


def _jsonable(v):
    if hasattr(v, "asDict"):
        return {k: _jsonable(x) for k, x in v.asDict().items()}
    if isinstance(v, list):
        return [_jsonable(x) for x in v]
    return v


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Hourly gzip JSON files named ``YYYY-MM-DD-H.json.gz`` built from the sf0.001 events.

    Purchases also carry a ``commits`` array (0-2 elements) so the child-table path is exercised.
    """
    root = tmp_path_factory.mktemp("landing")
    rows = tv.bronze_events(spark, SF_SMALL).drop("day").collect()
    by_hour = defaultdict(list)
    for r in rows:
        doc = _jsonable(r)
        if doc["type"] == "purchase":
            q = doc["payload"]["quantity"] or 0
            doc["payload"]["commits"] = [
                {"sha": f"s{doc['id']}-{i}", "message": f"msg {i} of {doc['id']}", "url": "https://x"} for i in range(q % 3)
            ]
        day, hour = doc["created_at"][:10], int(doc["created_at"][11:13])
        by_hour[f"{day}-{hour}.json.gz"].append(doc)
    for name, docs in by_hour.items():
        with gzip.open(root / name, "wt") as fh:
            for d in docs:
                fh.write(json.dumps(d) + "\n")
    return str(root), rows


def test_layout_plan(spark, landing):
    src, _ = landing
    files = bronze_plan.list_landing(spark, src)
    parsed = bronze_plan.parse_landing_names(files)
    assert set(parsed.columns) >= {"path", "length", "year", "month", "day", "hour"}
    assert parsed.where(F.col("hour").isNull()).count() == 0
    assert parsed.where("hour >= 10").count() > 0 and parsed.where("hour < 10").count() > 0
    plan = bronze_plan.plan_layout(files).first()
    sizes = bronze_plan.day_sizes(files).collect()
    assert plan.days == len(sizes) == 30
    biggest = max(r.json_bytes for r in sizes) * 2
    smallest = min(r.json_bytes for r in sizes) * 2
    assert plan.min_files == round(biggest / 400e6, 1)
    assert plan.max_files == round(smallest / 128e6, 1)
    assert plan.files_per_day == 1  # tiny days: one file each
    per_day = bronze_plan.per_day_plan(files, target_bytes=5_000)
    assert max(per_day.values()) > 1


def test_bronze_silver_gold(spark, landing, tmp_dir):
    src, rows = landing
    bronze_path = f"{tmp_dir}/bronze"
    bronze_plan.ingest_bronze(spark, src, bronze_path, files_per_day=2, num_days=30)
    with pytest.raises(Exception):
        bronze_plan.ingest_bronze(spark, src, bronze_path, files_per_day=2, num_days=30)
    day_dirs = [d for d in os.listdir(bronze_path) if d.startswith("day=")]
    assert len(day_dirs) == 30
    for d in day_dirs:
        parts = [f for _, _, names in os.walk(f"{bronze_path}/{d}") for f in names if f.endswith(".parquet")]
        assert 1 <= len(parts) <= 2
    bronze = bronze_plan.read_bronze(spark, bronze_path)
    assert bronze.count() == len(rows)
    assert sorted(r.type for r in bronze_plan.event_types(bronze).collect()) == list(TYPES)

    first_day = sorted(day_dirs)[0].split("=")[1]
    sample = bronze_plan.read_bronze(spark, bronze_path, day=first_day)
    assert sample.count() > 0 and "day" in sample.columns
    contracts_path = f"{tmp_dir}/contracts"
    contracts = silver.ensure_contracts(spark, sample, contracts_path, event_types=TYPES)
    assert "purchase_df_commits_df" in contracts and silver.FACT_TABLE in contracts
    assert silver.ensure_contracts(spark, sample, contracts_path, event_types=TYPES) == contracts
    assert "payload" not in contracts[silver.FACT_TABLE].fieldNames()
    assert not any(c.endswith("url") for c in contracts[silver.FACT_TABLE].fieldNames())
    assert [f for f in contracts["purchase_df_commits_df"].fieldNames()] == [
        "fact_id", "event_created_at", "pos", "message", "sha"
    ]

    silver_path = f"{tmp_dir}/silver"
    written = silver.build_silver(spark, bronze, contracts, silver_path, event_types=TYPES)
    assert set(written) == {"click_df", "error_df", "purchase_df", "purchase_df_commits_df", "signup_df", "view_df", "main_df"}
    main = spark.read.parquet(written["main_df"])
    assert main.count() == len(rows)
    purchases = spark.read.parquet(written["purchase_df"])
    assert set(purchases.columns) == {"id", "created_at", "amount", "quantity", "day"}
    commits = spark.read.parquet(written["purchase_df_commits_df"])
    expected_commits = sum((r.payload.quantity or 0) % 3 for r in rows if r.type == "purchase")
    assert commits.count() == expected_commits
    assert "url" not in commits.columns

    # gold over the written silver fact equals gold over the in-memory view
    from_silver = gold.events_per_hour(main)
    from_view = gold.events_per_hour(tv.event_fact(spark, SF_SMALL))
    assert sorted(map(tuple, from_silver.collect())) == sorted(map(tuple, from_view.collect()))

    # rewriting one day keeps every other day (dynamic partition overwrite)
    one_day = main.where(F.col("day") == F.lit(first_day).cast("date")).withColumn("day", F.col("day").cast("string"))
    write_partitioned(one_day, written["main_df"])
    assert spark.read.parquet(written["main_df"]).count() == len(rows)


def test_streaming_ingest_is_incremental_and_exactly_once(spark, landing, tmp_dir):
    src, rows = landing
    schema = spark.read.json(src).schema
    dst, ckpt = f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    stream = landing_stream(spark, src, schema, max_files_per_trigger=200)
    run_bronze_stream(stream, dst, ckpt, files_per_batch_day=1, partitions=4)
    assert spark.read.parquet(dst).count() == len(rows)
    # a second run over the same files with the same checkpoint adds nothing
    run_bronze_stream(landing_stream(spark, src, schema), dst, ckpt, files_per_batch_day=1, partitions=4)
    assert spark.read.parquet(dst).count() == len(rows)
    # a new landing file is picked up on its own
    with gzip.open(os.path.join(src, "2024-02-01-0.json.gz"), "wt") as fh:
        fh.write(json.dumps({"id": "new", "type": "click", "created_at": "2024-02-01T00:00:01Z"}) + "\n")
    run_bronze_stream(landing_stream(spark, src, schema), dst, ckpt, files_per_batch_day=1, partitions=4)
    back = spark.read.parquet(dst)
    assert back.count() == len(rows) + 1
    assert back.where("id = 'new'").select(F.col("day").cast("string")).first()[0] == "2024-02-01"


GH_TYPES = {
    "purchase": "PushEvent",
    "click": "IssueCommentEvent",
    "error": "CommitCommentEvent",
    "signup": "PullRequestReviewCommentEvent",
    "view": "WatchEvent",
}
REFS = ["refs/heads/master", "refs/heads/gh-pages", "refs/heads/dev", None]


def test_silver_to_gold_job(spark, tmp_dir):
    """Archive-shaped landing (push, comment and watch events) through every layer to the seven
    gold datasets, including language detection."""
    from lakestrata.plans.build_gold import build_gold
    from lakestrata.plans.language import train_language_detector

    events = tv.bronze_events(spark, SF_SMALL).drop("day").collect()
    texts = [r.text for r in tv.table(spark, SF_SMALL, "documents").orderBy("doc_id").select("text").collect()]
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    by_hour = defaultdict(list)
    pushes = 0
    for i, r in enumerate(events):
        doc = _jsonable(r)
        k = doc["payload"]["quantity"] or doc["payload"]["code"] or (doc["payload"]["item"] or {}).get("id") or i
        doc["type"] = GH_TYPES[doc["type"]]
        if doc["type"] == "PushEvent":
            pushes += 1
            doc["payload"] = {
                "push_id": 1000 + i, "distinct_size": k % 5, "ref": REFS[k % 4],
                "commits": [{"sha": f"{i}-{j}", "message": texts[(i + j) % len(texts)][:200], "url": "u"} for j in range(k % 3)],
            }
        elif doc["type"] == "WatchEvent":
            doc["payload"] = {"action": "started"}
        else:
            doc["payload"] = {"comment": {"id": i, "body": texts[i % len(texts)], "html_url": "h"}}
        by_hour[f"{doc['created_at'][:10]}-{int(doc['created_at'][11:13])}.json.gz"].append(doc)
    for name, docs in by_hour.items():
        with gzip.open(f"{src}/{name}", "wt") as fh:
            fh.write("\n".join(json.dumps(d) for d in docs) + "\n")

    files = bronze_plan.list_landing(spark, src)
    n = bronze_plan.plan_layout(files).first().files_per_day
    bronze_plan.ingest_bronze(spark, src, f"{tmp_dir}/bronze", files_per_day=n, num_days=30)
    bronze = bronze_plan.read_bronze(spark, f"{tmp_dir}/bronze")
    types = tuple(GH_TYPES.values())
    contracts = silver.ensure_contracts(spark, bronze, f"{tmp_dir}/contracts", event_types=types)
    silver.build_silver(spark, bronze, contracts, f"{tmp_dir}/silver", event_types=types)
    push = spark.read.parquet(f"{tmp_dir}/silver/push_event_df")
    assert set(push.columns) == {"id", "created_at", "push_id", "distinct_size", "ref", "day"}
    # inferred JSON fields come sorted; the link column is dropped by the contract
    assert spark.read.parquet(f"{tmp_dir}/silver/issue_comment_event_df").columns == [
        "id", "created_at", "comment_body", "comment_id", "day"
    ]

    model = train_language_detector(tv.table(spark, SF_SMALL, "documents"), "text", "lang")
    written = build_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold", model=model)
    assert set(written) == {
        "event_per_hour_df", "push_event_ref_df", "num_commits_df", "user_type_week",
        "user_push_activity", "event_languages_df", "language_stats_df",
    }
    read = {k: spark.read.parquet(v) for k, v in written.items()}
    assert read["num_commits_df"].count() == pushes
    assert read["push_event_ref_df"].columns == ["day", "main", "gh-pages", "other"]
    langs = read["event_languages_df"]
    assert langs.columns == ["code", "id", "created_at", "type", "actor_login", "org_login", "comment", "language"]
    comment_events = sum(1 for r in events if r.type in ("click", "error", "signup"))
    pushes_with_commits = spark.read.parquet(f"{tmp_dir}/silver/push_event_df_commits_df").select("fact_id").distinct().count()
    assert langs.count() == comment_events + pushes_with_commits
    stats = read["language_stats_df"]
    assert stats.select("type").distinct().count() == 4
    total = stats.select(sum(F.col(f"`{c}`") for c in stats.columns if c != "type").alias("t")).agg(F.sum("t")).first()[0]
    assert total == langs.count()


def test_jobs_command_line(spark, landing, tmp_dir, capsys):
    from lakestrata import jobs

    src, rows = landing
    jobs.main(["plan", "--landing", src])
    plan = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert plan["days"] >= 30 and plan["files_per_day"] >= 1
    jobs.main(["bronze", "--landing", src, "--bronze", f"{tmp_dir}/bronze", "--per-day-plan"])
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() >= len(rows)
    jobs.main([
        "silver", "--bronze", f"{tmp_dir}/bronze", "--silver", f"{tmp_dir}/silver",
        "--contracts", f"{tmp_dir}/contracts", "--types", ",".join(TYPES),
    ])
    written = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert spark.read.parquet(written["main_df"]).count() >= len(rows)
    # a second load with the stored schema (no inference pass) into a new root
    jobs.main(["bronze", "--landing", src, "--bronze", f"{tmp_dir}/bronze2", "--schema-from", f"{tmp_dir}/bronze"])
    assert spark.read.parquet(f"{tmp_dir}/bronze2").count() == spark.read.parquet(f"{tmp_dir}/bronze").count()


def test_contract_prunes_unrelated_payload_before_flatten(spark):
    """A payload subtree outside the contract may clash on flatten; with a contract it is never expanded."""
    from pyspark.sql import types as T

    bronze = spark.createDataFrame(
        [("1", "PushEvent", "2017-01-01T00:00:00Z", {"ref": "refs/heads/master", "a": {"b_c": 1}, "a_b": {"c": 2}})],
        "id string, type string, created_at string, payload struct<ref:string, a:struct<b_c:int>, a_b:struct<c:int>>",
    )
    with pytest.raises(ValueError, match="a_b_c"):
        silver.extract_event(bronze, "PushEvent", drop_null=False)
    contract = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "created_at", "ref")])
    out = silver.event_table(bronze, "PushEvent", contract)
    assert out.columns == ["id", "created_at", "ref"] and out.first().ref == "refs/heads/master"


def test_payload_field_named_like_a_key(spark):
    bronze = spark.createDataFrame(
        [("1", "ForkEvent", "2017-01-01T00:00:00Z", {"id": 99, "name": "x"})],
        "id string, type string, created_at string, payload struct<id:bigint, name:string>",
    )
    with pytest.raises(ValueError, match="id"):
        silver.extract_event(bronze, "ForkEvent")
    out = silver.extract_event(bronze, "ForkEvent", clash_prefix="payload_")
    assert out.columns == ["id", "created_at", "payload_id", "name"]
    assert tuple(out.first()) == ("1", "2017-01-01T00:00:00Z", 99, "x")


def test_contracts_skip_types_missing_from_the_sample(spark, tmp_dir):
    bronze = tv.bronze_events(spark, SF_SMALL)
    sample = bronze.where("type <> 'signup'")
    contracts = silver.ensure_contracts(spark, sample, f"{tmp_dir}/c", event_types=TYPES)
    assert "signup_df" not in contracts and "click_df" in contracts and silver.FACT_TABLE in contracts
    # a later run whose sample has the type completes the stored set, keeping what was stored
    again = silver.ensure_contracts(spark, bronze, f"{tmp_dir}/c", event_types=TYPES)
    assert "signup_df" in again and again["click_df"] == contracts["click_df"]
    assert silver.load_contracts(spark, f"{tmp_dir}/c") == again
    # a table without a contract is profiled on the full data
    parent, _ = silver.build_event_tables(bronze, "signup", contracts)
    assert parent.columns == ["id", "created_at", "campaign", "day"]


def _two_days(spark):
    payload = "struct<push_id:bigint, forced:boolean, commits:array<struct<message:string>>>"
    rows = [
        ("1", "PushEvent", "2017-01-01T00:00:00Z", (1, None, None)),
        ("2", "PushEvent", "2017-01-02T00:00:00Z", (2, True, [("m1",), ("m2",)])),
    ]
    df = spark.createDataFrame(rows, f"id string, type string, created_at string, payload {payload}")
    return bronze_plan.to_bronze(df)


def test_fields_and_arrays_of_late_days_are_kept(spark, tmp_dir):
    bronze = _two_days(spark)
    first = bronze.where("day = '2017-01-01'")
    early = silver.ensure_contracts(spark, first, f"{tmp_dir}/c", event_types=["PushEvent"])
    assert "forced" not in early["push_event_df"].fieldNames()
    assert silver.dropped_columns(bronze, early, ["PushEvent"])["push_event_df"] == ["forced", "commits"]
    # the stored contract is widened by the later load, and the child table appears
    contracts = silver.ensure_contracts(spark, bronze, f"{tmp_dir}/c", event_types=["PushEvent"])
    assert silver.dropped_columns(bronze, contracts, ["PushEvent"]) == {}
    assert contracts["push_event_df"].fieldNames()[:3] == early["push_event_df"].fieldNames()
    written = silver.build_silver(spark, bronze, contracts, f"{tmp_dir}/s", event_types=["PushEvent"])
    commits = spark.read.parquet(written["push_event_df_commits_df"])
    assert [r.message for r in commits.orderBy("pos").collect()] == ["m1", "m2"]
    assert {r.id: r.forced for r in spark.read.parquet(written["push_event_df"]).collect()} == {"1": None, "2": True}


def test_silver_files_per_day_are_bounded(spark, tmp_dir):
    bronze = tv.bronze_events(spark, SF_SMALL).repartition(23)
    profile = silver.profile_bronze(bronze)
    assert sum(p["rows"] for p in profile) == bronze.count()
    contracts = silver.ensure_contracts(spark, bronze, f"{tmp_dir}/c", event_types=TYPES, profile=profile)
    written = silver.build_silver(spark, bronze, contracts, f"{tmp_dir}/s", event_types=TYPES, profile=profile, rows_per_file=20)
    per_day = {}
    for p in profile:
        per_day[p["day"]] = per_day.get(p["day"], 0) + p["rows"]
    for d, n in per_day.items():
        files = [f for f in os.listdir(f"{written['main_df']}/day={d}") if f.endswith(".parquet")]
        assert 1 <= len(files) <= -(-n // 20)


def test_gold_without_some_event_types(spark, tmp_dir):
    from lakestrata.plans.build_gold import build_gold

    bronze = _two_days(spark).withColumns({
        "actor": F.struct(F.lit(1).alias("id"), F.lit("u").alias("login"), F.lit("u").alias("display_login")),
        "repo": F.struct(F.lit(7).cast("bigint").alias("id"), F.lit("o/p").alias("name")),
        "org": F.struct(F.lit("g").alias("login")),
    })
    types = ("PushEvent", "CommitCommentEvent")
    contracts = silver.ensure_contracts(spark, bronze, f"{tmp_dir}/c", event_types=types)
    silver.build_silver(spark, bronze, contracts, f"{tmp_dir}/s", event_types=types)
    with pytest.raises(ValueError, match="languages"):
        build_gold(spark, f"{tmp_dir}/s", f"{tmp_dir}/g")
    docs = tv.table(spark, SF_SMALL, "documents")
    from lakestrata.plans import language

    model = language.train_language_detector(docs, "text", "lang")
    language.save_detector(model, f"{tmp_dir}/detector")
    written = build_gold(spark, f"{tmp_dir}/s", f"{tmp_dir}/g", model=language.load_detector(f"{tmp_dir}/detector"))
    assert len(written) == 7
    assert spark.read.parquet(written["event_languages_df"]).count() == 1  # the push with commits
    one_day = build_gold(spark, f"{tmp_dir}/s", f"{tmp_dir}/g1", languages=False, days=("2017-01-01", "2017-01-01"))
    assert len(one_day) == 5 and spark.read.parquet(one_day["num_commits_df"]).count() == 1


def test_stream_adds_to_a_batch_root(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    rows = [{"id": str(i), "type": "click", "created_at": f"2024-01-0{1 + i % 3}T00:00:00Z"} for i in range(107)]
    schema = spark.createDataFrame(rows[:1]).select("id", "type", "created_at").schema
    for name, part in (("a", rows[:100]), ("b", rows[100:])):
        with open(f"{src}/2024-01-01-{name}.json", "w") as fh:
            fh.write("\n".join(map(json.dumps, part)) + "\n")
    bronze_plan.ingest_bronze(spark, f"{src}/2024-01-01-a.json", f"{tmp_dir}/bronze", 2, num_days=3, schema=schema)
    stream = landing_stream(spark, src, schema, path_glob="*-b.json")
    run_bronze_stream(stream, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", partitions=3)
    back = bronze_plan.read_bronze(spark, f"{tmp_dir}/bronze")
    assert sorted(int(r.id) for r in back.collect()) == list(range(107)) and "load" not in back.columns


def test_malformed_lines_are_kept_and_counted(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    with open(f"{src}/2024-01-01-0.json", "w") as fh:
        fh.write('{"id": "1", "type": "click", "created_at": "2024-01-01T00:00:00Z"}\n{"id": broken\n')
    schema = spark.createDataFrame([("1", "t", "c")], "id string, type string, created_at string").schema
    bronze_plan.ingest_bronze(spark, src, f"{tmp_dir}/bronze", {"2024-01-01": 1}, schema=schema)
    bronze = bronze_plan.read_bronze(spark, f"{tmp_dir}/bronze")
    assert bronze.count() == 2 and bronze_plan.corrupt_rows(bronze) == 1
    assert bronze.where("day is null").first()[bronze_plan.CORRUPT].strip() == '{"id": broken'

"""VARIANT payloads and reports kept from per-day partial results."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators import variant
from lakestrata.plans import gold, increments, lake
from lakestrata.plans.build_gold import FACT_SCHEMA, PUSH_SCHEMA, read_silver
from lakestrata.sinks.commits import history

HEAD = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "type", "created_at")])


def _landing(path, payloads):
    with open(path, "w") as fh:
        for i, p in enumerate(payloads):
            fh.write(json.dumps({"id": str(i), "type": "PushEvent", "created_at": "2017-01-01T00:00:00Z", "payload": p}) + "\n")


def test_shred_keeps_what_the_contract_lacks(spark, tmp_dir):
    payloads = [
        {"size": 3, "ref": "r", "comment": {"body": "b"}},
        {"size": 2.5, "ref": "r", "new": {"deep": [1, 2]}, 'odd "name': True},
        {"size": "many", "ref": None, "comment": "text", "new": 7},
        None,
        {},
        {"size": 12345678901234567, "ref": 5},
    ]
    _landing(f"{tmp_dir}/a.json", payloads)
    bronze = variant.read_events_variant(spark, f"{tmp_dir}/a.json", HEAD)
    contract = T.StructType.fromDDL("size bigint, ref string, comment struct<body:string>")
    out = variant.event_table_with_rest(bronze, "PushEvent", contract)
    assert out.columns == ["id", "created_at", "size", "ref", "comment_body", "rest"]
    out.write.parquet(f"{tmp_dir}/silver")  # rest is stored, not only computed
    back = spark.read.parquet(f"{tmp_dir}/silver").withColumn("rest", F.to_json("rest"))
    rows = {r.id: (r["size"], r.ref, r.comment_body, json.loads(r.rest) if r.rest else None) for r in back.collect()}
    assert rows == {
        "0": (3, "r", "b", None),
        "1": (None, "r", None, {"size": 2.5, "new": {"deep": [1, 2]}, 'odd "name': True}),
        "2": (None, None, None, {"size": "many", "comment": "text", "new": 7}),
        "3": (None, None, None, None),
        "4": (None, None, None, None),
        "5": (12345678901234567, "5", None, None),
    }
    wide = variant.with_rest_fields(spark.read.parquet(f"{tmp_dir}/silver"), {"new": "bigint", 'odd "name': "boolean"})
    assert {r.id: (r.new, r['odd "name']) for r in wide.collect() if r.id in "12"} == {"1": (None, True), "2": (7, None)}
    assert "new" in variant.rest_schema(out)
    with pytest.raises(ValueError, match="rest"):
        variant.event_table_with_rest(bronze, "PushEvent", T.StructType.fromDDL("rest string"))


def _events(spark, days, ids):
    kinds = ["PushEvent", "WatchEvent"]
    rows = [
        (
            str(i), kinds[i % 3 == 0], f"2017-01-{days[i % len(days)]:02d}T{i % 24:02d}:00:00Z", (i % 5, f"u{i % 5}", f"u{i % 5}"),
            (i % 3, f"o/p{i % 3}"), ("g",), (i, i % 4, ["refs/heads/master", "refs/heads/x", None][i % 3]) if i % 3 else (None, None, None),
        )
        for i in ids
    ]
    schema = (
        "id string, type string, created_at string, actor struct<id:int,login:string,display_login:string>, "
        "repo struct<id:bigint,name:string>, org struct<login:string>, payload struct<push_id:bigint,distinct_size:bigint,ref:string>"
    )
    return spark.createDataFrame(rows, schema).withColumn("day", F.substring("created_at", 1, 10))


def test_reports_of_partials_equal_the_full_run(spark, tmp_dir):
    bronze, slv, gld = f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    types = ["PushEvent", "WatchEvent"]

    def step(days, ids, load):
        lake.append_load(_events(spark, days, ids), bronze, load)
        lake.refresh_silver(spark, bronze, slv, f"{tmp_dir}/c", event_types=types)
        state = increments.refresh_gold(spark, slv, gld)
        fact, push = read_silver(spark, slv, "main_df", FACT_SCHEMA), read_silver(spark, slv, "push_event_df", PUSH_SCHEMA)
        for name, want in gold.gold_reports(fact, push, types).items():
            got = spark.read.parquet(state["reports"][name])
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
        return state["days"]

    assert step([1, 2, 8], range(60), "a") == ["2017-01-01", "2017-01-02", "2017-01-08"]
    assert step([2, 9], range(60, 90), "b") == ["2017-01-02", "2017-01-09"]  # a late load of an old day, and a new day
    assert increments.refresh_gold(spark, slv, gld) == {"days": [], "reports": {}}
    entries = history(spark, f"{gld}/partials/user_type_week")
    assert [sorted(e["days"]) for e in entries] == [["2017-01-01", "2017-01-02", "2017-01-08"], ["2017-01-02", "2017-01-09"]]


def test_only_the_changed_days_are_read(spark, tmp_dir):
    bronze, slv = f"{tmp_dir}/bronze", f"{tmp_dir}/silver"
    for day in (1, 2, 3):
        lake.append_load(_events(spark, [day], range(day * 30, day * 30 + 30)), bronze, f"d{day}")
        lake.refresh_silver(spark, bronze, slv, f"{tmp_dir}/c", event_types=["PushEvent", "WatchEvent"])
    one = read_silver(spark, slv, "main_df", FACT_SCHEMA, {"2017-01-02"})
    assert {p for f in one.inputFiles() for p in f.split("/") if p.startswith("day=")} == {"day=2017-01-02"}
    assert one.count() == 30


def test_gold_refresh_that_died_is_taken_up(spark, tmp_dir, monkeypatch):
    bronze, slv, gld = f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    lake.append_load(_events(spark, [1, 2], range(40)), bronze, "a")
    lake.refresh_silver(spark, bronze, slv, f"{tmp_dir}/c", event_types=["PushEvent", "WatchEvent"])
    real = increments.write_plain
    monkeypatch.setattr(increments, "write_plain", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        increments.refresh_gold(spark, slv, gld)
    monkeypatch.setattr(increments, "write_plain", real)
    state = increments.refresh_gold(spark, slv, gld)
    assert state["days"] == ["2017-01-01", "2017-01-02"] and len(state["reports"]) == 5
    assert len(history(spark, f"{gld}/partials/num_commits_df")) == 1  # not written twice
    hours = spark.read.parquet(state["reports"]["event_per_hour_df"])
    assert hours.agg(F.sum(F.coalesce("PushEvent", F.lit(0)) + F.coalesce("WatchEvent", F.lit(0)))).first()[0] == 40


def test_languages_are_kept_by_day(spark, tmp_dir):
    from conftest import SF_SMALL
    from lakestrata.plans.build_gold import build_gold
    from lakestrata.plans.language import train_language_detector

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = train_language_detector(docs, "text", "lang")
    bronze, slv, gld = f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    rows = docs.selectExpr(
        "cast(doc_id as string) id", "if(doc_id % 2 = 0, 'PushEvent', 'IssueCommentEvent') type",
        "concat('2017-01-0', doc_id % 3 + 1, 'T00:00:00Z') created_at", "struct('u' as login, 'u' as display_login) actor",
        "struct(doc_id as id, 'o/p' as name) repo", "struct('g' as login) org",
        "struct(doc_id as push_id, doc_id as distinct_size, 'refs/heads/x' as ref, if(doc_id % 2 = 0, array(struct(text as message)), null) as commits, "
        "if(doc_id % 2 = 1, struct(text as body), null) as comment) payload",
    ).withColumn("day", F.substring("created_at", 1, 10))
    for load, part in (("a", "doc < 100"), ("b", "doc >= 100")):
        lake.append_load(rows.withColumn("doc", F.col("id").cast("int")).where(part).drop("doc"), bronze, load)
        lake.refresh_silver(spark, bronze, slv, f"{tmp_dir}/c", event_types=["PushEvent", "IssueCommentEvent"])
        state = increments.refresh_gold(spark, slv, gld, model=model)
    full = build_gold(spark, slv, f"{tmp_dir}/full", model=model)
    for name in ("event_languages_df", "language_stats_df"):
        got, want = spark.read.parquet(state["reports"][name]), spark.read.parquet(full[name])
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns


def test_lake_of_variant_payloads(spark, tmp_dir):
    import os

    from lakestrata.sources.table import read_table

    src, bronze, slv = f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/silver"
    os.makedirs(src)
    contract = {"PushEvent": T.StructType.fromDDL("size bigint, commits array<struct<message:string>>")}
    _landing(f"{src}/2017-01-01-0.json", [{"size": 1, "commits": [{"message": "a"}, {"message": "b"}]}, {"size": 2, "new": "x"}])
    assert lake.ingest_landing(spark, src, bronze, "one", variant_head=HEAD) == 0
    assert lake.refresh_variant_silver(spark, bronze, slv, contract)["tables"] == ["main_df", "push_event_df", "push_event_df_commits_df"]
    _landing(f"{src}/2017-01-01-1.json", [{"size": 2.5, "new": {"deep": 1}}])
    assert lake.ingest_landing(spark, src, bronze, "two", variant_head=HEAD) == 1
    # a load with typed payloads unites with them
    typed = spark.createDataFrame([("9", "PushEvent", "2017-01-02T00:00:00Z", (7, "old"))], "id string, type string, created_at string, payload struct<size:int, new:string>")
    lake.append_load(typed.withColumn("day", F.substring("created_at", 1, 10)), bronze, "typed")
    assert read_table(spark, bronze).schema["payload"].dataType == T.VariantType() and read_table(spark, bronze).count() == 4
    state = lake.refresh_variant_silver(spark, bronze, slv, contract)
    assert state["days"] == ["2017-01-01", "2017-01-02"]
    push = read_silver(spark, slv, "push_event_df").withColumn("rest", F.to_json("rest"))
    got = sorted((r["size"], r.rest) if r["size"] is not None else (-1, r.rest) for r in push.collect())
    assert got == [(-1, '{"new":{"deep":1},"size":2.5}'), (1, None), (2, '{"new":"x"}'), (7, '{"new":"old"}')]
    assert [r.message for r in read_silver(spark, slv, "push_event_df_commits_df").orderBy("pos").collect()] == ["a", "b"]
    assert lake.refresh_variant_silver(spark, bronze, slv, contract)["tables"] == []

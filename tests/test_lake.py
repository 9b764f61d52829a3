"""The lake's tables with a commit log: unions of schemas, crashes, ledger, changed days, compaction."""

import gzip
import itertools
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators import contract
from lakestrata.operators.schema_union import cast_to, merge_schemas, merge_types
from lakestrata.plans import bronze as bronze_plan
from lakestrata.plans import lake, silver
from lakestrata.plans.build_gold import PUSH_SCHEMA, read_silver
from lakestrata.sinks.commits import CommitConflict, commit, files_of, history, parts_of, put_if_absent, write_commit
from lakestrata.sources.table import changed_days, read_table

L, D, S = T.LongType(), T.DoubleType(), T.StringType()


def _struct(**fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


SAMPLES = [
    T.NullType(), T.BooleanType(), T.IntegerType(), L, T.FloatType(), D, S, T.DateType(), T.TimestampType(), T.DecimalType(12, 2),
    T.VariantType(), T.ArrayType(L), T.ArrayType(D), T.MapType(S, L), _struct(a=L), _struct(a=D, b=S), _struct(b=_struct(c=L)),
]


def _sorted(t):
    if isinstance(t, T.StructType):
        return _struct(**{f.name: _sorted(f.dataType) for f in sorted(t.fields, key=lambda f: f.name)})
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_sorted(t.elementType))
    return t


def test_merge_types_is_a_join():
    for a, b, c in itertools.product(SAMPLES, repeat=3):
        assert _sorted(merge_types(a, b)) == _sorted(merge_types(b, a))
        assert _sorted(merge_types(merge_types(a, b), c)) == _sorted(merge_types(a, merge_types(b, c)))
    for a in SAMPLES:
        assert merge_types(a, a) == a
    assert merge_types(L, D) == D and merge_types(T.BooleanType(), L) == S and merge_types(_struct(a=L), L) == S


def test_schemas_allow_nulls_at_every_depth():
    strict = T.StructType([T.StructField("a", T.ArrayType(T.StructType([T.StructField("x", L, False)]), False), False)])
    assert merge_schemas([strict]) == _struct(a=T.ArrayType(_struct(x=L), True))


def test_cast_to_keeps_values(spark):
    df = spark.createDataFrame([(1, (2, [3]), {"k": 4}), (None, None, None)], "a bigint, s struct<x:bigint, y:array<bigint>>, m map<string,bigint>")
    want = merge_schemas([df.schema, T.StructType.fromDDL("a double, s struct<y:array<double>, z:string>, m map<string,string>, n date")])
    got = cast_to(df, want)
    assert got.schema.simpleString() == "struct<a:double,s:struct<x:bigint,y:array<double>,z:string>,m:map<string,string>,n:date>"
    rows = got.collect()
    assert (rows[0].a, rows[0].s.x, rows[0].s.y, rows[0].s.z, rows[0].m) == (1.0, 2, [3.0], None, {"k": "4"})
    assert rows[1].s is None and rows[1].m is None
    text = cast_to(df, T.StructType.fromDDL("s string")).collect()
    assert [r.s for r in text] == ['{"x":2,"y":[3]}', None]


def _write(path, rows):
    with gzip.open(path, "wt") as fh:
        fh.write("".join(json.dumps(r) + "\n" for r in rows))


def _event(i, day, payload, kind="PushEvent"):
    return {
        "id": str(i), "type": kind, "created_at": f"2017-01-{day:02d}T{i % 24:02d}:00:00Z", "payload": payload,
        "actor": {"id": 1, "login": "u", "display_login": "u"}, "repo": {"id": 7, "name": "o/p"}, "org": {"login": "g"},
    }


@pytest.fixture()
def two_months(spark, tmp_dir):
    """Two loads: the second fills a new push field and a new array, and a whole number became a fraction."""
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    _write(f"{src}/2017-01-01-0.json.gz", [_event(i, 1, {"push_id": i, "size": i}) for i in range(5)])
    root = f"{tmp_dir}/bronze"
    assert lake.ingest_landing(spark, src, root, "2017-01") == 0
    state = lake.refresh_silver(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/contracts", event_types=["PushEvent"])
    assert state["days"] == ["2017-01-01"]
    late = [_event(5, 1, {"push_id": 5, "size": 0.5, "distinct_size": 20, "labels": ["x", "y"]})]
    _write(f"{src}/2017-01-02-0.json.gz", late + [_event(i, 2, {"push_id": i, "size": i}) for i in range(6, 9)])
    return src, root, tmp_dir


def test_two_loads_with_unlike_schemas(spark, two_months):
    src, root, tmp = two_months
    assert lake.ingest_landing(spark, src, root, "2017-02") == 1
    assert lake.ingest_landing(spark, src, root, "2017-02") is None  # no new file
    back = read_table(spark, root)
    sizes = {r.id: r.size for r in back.select("id", "payload.size").collect()}
    assert sizes == {**{str(i): float(i) for i in (0, 1, 2, 3, 4, 6, 7, 8)}, "5": 0.5}
    assert bronze_plan.read_bronze(spark, root).count() == 9

    state = lake.refresh_silver(spark, root, f"{tmp}/silver", f"{tmp}/contracts", event_types=["PushEvent"])
    assert state["days"] == ["2017-01-01", "2017-01-02"]
    push = read_silver(spark, f"{tmp}/silver", "push_event_df", PUSH_SCHEMA)
    got = {r.id: (r.size, r.distinct_size) for r in push.collect()}
    assert got["5"] == (0.5, 20) and got["4"] == (4.0, None) and len(got) == 9
    assert push.agg(F.sum("distinct_size")).first()[0] == 20
    labels = read_silver(spark, f"{tmp}/silver", "push_event_df_labels_df")
    assert [(r.fact_id, r.pos, r.col) for r in labels.orderBy("pos").collect()] == [("5", 0, "x"), ("5", 1, "y")]
    assert read_silver(spark, f"{tmp}/silver", "main_df").count() == 9
    # the state before the second load can still be read
    assert read_table(spark, root, version=0).count() == 5
    # nothing new: nothing is done
    assert lake.refresh_silver(spark, root, f"{tmp}/silver", f"{tmp}/contracts", event_types=["PushEvent"])["tables"] == []


def test_only_changed_days_are_rewritten(spark, two_months):
    src, root, tmp = two_months
    lake.ingest_landing(spark, src, root, "2017-02")
    lake.refresh_silver(spark, root, f"{tmp}/silver", f"{tmp}/contracts", event_types=["PushEvent"])
    before = {p.folder for p in parts_of(history(spark, f"{tmp}/silver/push_event_df")) if p.days}
    _write(f"{src}/2017-01-03-0.json.gz", [_event(9, 3, {"push_id": 9})])
    version = lake.ingest_landing(spark, src, root, "2017-03")
    assert changed_days(spark, root, version - 1)[0] == ["2017-01-03"]
    state = lake.refresh_silver(spark, root, f"{tmp}/silver", f"{tmp}/contracts", event_types=["PushEvent"])
    assert state["days"] == ["2017-01-03"]
    parts = [p for p in parts_of(history(spark, f"{tmp}/silver/push_event_df")) if p.days]
    assert before < {p.folder for p in parts} and [list(p.days) for p in parts if p.folder not in before] == [["2017-01-03"]]
    assert read_silver(spark, f"{tmp}/silver", "push_event_df").count() == 10


def test_a_dead_job_leaves_nothing_to_read(spark, two_months, monkeypatch):
    src, root, tmp = two_months
    from lakestrata.sinks import commits

    def dies(*a, **k):
        raise RuntimeError("killed before its commit")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", dies)
        with pytest.raises(RuntimeError, match="killed"):
            lake.ingest_landing(spark, src, root, "2017-02")
    folders = [d for d in os.listdir(root) if d.startswith("load=")]
    assert len(folders) == 2 and read_table(spark, root).count() == 5  # its files lie there, unread
    assert lake.ledger(spark, root).count() == 1
    assert lake.ingest_landing(spark, src, root, "2017-02") == 1  # the next run reads the same files
    assert read_table(spark, root).count() == 9

    # a refresh that dies after some tables is taken up, and no table is written twice
    calls = []
    real = lake.commit

    def dies_late(*a, **k):
        calls.append(a)
        raise RuntimeError("killed")

    monkeypatch.setattr(lake, "commit", dies_late)
    with pytest.raises(RuntimeError):
        lake.refresh_silver(spark, root, f"{tmp}/silver", f"{tmp}/contracts", event_types=["PushEvent"])
    monkeypatch.setattr(lake, "commit", real)
    state = lake.refresh_silver(spark, root, f"{tmp}/silver", f"{tmp}/contracts", event_types=["PushEvent"])
    assert state["tables"] == [] and read_silver(spark, f"{tmp}/silver", "main_df").count() == 9


def test_changed_landing_file_is_refused(spark, two_months):
    src, root, _ = two_months
    _write(f"{src}/2017-01-01-0.json.gz", [_event(1, 1, {"push_id": 1, "size": 123456})])
    with pytest.raises(ValueError, match="changed"):
        lake.ingest_landing(spark, src, root, "2017-02")


def test_concurrent_writers(spark, tmp_dir):
    path = f"{tmp_dir}/log/x.json"
    assert put_if_absent(spark, path, "a") and not put_if_absent(spark, path, "b")
    with open(path) as fh:
        assert fh.read() == "a"
    root = f"{tmp_dir}/t"
    df = spark.createDataFrame([("1", "2017-01-01"), ("2", "2017-01-02")], "id string, day string")
    assert write_commit(df, root, "a") == 0 and write_commit(df, root, "b") == 1
    part = parts_of(history(spark, root))[0]
    entry = {"kind": "compact", "load": "c", "folder": None, "schema": None, "days": {}, "replaces": [[part.folder, "2017-01-01"]], "about": {}}
    assert commit(spark, root, entry) == 2
    with pytest.raises(CommitConflict):  # what it replaces is gone
        commit(spark, root, entry)
    assert read_table(spark, root).count() == 3
    assert [p.all_days for p in parts_of(history(spark, root))] == [False, True]


def test_two_ingests_of_the_same_files(spark, two_months, monkeypatch):
    src, root, _ = two_months
    real, second = lake.write_commit, []

    def other_first(*a, **k):
        if not second:
            second.append(True)
            lake.ingest_landing(spark, src, root, "other")  # another job wins
        return real(*a, **k)

    monkeypatch.setattr(lake, "write_commit", other_first)
    with pytest.raises(CommitConflict):
        lake.ingest_landing(spark, src, root, "mine")
    assert read_table(spark, root).count() == 9


def test_stored_profiles_equal_a_pass_over_bronze(spark, two_months):
    src, root, _ = two_months
    lake.ingest_landing(spark, src, root, "2017-02")

    def plain(profile):
        return sorted(
            (p["type"], p["day"], p["rows"], sorted((k, v) for k, v in p["filled"].items() if v), sorted((k, v) for k, v in p["elements"].items() if v))
            for p in profile
        )

    want = plain(silver.profile_bronze(read_table(spark, root)))
    assert plain(lake.stored_profile(spark, root)) == want
    assert plain(lake.stored_profile(spark, root, ["2017-01-02"])) == [p for p in want if p[1] == "2017-01-02"]


def test_compaction_bounds_the_files(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    schema = "id string, type string, created_at string, payload struct<n:bigint>, day string"
    for i in range(30):
        df = spark.createDataFrame([(str(i * 10 + j), "click", "c", (j,), f"2017-01-0{1 + j % 3}") for j in range(10)], schema)
        lake.append_load(df.coalesce(1), root, f"batch-{i}")
    assert lake.append_load(df.coalesce(1), root, "batch-29") == 29  # a retried batch adds nothing
    rows = sorted(map(tuple, read_table(spark, root).select("id", "payload.n", "day").collect()))
    assert lake.day_files(spark, root).count() == 90
    version = lake.compact(spark, root)
    assert version == 30 and lake.day_files(spark, root).count() == 3
    assert sorted(map(tuple, read_table(spark, root).select("id", "payload.n", "day").collect())) == rows
    assert lake.compact(spark, root) is None
    assert changed_days(spark, root, 29)[0] == []  # no rows changed
    assert read_table(spark, root, version=29).count() == 300  # a reader of the state before still finds its files
    assert sum(p["rows"] for p in lake.stored_profile(spark, root)) == 300
    # files that are large enough for the target stay, smaller ones are joined
    size = files_of(spark, f"{root}/{parts_of(history(spark, root))[-1].folder}").agg(F.max("length")).first()[0]
    df = spark.createDataFrame([("x", "click", "c", (1,), "2017-01-01")], schema)
    lake.append_load(df, root, "late-1")
    lake.append_load(df, root, "late-2")
    assert lake.compaction_plan(spark, root, target_bytes=size) == {}
    assert {d: (len(f), n) for d, (f, n) in lake.compaction_plan(spark, root, target_bytes=4 * size).items()} == {"2017-01-01": (3, 1)}


def test_repeated_compaction_leaves_large_folders_until_they_grow(spark, monkeypatch):
    folders, written = {}, 0
    schema = "path string, length bigint, folder string, day string"
    monkeypatch.setattr(lake, "day_files", lambda *_: spark.createDataFrame([(f, n, f, "2017-01-01") for f, n in folders.items()], schema))
    for i in range(24):
        folders[f"batch-{i:02d}"] = 12_000 + i
        if i % 2:
            for _, (some, need) in lake.compaction_plan(spark, "t", 1_280_000, growth=3).items():
                assert need == 1
                written += (size := sum(folders.pop(f) for f in some))
                folders[f"compact-{i}"] = size
    assert sum(folders.values()) == sum(12_000 + i for i in range(24))
    assert len(folders) <= 8 and written < 2 * sum(folders.values())  # rewriting all of it each time would be 6.5 times


def test_rows_without_a_day(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    df = spark.createDataFrame([("1", None), ("2", "2017-01-02")], "id string, day string")
    write_commit(df, root, "a")
    assert {r.id: r.day for r in read_table(spark, root).collect()} == {"1": None, "2": "2017-01-02"}
    assert [r.id for r in read_table(spark, root, days=("2017-01-01", "2017-01-31")).collect()] == ["2"]
    write_commit(df.limit(0), root, "nothing")
    assert read_table(spark, root).count() == 2
    assert read_table(spark, root, days=set()).columns == ["id", "day"]


def test_plain_bronze_loads_with_unlike_types(spark, tmp_dir):
    for load, value in (("a", "cast(id as bigint)"), ("b", "cast(id as double) / 2")):
        df = spark.range(3).selectExpr("cast(id as string) id", "'t' type", f"struct({value} as size) as payload", "'2017-01-01' as day")
        from lakestrata.sinks.parquet import write_bounded_by_day

        write_bounded_by_day(df, f"{tmp_dir}/b", {"2017-01-01": 1}, mode="overwrite", load=load)
    back = bronze_plan.read_bronze(spark, f"{tmp_dir}/b")
    assert sorted(r.size for r in back.select("payload.size").collect()) == [0.0, 0.0, 0.5, 1.0, 1.0, 2.0]


def test_contract_versions(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/c"
    assert contract.load_contracts(spark, path) == {}
    contract.save_contracts(spark, {"t": _struct(a=L)}, path)
    contract.save_contracts(spark, {"t": _struct(a=D)}, path)
    assert contract.load_contracts(spark, path) == {"t": _struct(a=D)}

    def dies(*a, **k):
        raise RuntimeError("killed")

    monkeypatch.setattr(contract, "put_if_absent", dies)
    with pytest.raises(RuntimeError):
        contract.save_contracts(spark, {}, path)
    assert contract.load_contracts(spark, path) == {"t": _struct(a=D)}
    monkeypatch.undo()
    monkeypatch.setattr(contract, "put_if_absent", lambda *a: False)
    with pytest.raises(CommitConflict):
        contract.save_contracts(spark, {}, path)


def test_scratch_tables_are_released(spark):
    from lakestrata.session import checkpoint_root, release_scratch, scratch_dir

    path, other = scratch_dir(spark, "kept"), f"{checkpoint_root(spark)}/lakestrata/another-application/t"
    spark.range(3).write.parquet(path)
    spark.range(3).write.parquet(other)
    assert spark.read.parquet(path).count() == 3
    assert release_scratch(spark) and not os.path.exists(path) and os.path.exists(other)
    assert not release_scratch(spark)


def test_a_long_stream_leaves_few_files(spark, tmp_dir):
    from lakestrata.streaming.ingest import landing_stream, run_lake_stream

    src, root = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    os.makedirs(src)
    for i in range(40):
        _write(f"{src}/2017-01-01-{i}.json.gz", [_event(i * 5 + j, 1 + j % 3, {"push_id": i}) for j in range(5)])
    schema = spark.read.json(src).schema
    run = lambda: run_lake_stream(
        landing_stream(spark, src, schema, max_files_per_trigger=1), root, f"{tmp_dir}/checkpoint", compact_every=8
    )
    run()
    assert sorted(int(r.id) for r in read_table(spark, root).collect()) == list(range(200))
    kinds = [e["kind"] for e in history(spark, root)]
    assert kinds.count("append") == 40 and kinds.count("compact") == 5
    assert lake.day_files(spark, root).count() == 3  # one a day, after 40 micro-batches
    run()  # nothing new
    assert len(history(spark, root)) == 45 and read_table(spark, root).count() == 200
    # the stream's loads feed the same refresh as batch loads
    state = lake.refresh_silver(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/contracts", event_types=["PushEvent"])
    assert len(state["days"]) == 3 and read_silver(spark, f"{tmp_dir}/silver", "push_event_df").count() == 200


def test_long_logs_are_summed_up(spark, tmp_dir, monkeypatch):
    from lakestrata.sinks import commits

    monkeypatch.setattr(commits, "SUMMARY", 4)
    entry = {"kind": "append", "load": "x", "folder": None, "schema": None, "days": {}, "replaces": [], "about": {}}
    for i in range(11):
        assert commit(spark, f"{tmp_dir}/t", {**entry, "load": str(i)}) == i
    names = os.listdir(f"{tmp_dir}/t/_log")
    assert sum(n.startswith("upto-") for n in names) == 2
    reads = []
    real = commits.read_small
    monkeypatch.setattr(commits, "read_small", lambda s, p: (reads.append(p), real(s, p))[1])
    assert [(e["version"], e["load"]) for e in history(spark, f"{tmp_dir}/t")] == [(i, str(i)) for i in range(11)]
    assert len(reads) == 4  # one summary of eight entries, three later ones
    assert history(spark, f"{tmp_dir}/nothing") == []


def test_jobs_command_line(spark, two_months, capsys):
    from lakestrata import jobs

    src, root, tmp = two_months
    said = lambda: json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    jobs.main(["ingest", "--landing", src, "--bronze", root, "--load", "2017-02"])
    assert said() == {"version": 1}
    jobs.main(["ingest", "--landing", src, "--bronze", root, "--load", "2017-02"])
    assert said() == {"version": None}
    jobs.main(["refresh", "--bronze", root, "--silver", f"{tmp}/silver", "--contracts", f"{tmp}/contracts", "--types", "PushEvent"])
    assert said()["days"] == ["2017-01-01", "2017-01-02"]
    jobs.main(["compact", "--table", root])
    assert said() == {"version": 2}  # the first day lay in two loads' files
    jobs.main(["gold", "--silver", f"{tmp}/silver", "--gold", f"{tmp}/gold", "--no-languages"])
    assert spark.read.parquet(said()["num_commits_df"]).count() == 9
    assert read_table(spark, root).count() == 9

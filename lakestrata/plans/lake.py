"""The lake as tables with a commit log: each run does only what is new.

- ``ingest_landing``: the landing files that no committed ledger names → one load of bronze, with its ledger
  and its profile (rows and filled fields of every type and day) beside it;
- ``refresh_silver``: the days that bronze loads touched since the last refresh → every silver table, replacing
  those days; contracts come from the stored profiles, no pass over older bronze;
- ``compact``: days with more files than their bytes need → the same rows in fewer files.

All three may be killed at any moment: what is not committed is not read, and the next run does it again.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import event_table_name
from lakestrata.operators.contract import load_contracts, save_contracts, widen_contracts
from lakestrata.operators.schema_union import merge_schemas
from lakestrata.operators.variant import event_table_with_rest, read_events_variant
from lakestrata.plans import bronze as bronze_plan
from lakestrata.plans import silver
from lakestrata.sinks.commits import NO_DAY, CommitConflict, Part, commit, files_of, history, parts_of, write_commit
from lakestrata.sinks.parquet import BRONZE_ROW_GROUP_BYTES, DAY, spread_by_day
from lakestrata.sources.landing import CORRUPT, list_landing, read_events_json
from lakestrata.sources.table import changed_days, empty_table, read_parts, read_table

LEDGER = "_ledger"
PROFILE = "_profile"
LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modificationTime", T.TimestampType())
])
PROFILE_SCHEMA = "type string, day string, rows bigint, filled map<string,bigint>, elements map<string,bigint>"


# ---------------------------------------------------------------- ledger and ingest
def ledger(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime, load) of every landing file that a committed load has read."""
    entries = [e for e in history(spark, root) if e["about"].get("ledger")]
    if not entries:
        return empty_table(spark, T.StructType([*LEDGER_SCHEMA.fields, T.StructField("load", T.StringType())]))
    paths = [f"{root.rstrip('/')}/{e['about']['ledger']}" for e in entries]
    wanted = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(wanted).parquet(*paths)


def new_files(spark: SparkSession, inventory: DataFrame, root: str) -> DataFrame:
    """Files of ``inventory`` that no committed load has read. A file that was read and has changed since raises:
    its old rows cannot be told from its new ones."""
    seen = ledger(spark, root)
    both = inventory.join(seen.select("path", F.col("length").alias("l"), F.col("modificationTime").alias("m")), "path")
    changed = both.where((F.col("length") != F.col("l")) | (F.col("modificationTime") != F.col("m")))
    some = changed.select("path").limit(3).collect()
    if some:
        raise ValueError(f"landing files changed after they were read: {[r['path'] for r in some]}")
    return inventory.join(seen.select("path"), "path", "left_anti")


def write_profile(bronze: DataFrame, path: str) -> str:
    """The profile of ``bronze`` as a small table at ``path`` (one grouped pass)."""
    rows = silver.profile_bronze(bronze)  # types x days rows
    data = [(r["type"], r["day"], r["rows"], {k: v for k, v in r["filled"].items() if v}, r["elements"]) for r in rows]
    bronze.sparkSession.createDataFrame(data, PROFILE_SCHEMA).coalesce(1).write.json(path)
    return path


def stored_profile(spark: SparkSession, root: str, days: Iterable[str] | None = None) -> list[dict]:
    """The profiles of all loads merged, as ``silver.profile_bronze`` would give them, without reading a row of
    bronze. Days that a later entry replaced are left out."""
    entries = {e["folder"]: e for e in history(spark, root)}
    wanted = None if days is None else set(days)
    live, paths = [], []
    for p in _rows_of(entries.values()):
        path = entries[p.folder]["about"].get("profile")
        if path is None:
            raise ValueError(f"load {p.load} has no stored profile")
        paths.append(f"{root.rstrip('/')}/{path}")
        live += [(path, d) for d in p.days if wanted is None or d in wanted]
    if not live:
        return []
    rows = spark.read.schema(PROFILE_SCHEMA).json(paths).withColumn("source", F.regexp_extract(F.input_file_name(), rf"({PROFILE}/[^/]+)/", 1))
    keep = spark.createDataFrame(live, "source string, d string")
    rows = rows.join(keep, (F.coalesce("day", F.lit(NO_DAY)) == F.col("d")) & (rows["source"] == keep["source"]), "left_semi")
    merged: dict[tuple, dict] = {}
    for r in rows.collect():  # types x days x loads rows
        to = merged.setdefault((r["type"], r["day"]), {"type": r["type"], "day": r["day"], "rows": 0, "filled": {}, "elements": {}})
        to["rows"] += r["rows"]
        for name in ("filled", "elements"):
            for k, v in (r[name] or {}).items():
                to[name][k] = to[name].get(k, 0) + v
    names = {k for m in merged.values() for k in m["elements"]}
    for m in merged.values():
        m["elements"] = {k: m["elements"].get(k, 0) for k in sorted(names)}
    return list(merged.values())


def _rows_of(entries: Iterable[dict]) -> list[Part]:
    """The folders whose loads' rows count, leaving compactions (which move rows, not change them) aside."""
    return parts_of([{**e, "replaces": []} for e in entries if e["kind"] != "compact"])


def _not_read_meanwhile(spark: SparkSession, root: str, mine: DataFrame, known: int):
    """A check for ``commit``: no load committed since version ``known`` has read one of the files."""

    def check(entries: list[dict]) -> None:
        later = [e["about"]["ledger"] for e in entries if e["version"] > known and e["about"].get("ledger")]
        if later:
            other = spark.read.schema(LEDGER_SCHEMA).parquet(*[f"{root.rstrip('/')}/{p}" for p in later])
            if not mine.join(other.select("path"), "path", "left_semi").isEmpty():
                raise CommitConflict("another load has read the same landing files")

    return check


def ingest_landing(
    spark: SparkSession,
    src: str,
    root: str,
    load: str,
    *,
    schema: T.StructType | None = None,
    sampling_ratio: float | None = None,
    variant_head: T.StructType | None = None,
    target_bytes: int = bronze_plan.TARGET_FILE_BYTES,
) -> int | None:
    """Read the landing files that are new into bronze at ``root`` as one load; its version, or None if there
    is no new file. The load has the schema that its own files show (or ``schema``); readers unite the loads'.

    With ``variant_head`` (the columns beside the payload) the payload is stored as one VARIANT: no byte is read to infer
    a schema and no field is lost; ``refresh_variant_silver`` types it."""
    base, before = root.rstrip("/"), history(spark, root)
    name = f"{load}.{len(before)}"
    fresh = new_files(spark, list_landing(spark, src), root)
    at = f"{LEDGER}/{name}-{_tag()}"
    fresh.select("path", "length", "modificationTime").withColumn("load", F.lit(load)).write.parquet(f"{base}/{at}")
    mine = spark.read.schema(LEDGER_SCHEMA).parquet(f"{base}/{at}")  # from here on the list is fixed
    paths = [r["path"] for r in mine.select("path").collect()]  # names of one load's files
    if not paths:
        return None
    named = mine.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    plan = bronze_plan.per_day_plan(named, target_bytes=target_bytes)
    if variant_head is not None:
        events = read_events_variant(spark, paths, variant_head)
    else:
        events = read_events_json(spark, paths, schema, sampling_ratio, CORRUPT if schema is not None else None)
    rows = bronze_plan.to_bronze(events)
    if plan:
        spread = spread_by_day(rows, plan)
    else:  # names that tell no day: as many tasks as the bytes need
        n = math.ceil(mine.agg(F.sum("length")).first()[0] * bronze_plan.PARQUET_TO_JSON_RATIO / target_bytes)
        spread = rows.repartition(max(1, n), DAY, F.pmod(F.xxhash64("id"), F.lit(max(1, n)))).sortWithinPartitions(DAY, "type")
    return write_commit(
        spread, root, load, about={"ledger": at}, row_group_bytes=BRONZE_ROW_GROUP_BYTES,
        check=_not_read_meanwhile(spark, root, mine, before[-1]["version"] if before else -1),
        before_commit=None if variant_head is not None else lambda folder: {"profile": _profile_of(spark, base, folder)},
    )


def append_load(bronze: DataFrame, root: str, load: str, files_per_day=None) -> int:
    """Bronze rows that are already a table as one load of ``root``, with its profile. A load of that name that
    is already committed is left as it is (a retried batch adds nothing)."""
    spark, base = bronze.sparkSession, root.rstrip("/")
    for e in history(spark, root):
        if e["load"] == load and e["kind"] == "append":
            return e["version"]

    def once(entries: list[dict]) -> None:
        if any(e["load"] == load and e["kind"] == "append" for e in entries):
            raise CommitConflict(f"load {load} was committed by another writer")

    spread = bronze if files_per_day is None else spread_by_day(bronze, files_per_day)
    return write_commit(
        spread, root, load, row_group_bytes=BRONZE_ROW_GROUP_BYTES, check=once,
        before_commit=lambda folder: {"profile": _profile_of(spark, base, folder)},
    )


def _tag() -> str:
    import uuid

    return uuid.uuid4().hex[:12]


def _profile_of(spark: SparkSession, base: str, folder: str) -> str:
    at = f"{PROFILE}/{folder.rsplit('/', 1)[1].split('=', 1)[1]}"
    write_profile(spark.read.parquet(folder), f"{base}/{at}")
    return at


# ---------------------------------------------------------------- silver of the changed days
def bronze_schema(spark: SparkSession, root: str) -> T.StructType:
    """The union of all loads' schemas."""
    return merge_schemas(p.schema for p in parts_of(history(spark, root)))


def lake_contracts(
    spark: SparkSession, bronze_root: str, contracts_path: str, event_types: Sequence[str] = silver.EVENT_TYPES, keep: Iterable[str] = ()
) -> dict:
    """Stored contracts widened by what the stored profiles say is filled, stored again if that changed them."""
    bronze = empty_table(spark, bronze_schema(spark, bronze_root))
    stored = load_contracts(spark, contracts_path)
    learnt = silver.learn_contracts(bronze, event_types, keep=keep, profile=stored_profile(spark, bronze_root))
    merged = widen_contracts(stored, learnt)
    if merged != stored:
        save_contracts(spark, merged, contracts_path)
    return merged


def _replaced(parts: list[Part], days: set[str]) -> list[tuple[str, str]]:
    return [(p.folder, d) for p in parts for d in p.days if d in days]


def refresh_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    contracts_path: str,
    *,
    event_types: Sequence[str] = silver.EVENT_TYPES,
    keep: Iterable[str] = (),
    rows_per_file: int = silver.ROWS_PER_FILE,
    max_concurrent: int = 4,
) -> dict:
    """Bring every silver table up to the bronze log. Only days that loads wrote since the last refresh are read
    and rewritten; ``{"version", "days", "tables"}`` says what was done.

    The refresh is an entry of its own in ``silver_root``'s log, put after all tables; each table's entry names the
    bronze version, so a refresh that died half-way is taken up where it stopped.
    """
    base = silver_root.rstrip("/")
    days, version = changed_days(spark, bronze_root, _last_refresh(spark, base))
    if not days:
        return {"version": version, "days": [], "tables": []}
    contracts = lake_contracts(spark, bronze_root, contracts_path, event_types, keep)
    bronze = read_table(spark, bronze_root, days=set(days), version=version)
    bronze = bronze.withColumn(DAY, F.col(DAY).cast("date"))
    profile = [p for p in stored_profile(spark, bronze_root, days) if p["rows"]]
    tables = silver.silver_tables(bronze, contracts, profile, event_types)
    return _replace_days(spark, base, tables, days, version, rows_per_file, max_concurrent)


def refresh_variant_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    contracts: dict[str, T.StructType],
    *,
    rows_per_file: int = silver.ROWS_PER_FILE,
    max_concurrent: int = 4,
) -> dict:
    """``refresh_silver`` for bronze whose payload is a VARIANT. ``contracts``: event type → the payload fields that become
    columns; everything else is in the table's ``rest``, queryable without bronze. Arrays of a contract become
    child tables as ever, and the fact table has the columns beside the payload."""
    base = silver_root.rstrip("/")
    days, version = changed_days(spark, bronze_root, _last_refresh(spark, base))
    if not days:
        return {"version": version, "days": [], "tables": []}
    bronze = read_table(spark, bronze_root, days=set(days), version=version)
    counts: dict[str, dict] = {}
    for r in bronze.groupBy("type", DAY).count().collect():  # types x days rows, from two columns
        counts.setdefault(r["type"], {})[r[DAY]] = r["count"]
    tables: dict[str, tuple] = {}
    for event_type, contract in contracts.items():
        if event_type in counts:
            name = event_table_name(event_type)
            parent, children = silver.split_event_table(event_table_with_rest(bronze, event_type, contract), name)
            tables[name] = (parent, F.col("id"), counts[event_type])
            tables |= {n: (child, F.struct("fact_id", "pos"), counts[event_type]) for n, child in children.items()}
    per_day: dict[str | None, int] = {}
    for by in counts.values():
        for d, n in by.items():
            per_day[d] = per_day.get(d, 0) + n
    tables[silver.FACT_TABLE] = (silver.build_fact(bronze), F.col("id"), per_day)
    return _replace_days(spark, base, tables, days, version, rows_per_file, max_concurrent)


def _last_refresh(spark: SparkSession, base: str) -> int | None:
    done = [e for e in history(spark, base) if e["kind"] == "refresh"]
    return done[-1]["about"]["source_version"] if done else None


def _replace_days(
    spark: SparkSession, base: str, tables: dict[str, tuple], days: list[str], version: int, rows_per_file: int, max_concurrent: int
) -> dict:
    """Put the tables' rows in place of what their days held, each table in a commit of its own, then the refresh entry."""

    def write(name: str) -> str | None:
        df, key, counts = tables[name]
        entries = history(spark, f"{base}/{name}")
        if any(e["about"].get("source_version") == version for e in entries):
            return None  # by the run that died
        files = {d: max(1, math.ceil(n / rows_per_file)) for d, n in counts.items() if d is not None and n}
        rows = spread_by_day(df, files, key=key) if files else df
        replaces = _replaced(parts_of(entries), set(days))
        write_commit(rows, f"{base}/{name}", f"v{version}", kind="replace", replaces=replaces, about={"source_version": version})
        return name

    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        written = [n for n in pool.map(write, sorted(tables)) if n]
    about = {"source_version": version, "tables": sorted(tables), "days": days}
    commit(spark, base, {"kind": "refresh", "load": f"v{version}", "folder": None, "schema": None, "days": {}, "replaces": [], "about": about})
    return {"version": version, "days": days, "tables": written}


# ---------------------------------------------------------------- compaction
def day_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, folder, day) of the files that count now."""
    live = [(p.folder, d) for p in parts_of(history(spark, root)) for d in p.days]
    if not live:
        return empty_table(spark, T.StructType([T.StructField(c, T.StringType()) for c in ("path", "length", "folder", DAY)]))
    keep = spark.createDataFrame(live, f"folder string, {DAY} string")
    return files_of(spark, root).join(keep, ["folder", DAY], "left_semi")


def compaction_plan(spark: SparkSession, root: str, target_bytes: int, growth: float | None = None) -> dict[str, tuple[list[str], int]]:
    """Per day the folders whose files are small (on average below half of the target) and in how many files
    their bytes fit; days that would keep as many files as they have are left out.

    With ``growth`` a folder of more than 1/128 of the target is taken only together with smaller ones of at least ``growth``
    times its bytes, so that a row's folder grows by that much whenever the row is rewritten."""
    sizes = day_files(spark, root).groupBy(DAY, "folder").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    small = sizes.where(F.col("bytes") < F.col("files") * F.lit(target_bytes / 2))
    days: dict[str, list] = {}
    for r in small.collect():  # a row a day and folder that is still small
        days.setdefault(r[DAY], []).append((r["bytes"], r["folder"], r["files"]))
    out = {}
    for day, folders in days.items():
        folders.sort()
        if growth is not None:
            while folders and folders[-1][0] > target_bytes / 128 and folders[-1][0] * growth > sum(n for n, _, _ in folders[:-1]):
                folders.pop()
        need = max(1, math.ceil(sum(n for n, _, _ in folders) / target_bytes))
        if need < sum(files for _, _, files in folders):
            out[day] = (sorted(f for _, f, _ in folders), need)
    return out


def compact(
    spark: SparkSession, root: str, *, target_bytes: int = bronze_plan.TARGET_FILE_BYTES, key: str = "id", growth: float | None = None
) -> int | None:
    """Rewrite days that lie in more files than their bytes need; the new version, or None if none does. Rows,
    schema and every earlier version stay as they are; files of old folders are left for readers that hold them.
    ``growth`` is for jobs that compact again and again (see ``compaction_plan``)."""
    plan = compaction_plan(spark, root, target_bytes, growth)
    if not plan:
        return None
    chosen = {(f, d) for d, (folders, _) in plan.items() for f in folders}
    parts = [
        Part(p.folder, p.load, p.version, p.schema, {d: x for d, x in p.days.items() if (p.folder, d) in chosen}, False)
        for p in parts_of(history(spark, root))
    ]
    parts = [p for p in parts if p.days]
    rows = read_parts(spark, root, parts).drop("load")
    spread = spread_by_day(rows, {d: n for d, (_, n) in plan.items()}, key=key)
    return write_commit(spread, root, "compact", kind="compact", replaces=[(p.folder, d) for p in parts for d in p.days], row_group_bytes=BRONZE_ROW_GROUP_BYTES)

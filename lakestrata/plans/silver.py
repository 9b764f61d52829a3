"""Bronze → silver (PL2-PL7): one flat fact table, one flat table per event type, one child table
per array column, all held to stored contracts and partitioned by ``day``.

Design for scale:

- no cache of the whole bronze month: each event table is its own scan with ``type = …`` pushed to
  Parquet and only the ``payload`` fields its contract names read (nested column pruning);
- one grouped pass over all the bronze given (``profile_bronze``: rows, filled payload fields and array
  elements of every type and day) both decides the contracts and sizes the files; stored contracts
  are widened by new fields, so a field or array that only late days fill is not lost;
- every table is written with a bounded number of files a day, planned from those counts;
- an event table with array columns is written as a parent and child tables; they are NOT cached:
  nested column pruning gives each write its own disjoint slice of the payload (the parent reads
  the scalar fields, each child only its array), so two pruned scans read about what one scan
  would, without holding a large share of the month in executor memory or local disk.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import child_table_name, event_table_name
from lakestrata.functions.timefmt import add_day
from lakestrata.operators.arrays import EVENT_TIME, split_arrays
from lakestrata.operators.columns import drop_all_null, drop_by_pattern
from lakestrata.operators.contract import conform, contract_of, load_contracts, save_contracts, widen_contracts
from lakestrata.operators.flatten import flatten_all, flatten_once, struct_children
from lakestrata.plans.bronze import CORRUPT
from lakestrata.sinks.parquet import DAY, spread_by_day, write_partitioned

# Fixed list of the event types that get their own table (the type without columns is left out).
EVENT_TYPES = (
    "PushEvent",
    "GollumEvent",
    "ReleaseEvent",
    "CommitCommentEvent",
    "CreateEvent",
    "PullRequestReviewCommentEvent",
    "IssueCommentEvent",
    "DeleteEvent",
    "IssuesEvent",
    "ForkEvent",
    "MemberEvent",
    "WatchEvent",
    "PullRequestEvent",
)
FACT_TABLE = "main_df"
EVENT_KEYS = ("id", "created_at")
ROWS_PER_FILE = 1_000_000


def extract_event(
    bronze: DataFrame,
    event_type: str,
    sample_rows: int | None = None,
    drop_null: bool = True,
    wanted: Sequence[str] | None = None,
    clash_prefix: str | None = None,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Flat table of one event type: ``id, created_at`` then its payload fields.

    The payload is lifted one level without its prefix, columns that are null in every row are
    dropped (one aggregate job), then every remaining struct is flattened with prefixes. Arrays
    stay for ``split_arrays``. With ``wanted`` (the columns of a contract) no profiling job runs:
    only the lifted fields that can produce a wanted column are kept before the full flatten; with
    ``fields`` (payload fields known to be filled) exactly those are.
    ``sample_rows`` limits the input (contract learning only). A payload field named like a key
    column (``id``) makes the lift raise, naming it; with ``clash_prefix`` (e.g. ``"payload_"``)
    only the clashing fields get that prefix instead.
    """
    df = bronze.where(F.col("type") == event_type).select(*EVENT_KEYS, "payload")
    if sample_rows is not None:
        df = df.limit(sample_rows)
    in_payload = struct_children(df, "payload")
    if fields is not None:
        in_payload = [f for f in in_payload if f in set(fields)]
    if fields is not None or (clash_prefix and any(f in EVENT_KEYS for f in in_payload)):
        renamed = [F.col("payload").getField(f).alias(clash_prefix + f if clash_prefix and f in EVENT_KEYS else f) for f in in_payload]
        if not renamed:
            return df.drop("payload")
        df = df.select(*EVENT_KEYS, F.struct(*renamed).alias("payload"))
    df = flatten_once(df, keep_parent_name=False)
    if fields is not None:
        pass
    elif wanted is not None:
        names = set(wanted)
        df = df.select(*[
            F.col(f"`{c}`") for c in df.columns
            if c in EVENT_KEYS or c in names or any(n.startswith(c + "_") for n in names)
        ])
    elif drop_null:
        df = drop_all_null(df, keep=EVENT_KEYS)
    return flatten_all(df)


def build_fact(bronze: DataFrame, contract=None) -> DataFrame:
    """The fact table: bronze without ``payload``, structs flattened ONE level, link and avatar
    columns dropped (or held to ``contract``), plus ``day``."""
    df = flatten_once(bronze.drop("payload", "day", CORRUPT))
    df = conform(df, contract) if contract is not None else drop_by_pattern(df)
    return add_day(df, "created_at")


def event_table(bronze: DataFrame, event_type: str, contract=None) -> DataFrame:
    """One event type as a flat table held to ``contract`` (arrays included), or without a contract
    with all-null and link columns dropped."""
    if contract is None:
        return drop_by_pattern(extract_event(bronze, event_type))
    return conform(extract_event(bronze, event_type, wanted=contract.fieldNames()), contract)


def split_event_table(
    event: DataFrame,
    table_name: str,
    contracts: dict | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Event table → (parent without arrays, {child table: df}), each with its ``day`` column.

    Child tables are held to their contracts too, or cleaned of link columns without one.
    """
    parent, children = split_arrays(event, table_name)
    out_children = {}
    for child_name, child in children.items():
        child_contract = (contracts or {}).get(child_name)
        child = conform(child, child_contract) if child_contract is not None else drop_by_pattern(child)
        out_children[child_name] = add_day(child, EVENT_TIME)
    return add_day(parent, "created_at"), out_children


def build_event_tables(
    bronze: DataFrame,
    event_type: str,
    contracts: dict | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One event type → (event table without arrays, {child table: df}), all with ``day``."""
    name = event_table_name(event_type)
    event = event_table(bronze, event_type, (contracts or {}).get(name))
    return split_event_table(event, name, contracts)


def profile_bronze(bronze: DataFrame) -> list[dict]:
    """One row for every (type, day) of bronze, from a single grouped pass with map-side partial
    aggregation: ``type``, ``day``, ``rows``, ``filled`` (payload field → rows that fill it) and
    ``elements`` (array field → number of its elements)."""
    if DAY not in bronze.columns:
        bronze = add_day(bronze, "created_at")
    fields = bronze.schema["payload"].dataType.fields
    arrays = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
    payload = F.col("payload")
    counts = [F.count(payload.getField(f.name)).alias(f"f{i}") for i, f in enumerate(fields)]
    sizes = [
        F.coalesce(F.sum(F.when(payload.getField(a).isNotNull(), F.size(payload.getField(a)))), F.lit(0)).alias(f"a{i}")
        for i, a in enumerate(arrays)
    ]
    grouped = bronze.groupBy("type", F.col(DAY).cast("string").alias(DAY)).agg(F.count(F.lit(1)).alias("rows"), *counts, *sizes)
    return [
        {
            "type": r["type"], "day": r[DAY], "rows": r["rows"],
            "filled": {f.name: r[f"f{i}"] for i, f in enumerate(fields)},
            "elements": {a: r[f"a{i}"] for i, a in enumerate(arrays)},
        }
        for r in grouped.collect()  # types × days rows
    ]


def learn_contracts(
    bronze: DataFrame,
    event_types: Sequence[str] = EVENT_TYPES,
    include_fact: bool = True,
    keep: Iterable[str] = (),
    profile: list[dict] | None = None,
) -> dict:
    """Contracts for every event table, child table and the fact table, from all of ``bronze``.

    A payload field belongs to a type's table when any row of that type fills it, on whatever day;
    one grouped pass (``profile_bronze``) tells that for all types at once. A type without rows gets
    no contract. Columns named in ``keep`` survive the drop by name pattern.
    """
    keep = tuple(keep)
    profile = profile_bronze(bronze) if profile is None else profile
    contracts = {}
    for event_type in event_types:
        mine = [p for p in profile if p["type"] == event_type]
        if not mine:
            continue
        filled = {f for p in mine for f, n in p["filled"].items() if n}
        name = event_table_name(event_type)
        event = extract_event(bronze, event_type, fields=sorted(filled))
        contracts[name] = contract_of(drop_by_pattern(event, keep))
        _, children = split_arrays(event, name)
        for child_name, child in children.items():
            contracts[child_name] = contract_of(drop_by_pattern(child, keep))
    if include_fact:
        fact = flatten_once(bronze.drop("payload", "day", CORRUPT))
        contracts[FACT_TABLE] = contract_of(drop_by_pattern(fact, keep))
    return contracts


def ensure_contracts(
    spark: SparkSession,
    bronze: DataFrame,
    contracts_path: str,
    event_types: Sequence[str] = EVENT_TYPES,
    keep: Iterable[str] = (),
    profile: list[dict] | None = None,
) -> dict:
    """Stored contracts, widened by whatever ``bronze`` fills beyond them, and stored again if that
    changed anything. Stored columns keep their order and types (numeric ones may get wider)."""
    stored = load_contracts(spark, contracts_path)
    merged = widen_contracts(stored, learn_contracts(bronze, event_types, keep=keep, profile=profile))
    if merged != stored:
        save_contracts(spark, merged, contracts_path)
    return merged


def dropped_columns(bronze: DataFrame, contracts: dict, event_types: Sequence[str] = EVENT_TYPES, profile: list[dict] | None = None) -> dict[str, list[str]]:
    """Per table, the filled columns that its contract would leave out (empty when nothing is lost)."""
    learnt = learn_contracts(bronze, event_types, profile=profile)
    lost = {n: [c for c in t.fieldNames() if n not in contracts or c not in contracts[n].fieldNames()] for n, t in learnt.items()}
    return {n: cols for n, cols in lost.items() if cols}


def _file_plan(counts: dict[str | None, int], rows_per_file: int) -> dict[str, int]:
    return {day: max(1, math.ceil(n / rows_per_file)) for day, n in counts.items() if day is not None and n}


def silver_tables(
    bronze: DataFrame, contracts: dict, profile: list[dict], event_types: Sequence[str] = EVENT_TYPES
) -> dict[str, tuple]:
    """Every table of ``bronze`` as (rows with ``day``, key that spreads them, rows of each day)."""
    tables: dict[str, tuple] = {}
    for event_type in event_types:
        mine = [p for p in profile if p["type"] == event_type]
        if not mine:
            continue
        name = event_table_name(event_type)
        parent, children = split_event_table(event_table(bronze, event_type, contracts.get(name)), name, contracts)
        tables[name] = (parent, F.col("id"), {p["day"]: p["rows"] for p in mine})
        for child_name, child in children.items():
            array = next((a for a in mine[0]["elements"] if child_table_name(name, a) == child_name), None)
            # an array inside a struct is not counted apart: at least one file a day, more by its parent's rows
            counts = {p["day"]: p["elements"][array] if array else p["rows"] for p in mine}
            tables[child_name] = (child, F.struct("fact_id", "pos"), counts)
    per_day: dict[str | None, int] = {}
    for p in profile:
        per_day[p["day"]] = per_day.get(p["day"], 0) + p["rows"]
    tables[FACT_TABLE] = (build_fact(bronze, contracts.get(FACT_TABLE)), F.col("id"), per_day)
    return tables


def build_silver(
    spark: SparkSession,
    bronze: DataFrame,
    contracts: dict,
    dst: str,
    event_types: Sequence[str] = EVENT_TYPES,
    max_concurrent: int = 4,
    profile: list[dict] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> dict[str, str]:
    """Write every event table, its child tables and the fact table under ``dst``, by ``day``.

    Each (table, day) gets ``ceil(rows / rows_per_file)`` files, planned from the profile and placed by
    ``spread_by_day``, however many files bronze has. A table without rows is not written (readers
    use ``build_gold.read_silver``, which knows its columns). The writes are independent Spark jobs; up
    to ``max_concurrent`` of them are submitted at once (one driver thread each) so the executors
    left idle by a small type's job, or by the tail of a big one, pick up the next table. Re-running
    a day overwrites only that day (dynamic partition overwrite). Returns table → path.
    """
    base = dst.rstrip("/")
    profile = profile_bronze(bronze) if profile is None else profile
    tables = silver_tables(bronze, contracts, profile, event_types)

    def write(name: str) -> str:
        df, key, counts = tables[name]
        plan = _file_plan(counts, rows_per_file)
        return write_partitioned(spread_by_day(df, plan, key=key), f"{base}/{name}")

    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        futures = {name: pool.submit(write, name) for name, (_, _, counts) in tables.items() if _file_plan(counts, 1)}
        return {name: future.result() for name, future in futures.items()}

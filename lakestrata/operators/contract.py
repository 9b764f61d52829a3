"""Schema contracts (SRC6, PRJ10): a stored ``StructType`` every run of a table is held to.

A contract is learnt from bronze (``plans.silver.learn_contracts``), saved as JSON text next to the
data, widened by name when a later load brings new fields (``widen``), and applied with ``DataFrame.to``: columns are reordered to the contract, extra columns
are dropped, missing ones become typed nulls, and safe widenings (int → bigint, float → double) are
applied. A narrowing or unrelated type (string where a bigint is due) raises instead of silently
corrupting the table.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.schema_union import nullable
from lakestrata.sinks.commits import CommitConflict, put_if_absent

_FILES = "contracts-*.json"


def _reshape(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` (of type ``have``) rebuilt by field NAME towards ``want``, at any depth.

    Struct fields the contract lacks are dropped, fields the data lacks become typed nulls, arrays
    of structs are rebuilt element by element, and a null struct stays null. Leaf types are left
    as they are: ``DataFrame.to`` then applies safe widenings and rejects anything else.
    """
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = {f.name: f.dataType for f in have.fields}
        parts = [
            (_reshape(c.getField(f.name), fields[f.name], f.dataType) if f.name in fields
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _reshape(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and have.keyType == want.keyType:
        return F.transform_values(c, lambda _, v: _reshape(v, have.valueType, want.valueType))
    return c


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Hold ``df`` to ``contract``: reorder, drop extras, add missing columns as typed nulls.

    Nested structs (also inside arrays and maps) are reconciled by field name the same way, so a
    month whose payload gained or lost a nested field still fits; a type that cannot be widened
    safely (string where a bigint is due) raises.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in contract.fields}
    df = df.select(*[
        _reshape(F.col(f"`{n}`"), t, wanted[n]).alias(n) if n in wanted else F.col(f"`{n}`")
        for n, t in have.items()
    ])
    # DataFrame.to only fills missing columns that are nullable; contracts are learnt from
    # inferred data and are nullable, but be explicit so a hand-written one works too.
    contract = T.StructType(
        [f if f.name in have else T.StructField(f.name, f.dataType, True, f.metadata) for f in contract.fields]
    )
    return df.to(contract)


def contract_of(df: DataFrame) -> T.StructType:
    """The contract a frame satisfies: its schema with nulls allowed at every depth."""
    return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in df.schema.fields])


_WIDER = {("int", "bigint"): 1, ("int", "double"): 1, ("bigint", "double"): 1, ("float", "double"): 1, ("int", "float"): 1}


def widen(stored: T.DataType, learnt: T.DataType) -> T.DataType:
    """``stored`` with everything ``learnt`` adds: new struct fields are appended by name at any
    depth, a leaf takes the wider numeric type; any other conflict keeps the stored type."""
    if isinstance(stored, T.StructType) and isinstance(learnt, T.StructType):
        new = {f.name: f for f in learnt.fields}
        fields = [
            T.StructField(f.name, widen(f.dataType, new[f.name].dataType) if f.name in new else f.dataType, True, f.metadata)
            for f in stored.fields
        ]
        have = set(stored.fieldNames())
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in learnt.fields if f.name not in have])
    if isinstance(stored, T.ArrayType) and isinstance(learnt, T.ArrayType):
        return T.ArrayType(widen(stored.elementType, learnt.elementType), True)
    if (stored.simpleString(), learnt.simpleString()) in _WIDER:
        return learnt
    return stored


def widen_contracts(stored: dict[str, T.StructType], learnt: dict[str, T.StructType]) -> dict[str, T.StructType]:
    return {
        name: widen(stored[name], learnt[name]) if name in stored and name in learnt else (stored.get(name) or learnt[name])
        for name in [*stored, *[n for n in learnt if n not in stored]]
    }


def _stored(spark: SparkSession, path: str) -> tuple[int, dict[str, T.StructType]]:
    """Number and content of the latest stored set; (0, {}) where there is none."""
    try:
        rows = spark.read.option("wholetext", "true").text(f"{path.rstrip('/')}/{_FILES}").select("value", F.input_file_name().alias("file"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    last = rows.orderBy(F.desc("file")).first()
    if last is None:
        return 0, {}
    stored = json.loads(last["value"])
    return stored["version"], {name: T.StructType.fromJson(c) for name, c in stored["contracts"].items()}


def save_contracts(spark: SparkSession, contracts: dict[str, T.StructType], path: str) -> None:
    """Store a set of contracts as the next version; earlier ones stay, and a write that fails leaves the latest
    as it was. Raises if another writer stored that version in the meantime."""
    version = _stored(spark, path)[0] + 1
    text = json.dumps({"version": version, "contracts": {n: json.loads(c.json()) for n, c in sorted(contracts.items())}})
    if not put_if_absent(spark, f"{path.rstrip('/')}/contracts-{version:010d}.json", text):
        raise CommitConflict(f"contracts version {version} was stored by another writer")


def load_contracts(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """The latest stored contracts at ``path`` (empty when none were stored yet; anything else that keeps them
    from being read raises)."""
    return _stored(spark, path)[1]

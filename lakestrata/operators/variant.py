"""Payloads as VARIANT: typed where a contract names a field, kept whole where none does.

The landing JSON is read with its payload as one VARIANT column, so no field is lost to the schema of a load.
``shred`` turns it into the typed payload struct that the silver operators take, and ``rest``, a VARIANT of every
field that the contract lacks or whose value does not fit its type. ``rest`` is written to silver beside the
typed columns; a field that only later becomes interesting is selected from it without going back to bronze.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REST = "rest"


def read_events_variant(spark: SparkSession, src: str | list[str], head: T.StructType, payload: str = "payload") -> DataFrame:
    """Landing JSON lines with the columns ``head`` and ``payload`` as a VARIANT (no inference pass)."""
    fields = [f for f in head.fields if f.name != payload]
    return spark.read.schema(T.StructType([*fields, T.StructField(payload, T.VariantType())])).json(src)


def field(c: Column | str, name: str, kind: T.DataType | str) -> Column:
    """Field ``name`` of a VARIANT object as a type; null if it is absent or does not fit."""
    ddl = kind if isinstance(kind, str) else kind.simpleString()
    c = F.col(c) if isinstance(c, str) else c
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        return F.try_variant_get(c, f"$.{name}", ddl)
    return F.try_variant_get(F.try_element_at(c.cast("map<string,variant>"), F.lit(name)), "$", ddl)


def shred(events: DataFrame, contract: T.StructType, payload: str = "payload", rest: str = REST) -> DataFrame:
    """``payload`` (VARIANT) as a struct of the contract's fields, and ``rest`` with all else (null if nothing is left).

    A fraction does not fit a whole-number type. Nested values are cast as one: if a part cannot be cast, the whole
    value stays in ``rest``."""
    v = F.col(payload)

    def fitting(f: T.StructField) -> Column:
        value = field(v, f.name, f.dataType)
        if isinstance(f.dataType, T.IntegralType):  # a cast alone would cut fractions off
            value = F.when(field(v, f.name, "decimal(38,10)") == value, value)
        return value

    typed = F.struct(*[fitting(f).alias(f.name) for f in contract.fields])
    shaped = events.withColumn("__typed", F.when(v.isNotNull(), typed))
    fits = {f.name: F.col("__typed").getField(f.name).isNotNull() for f in contract.fields}

    def left_over(name: Column, value: Column) -> Column:
        taken = F.lit(False)
        for known, fit in fits.items():
            taken = taken | ((name == known) & (fit | F.is_variant_null(value)))
        return ~taken

    fields = F.map_filter(v.cast("map<string,variant>"), left_over)
    others = F.when(F.size(fields) > 0, F.to_variant_object(fields))
    return shaped.withColumn(rest, others).withColumn(payload, F.col("__typed")).drop("__typed")


def rest_schema(df: DataFrame, rest: str = REST) -> str:
    """What ``rest`` holds, over all rows, as a schema text."""
    return df.agg(F.schema_of_variant_agg(F.col(rest))).first()[0]


def with_rest_fields(df: DataFrame, fields: Mapping[str, T.DataType | str], rest: str = REST) -> DataFrame:
    """``df`` with fields of ``rest`` as typed columns."""
    return df.withColumns({name: field(rest, name, kind) for name, kind in fields.items()})


def event_table_with_rest(bronze: DataFrame, event_type: str, contract: T.StructType, payload: str = "payload") -> DataFrame:
    """One event type of VARIANT bronze: ``id, created_at``, its payload fields flattened as in
    ``plans.silver.extract_event``, and ``rest``."""
    from lakestrata.operators.flatten import flatten_all, flatten_once

    rows = shred(bronze.where(F.col("type") == event_type).select("id", "created_at", payload), contract, payload)
    typed = flatten_once(rows.select("id", "created_at", payload), keep_parent_name=False).columns
    clash = REST in typed
    if clash:
        raise ValueError(f"the contract has a field called {REST}")
    lifted = rows.select("id", "created_at", *[F.col(payload).getField(f.name).alias(f.name) for f in contract.fields], REST)
    flat = flatten_all(lifted.drop(REST))
    return flatten_all(lifted).select(*flat.columns, REST)

"""One schema for loads that were read with different ones.

``merge_types`` is the join of a type lattice: nothing below everything, the integers below one another, all
numbers below ``double`` (decimals among themselves widen exactly), dates below timestamps, structs, arrays
and maps merged part by part, and text above all that does not fit together. It is associative and
commutative up to the order of fields, so schemas of loads can be merged in any grouping. VARIANT, which holds any value as
it is, stands above text: a load with typed payloads and one with VARIANT payloads unite to VARIANT. ``cast_to`` brings the rows of
one load from its own schema to the merged one; what becomes text keeps its value (nested ones as JSON).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_REAL = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _decimal(t: T.DataType) -> T.DecimalType:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0)


def _merge_numbers(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if isinstance(a, T.FloatType) and isinstance(b, T.FloatType):
        return a
    if isinstance(a, _REAL) or isinstance(b, _REAL):
        return T.DoubleType()
    x, y = _decimal(a), _decimal(b)
    scale = max(x.scale, y.scale)
    whole = max(x.precision - x.scale, y.precision - y.scale)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds both."""
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.VariantType) or isinstance(b, T.VariantType):
        return T.VariantType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_structs(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merge_types(a.keyType, b.keyType), merge_types(a.valueType, b.valueType), True)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _merge_numbers(a, b)
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def merge_structs(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both by name, ``a``'s first; all nullable."""
    other = {f.name: f.dataType for f in b.fields}
    own = set(a.fieldNames())
    fields = [(f.name, merge_types(f.dataType, other[f.name]) if f.name in other else f.dataType) for f in a.fields]
    fields += [(f.name, f.dataType) for f in b.fields if f.name not in own]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def merge_schemas(schemas: Iterable[T.StructType]) -> T.StructType:
    return reduce(merge_structs, (nullable(s) for s in schemas), T.StructType([]))


def nullable(t: T.DataType) -> T.DataType:
    """The type with nulls allowed at every depth: what one load happens to lack is no promise of the next."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, nullable(t.valueType), True)
    return t


def cast_column(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` of type ``have`` as the wider ``want``; struct fields are matched by name."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        mine = {f.name: f.dataType for f in have.fields}
        parts = [
            (cast_column(c.getField(f.name), mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: cast_column(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        pairs = F.transform(
            F.map_entries(c),
            lambda e: F.struct(
                cast_column(e["key"], have.keyType, want.keyType).alias("key"), cast_column(e["value"], have.valueType, want.valueType).alias("value")
            ),
        )
        return F.map_from_entries(pairs)
    if isinstance(want, T.VariantType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_variant_object(c)
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(want)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, in its order; missing ones are typed nulls."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (cast_column(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])

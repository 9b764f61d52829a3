"""Property tests: random nested schemas and random message groups against brute force."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import types as T

from lakestrata.operators.aggregates import ordered_concat
from lakestrata.operators.flatten import flatten_all, has_struct

NAMES = st.sampled_from(["a", "b", "c", "d", "e"])


@st.composite
def struct_types(draw, depth=0):
    names = draw(st.lists(NAMES, min_size=1, max_size=3, unique=True))
    fields = []
    for n in names:
        if depth < 3 and draw(st.booleans()):
            fields.append(T.StructField(n, draw(struct_types(depth + 1))))
        else:
            fields.append(T.StructField(n, draw(st.sampled_from([T.LongType(), T.StringType(), T.ArrayType(T.LongType())]))))
    return T.StructType(fields)


def value_for(dtype, seed):
    if isinstance(dtype, T.StructType):
        return None if seed % 5 == 4 else Row(**{f.name: value_for(f.dataType, seed + i) for i, f in enumerate(dtype.fields)})
    if isinstance(dtype, T.ArrayType):
        return [seed, seed + 1]
    return seed if isinstance(dtype, T.LongType) else f"s{seed}"


def leaves(dtype, prefix, row):
    """Brute-force expected (name, value) pairs of a fully flattened row."""
    out = {}
    for f in dtype.fields:
        name = f"{prefix}_{f.name}" if prefix else f.name
        v = None if row is None else row[f.name]
        if isinstance(f.dataType, T.StructType):
            out.update(leaves(f.dataType, name, v))
        else:
            out[name] = v
    return out


@settings(max_examples=15, deadline=None)
@given(struct_types(), st.integers(min_value=1, max_value=6))
def test_flatten_all_matches_brute_force(spark, schema, n):
    rows = [value_for(schema, i * 7) for i in range(n)]
    rows = [r if r is not None else Row(**{f.name: None for f in schema.fields}) for r in rows]
    df = spark.createDataFrame(rows, schema)
    flat = flatten_all(df)
    assert not has_struct(flat)
    assert flat.count() == n
    assert len(set(flat.columns)) == len(flat.columns)
    canon = lambda d: repr(sorted(d.items()))  # noqa: E731 - key order differs between the two sides
    got = sorted(canon(r.asDict()) for r in flat.collect())
    expected = sorted(canon(leaves(schema, "", r)) for r in rows)
    assert got == expected


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.one_of(st.none(), st.text("xyz", max_size=3))),
        min_size=1,
        max_size=40,
    ),
    st.one_of(st.none(), st.integers(min_value=1, max_value=5)),
)
def test_ordered_concat_matches_brute_force(spark, items, bucket):
    rows = [(k, i, t) for i, (k, t) in enumerate(items)]
    df = spark.createDataFrame(rows, "k string, pos int, t string").repartition(3)
    got = {r.k: r.comment for r in ordered_concat(df, "k", "pos", "t", bucket_size=bucket).collect()}
    expected = {}
    for k, _, t in sorted(rows, key=lambda r: r[1]):
        expected.setdefault(k, [])
        if t is not None:
            expected[k].append(t)
    assert got == {k: ",".join(v) for k, v in expected.items()}

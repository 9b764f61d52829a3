import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.arrays import array_columns, explode_array, split_arrays
from lakestrata.operators.columns import all_null_columns, drop_all_null, drop_by_pattern, null_profile
from lakestrata.operators.contract import conform, load_contracts, save_contracts, widen
from lakestrata.operators.flatten import flatten_all, flatten_once, has_struct, struct_children

NESTED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "a",
            T.StructType(
                [
                    T.StructField("x", T.LongType()),
                    T.StructField("b", T.StructType([T.StructField("c", T.StructType([T.StructField("d", T.StringType())]))])),
                ]
            ),
        ),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("m", T.MapType(T.StringType(), T.LongType())),
        T.StructField(
            "items",
            T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("sub", T.ArrayType(T.LongType()))])),
        ),
        T.StructField("z", T.LongType()),
    ]
)


def nested_df(spark):
    rows = [
        ("1", Row(x=1, b=Row(c=Row(d="deep"))), ["t1"], {"k": 1}, [Row(k="i", sub=[1, 2])], 9),
        ("2", None, None, None, [], 8),
    ]
    return spark.createDataFrame(rows, NESTED)


def test_flatten_once_orders_flat_columns_first(spark):
    out = flatten_once(nested_df(spark))
    assert out.columns == ["id", "tags", "m", "items", "z", "a_x", "a_b"]
    assert has_struct(out)


def test_flatten_all_is_breadth_first_and_keeps_arrays_and_maps(spark):
    out = flatten_all(nested_df(spark))
    assert out.columns == ["id", "tags", "m", "items", "z", "a_x", "a_b_c_d"]
    assert not has_struct(out)
    assert isinstance(out.schema["items"].dataType, T.ArrayType)
    assert isinstance(out.schema["m"].dataType, T.MapType)
    rows = {r["id"]: r for r in out.collect()}
    assert rows["1"]["a_b_c_d"] == "deep" and rows["2"]["a_x"] is None
    assert out.count() == 2


def test_flatten_all_equals_repeated_flatten_once(spark):
    df = nested_df(spark)
    step = df
    while has_struct(step):
        step = flatten_once(step)
    assert step.columns == flatten_all(df).columns
    assert sorted(map(tuple, step.collect())) == sorted(map(tuple, flatten_all(df).collect()))


def test_flatten_without_prefix_raises_on_duplicate_names(spark):
    df = spark.createDataFrame([("1", Row(id=5, v="x"))], "id string, payload struct<id:bigint, v:string>")
    with pytest.raises(ValueError, match="id"):
        flatten_once(df, keep_parent_name=False)
    assert flatten_once(df).columns == ["id", "payload_id", "payload_v"]


def test_flatten_handles_dots_in_field_names(spark):
    df = spark.createDataFrame([(Row(**{"a.b": 1}),)], "s struct<`a.b`:int>")
    out = flatten_all(df)
    assert out.columns == ["s_a.b"] and out.first()[0] == 1


def test_struct_children(spark):
    assert struct_children(nested_df(spark), "a") == ["x", "b"]
    with pytest.raises(TypeError):
        struct_children(nested_df(spark), "z")


def test_drop_by_pattern(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "html_url int, url int, gravatar_id int, curl int, kept int")
    assert drop_by_pattern(df).columns == ["kept"]
    assert drop_by_pattern(df, keep=["url"]).columns == ["url", "kept"]


def test_drop_all_null_keeps_partly_null_columns(spark):
    # a column with exactly 500 nulls next to filled rows stays; a wholly null column goes
    rows = [(i, None if i < 500 else i, None) for i in range(510)]
    df = spark.createDataFrame(rows, "id int, half int, empty string")
    assert all_null_columns(df) == ["empty"]
    assert drop_all_null(df).columns == ["id", "half"]
    seven = spark.createDataFrame([(i, None) for i in range(7)], "id int, gone string")
    assert drop_all_null(seven).columns == ["id"]


def test_drop_all_null_on_empty_table_drops_nothing(spark):
    empty = spark.createDataFrame([], "id int, v string")
    assert drop_all_null(empty).columns == ["id", "v"]


def test_null_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert null_profile(df).first().asDict() == {"a": 1, "b": 2}


def test_conform_adds_drops_reorders_and_widens(spark, tmp_dir):
    contract = T.StructType(
        [
            T.StructField("b", T.LongType()),
            T.StructField("a", T.StringType()),
            T.StructField("missing", T.StringType()),
        ]
    )
    df = spark.createDataFrame([("x", 1, 2.0)], "a string, b int, extra double")
    out = conform(df, contract)
    assert out.columns == ["b", "a", "missing"]
    assert out.schema["b"].dataType == T.LongType() and out.schema["missing"].dataType == T.StringType()
    assert out.first().asDict() == {"b": 1, "a": "x", "missing": None}
    assert conform(out, contract).collect() == out.collect()  # idempotent
    path = tmp_dir + "/contract"
    save_contracts(spark, {"t": contract}, path)
    assert load_contracts(spark, path) == {"t": contract} and load_contracts(spark, path + "-none") == {}


def test_widen_appends_new_fields_by_name_at_any_depth():
    old = T.StructType.fromDDL("a int, s struct<x:string>, l array<struct<p:int>>")
    new = T.StructType.fromDDL("b string, s struct<y:int, x:string>, a bigint, l array<struct<q:string>>")
    want = T.StructType.fromDDL("a bigint, s struct<x:string, y:int>, l array<struct<p:int, q:string>>, b string")
    assert widen(old, new).simpleString() == want.simpleString()
    assert widen(T.StructType.fromDDL("a string"), T.StructType.fromDDL("a int")).simpleString() == "struct<a:string>"


def test_conform_rejects_string_where_int_is_due(spark):
    contract = T.StructType([T.StructField("n", T.LongType())])
    df = spark.createDataFrame([("abc",)], "n string")
    with pytest.raises(Exception):
        conform(df, contract).collect()


def test_explode_array_drops_null_and_empty_and_keeps_position(spark):
    df = nested_df(spark)
    assert array_columns(df) == ["tags", "items"]
    items = explode_array(df.withColumn("created_at", F.lit("2017-01-01T00:00:00Z")), "items")
    assert items.columns == ["fact_id", "event_created_at", "pos", "k", "sub"]
    assert [tuple(r) for r in items.collect()] == [("1", "2017-01-01T00:00:00Z", 0, "i", [1, 2])]
    tags = explode_array(df, "tags", time_col=None)
    assert tags.columns == ["fact_id", "pos", "col"]


def test_split_arrays_row_count_is_sum_of_sizes(spark):
    rows = [(str(i), "2017-01-01T00:00:00Z", list(range(i % 4)) if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, created_at string, xs array<int>")
    parent, children = split_arrays(df, "thing_df")
    assert parent.columns == ["id", "created_at"]
    child = children["thing_df_xs_df"]
    expected = sum(len(r[2]) for r in rows if r[2])
    assert child.count() == expected
    ordered = child.where("fact_id = '3'").orderBy("pos").select("col").collect()
    assert [r[0] for r in ordered] == [0, 1, 2]


def test_conform_reconciles_nested_fields_by_name(spark):
    contract = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("commits", T.ArrayType(T.StructType([
                T.StructField("sha", T.StringType()), T.StructField("message", T.StringType()),
                T.StructField("n", T.LongType()),
            ]))),
            T.StructField("comment", T.StructType([T.StructField("body", T.StringType()), T.StructField("id", T.LongType())])),
        ]
    )
    # next month: a new nested field, a missing nested field, an int that widens, a null struct
    df = spark.createDataFrame(
        [
            ("1", [Row(author="a", message="m1", sha="s1")], Row(body="b", id=7, url="u")),
            ("2", None, None),
        ],
        "id string, commits array<struct<author:string, message:string, sha:string>>,"
        " comment struct<body:string, id:int, url:string>",
    )
    out = conform(df, contract)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in contract.fields]
    rows = {r.id: r for r in out.collect()}
    assert rows["1"].commits == [Row(sha="s1", message="m1", n=None)]
    assert rows["1"].comment == Row(body="b", id=7)
    assert rows["2"].commits is None and rows["2"].comment is None
    missing = conform(df.drop("comment"), contract).first()
    assert missing.comment is None


def test_conform_still_rejects_unsafe_nested_types(spark):
    contract = T.StructType([T.StructField("s", T.StructType([T.StructField("n", T.LongType())]))])
    df = spark.createDataFrame([(Row(n="x"),)], "s struct<n:string>")
    with pytest.raises(Exception):
        conform(df, contract).collect()

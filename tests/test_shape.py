import pytest
from pyspark.sql import functions as F

from tabulon.operators import shape
from tabulon.operators.profile import zero_counts
from tabulon.sources.tables import VersionedTable, read_csv, read_table, snapshot, write_table
from tabulon.plans.shared import scratch


def test_read_csv_infers_and_takes_a_schema(spark, tmp_path):
    text = "a,b,c\r\n1,2.5,x\r\n0,0.0,y"  # CRLF, last line open
    (tmp_path / "in.csv").write_bytes(text.encode())
    df = read_csv(spark, str(tmp_path / "in.csv"))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("a", "int"), ("b", "double"), ("c", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, 2.5, "x"), (0, 0.0, "y")]
    typed = read_csv(spark, str(tmp_path / "in.csv"), "a long, b double, c string")
    assert typed.schema["a"].dataType.simpleString() == "bigint"


def test_write_and_read_a_named_table(spark):
    spark.sql("DROP TABLE IF EXISTS kept")
    write_table(spark.range(3).toDF("id"), "kept")
    write_table(spark.range(5).toDF("id"), "kept")
    assert read_table(spark, "kept").count() == 5
    spark.sql("DROP TABLE kept")


def test_versioned_table_overwrites_itself_and_keeps_old_versions(spark):
    t = VersionedTable(spark, scratch(spark, "t"))
    assert t.version() == 0
    t.write(spark.range(3).toDF("id"))
    before = t.read()
    t.write(t.read().select((F.col("id") + 10).alias("id")), note="n")
    assert sorted(r.id for r in t.read().collect()) == [10, 11, 12]
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    assert sorted(r.id for r in t.read(1).collect()) == [0, 1, 2]
    assert t.info()["note"] == "n" and t.info()["rows"] == 3


def test_two_writers_of_one_version(spark):
    path = scratch(spark, "t")
    a, b = VersionedTable(spark, path), VersionedTable(spark, path)
    a.write(spark.range(1).toDF("id"), expected=0)
    with pytest.raises(Exception):
        b.write(spark.range(2).toDF("id"), expected=0)
    assert a.read().count() == 1


def test_snapshot_is_ordered(spark):
    df = spark.range(100).withColumn("v", -F.col("id"))
    assert [r.v for r in snapshot(df, ["v"], 3, "v").collect()] == [-99, -98, -97]


def test_add_key(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "a int, b int").repartition(5)
    assert shape.add_key(df).select("Id").distinct().count() == 100
    keyed = shape.add_key(df, "k", order_by=["a", "b"], start=1)
    want = {(a, b): n + 1 for n, (a, b) in enumerate(sorted((i % 7, i) for i in range(100)))}
    assert {(r.a, r.b): r.k for r in keyed.collect()} == want


def test_people_depend_on_key_and_seed_only(spark, rows):
    df = spark.range(50)
    one, two = shape.add_fake_person(df.repartition(4), "id", 1), shape.add_fake_person(df, "id", 1)
    assert rows(one) == rows(two)
    assert rows(one) != rows(shape.add_fake_person(df, "id", 2))
    # an address parses back
    parsed = shape.parse_address(two, "Address", True, True)
    assert parsed.filter("length(State) = 2 and length(Zip) = 5").count() == 50


@pytest.mark.parametrize("address, state, zip_code", [
    ("1 Elm St\nOakton, VA 22124", "VA", "22124"),
    ("Unit 5 Box 9\nAPO AE 09012", "AE", "09012"),
    ("abc", None, "abc"),
    (None, None, None),
    ("1 Elm St\nOakton, VA  22124", "", "22124"),
])
def test_parse_address(spark, address, state, zip_code):
    df = spark.createDataFrame([(address,)], "a string")
    row = shape.parse_address(df, "a", state=True, zip=True).first()
    assert (row.State, row.Zip) == (state, zip_code)


def test_parse_address_flags(spark):
    df = spark.createDataFrame([("a VA 1",)], "a string")
    assert shape.parse_address(df, "a").columns == ["a", "State"]
    assert shape.parse_address(df, "a", state=False, zip=True).columns == ["a", "Zip"]
    assert shape.parse_address(df, "a", state=False, zip=False).columns == ["a"]


def test_zero_to_null(spark):
    df = spark.createDataFrame([(0, 0.0), (None, 0.0), (5, 2.0)], "a int, b double")
    out = shape.zero_to_null(df, ["a"])
    assert [tuple(r) for r in out.collect()] == [(None, 0.0), (None, 0.0), (5.0, 2.0)]
    assert tuple(zero_counts(out, ["a", "b"]).first()) == (0, 2)
    assert tuple(zero_counts(df, ["a", "b"]).first()) == (1, 2)


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("12",), ("1e3",), ("x",), ("",)], "a string")
    assert [r.a for r in shape.coerce_numeric(df, ["a"]).collect()] == [12.0, 1000.0, None, None]


def test_insert_col_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.insert_col(df, "c", 1).columns == ["a", "c", "b"]
    assert shape.insert_col(df, "n", 2, F.lit(9)).columns == ["a", "b", "n", "c"]
    assert shape.drop_pii(df, ["b", "absent"]).columns == ["a", "c"]


def test_split_entities_share_the_key(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, b int, c int")
    parts = shape.split_entities(df, "k", {"x": ["b"], "y": ["k", "c"]})
    assert parts["x"].columns == ["k", "b"] and parts["y"].columns == ["k", "c"]


def test_contract(spark):
    contract = shape.infer_contract(spark.createDataFrame([(1, 2.0, "a")], "i int, d double, s string"))
    new = spark.createDataFrame([("1", None), ("x", 2.0)], "i string, d double")
    got = {r["column"]: (r["missing"], r["cast_failures"], r["nulls"]) for r in shape.check_contract(new, contract).collect()}
    assert got == {"i": (False, 1, 0), "d": (False, 0, 1), "s": (True, None, None)}
    assert shape.schema_of(contract)["d"].dataType.simpleString() == "double"

import pytest
from pyspark.sql import functions as F

import widevec as wv

# o1, o2, addr, then the five texts.
CASES = [
    ("A", "B", "X", "A", "Property Owner: B", "A, B", "X",
     "Property Owners: A, B | Property Mailing Address: X"),
    ("A", None, "X", "A", "Property Owner: ", "A", "X", "Property Owners: A | Property Mailing Address: X"),
    ("A", "", None, "A", "Property Owner: ", "A", "", "Property Owners: A | Property Mailing Address: "),
    (None, "B", "X", "", "Property Owner: B", ", B", "X",
     "Property Owners: , B | Property Mailing Address: X"),
    (None, None, None, "", "Property Owner: ", "", "", "Property Owners:  | Property Mailing Address: "),
    ("A", " ", "X", "A", "Property Owner:  ", "A,  ", "X",
     "Property Owners: A,   | Property Mailing Address: X"),
]


@pytest.fixture(scope="module")
def owners(spark):
    rows = [(i, *case[:3], "RI") for i, case in enumerate(CASES)]
    rows += [(100, "A", "B", "X", "NY"), (101, "A", "B", "X", None)]
    return spark.createDataFrame(rows, "id int, o1 string, o2 string, addr string, st string")


def test_five_texts(owners):
    found = wv.owner_mail(owners, "id", "o1", "o2", "addr", "st", ["RI", "AR"]).orderBy("gid").collect()
    assert [tuple(row)[1:] for row in found] == [case[3:] for case in CASES]


def test_in_list_drops_null_and_others(owners):
    assert owners.filter(wv.is_in("st", ["RI"])).count() == len(CASES)
    assert owners.filter(wv.is_in("st", [])).count() == 0


def test_non_empty_keeps_blanks(spark):
    rows = spark.createDataFrame([(None,), ("",), (" ",), ("x",)], "t string")
    assert [r[0] for r in rows.select(wv.non_empty("t")).collect()] == [False, False, True, True]


def test_perspectives_names_and_order(owners):
    found = wv.perspectives(owners, "id", {"z": F.lit("1"), "a": F.col("o1")})
    assert found.columns == ["gid", "z", "a"]


def test_bind_by_name(spark, config):
    rows = spark.createDataFrame(
        [("B", 5, "A", 1), (None, None, None, 2)], "b string, gid int, a string, extra int"
    )
    found = wv.bind_columns(rows, config())
    assert found.schema.simpleString() == "struct<gid:bigint,a:string,b:string>"
    assert [tuple(r) for r in found.collect()] == [(5, "A", "B"), (0, "", "")]
    assert wv.bind_columns(rows, config(), ["b"]).columns == ["gid", "b"]


def test_bind_takes_awkward_names(spark, config):
    rows = spark.createDataFrame([(1, "x")], ["my.id", "a b`c"])
    found = wv.bind_columns(rows, config(id_column="my.id", input_columns=("a b`c",)))
    assert [tuple(r) for r in found.collect()] == [(1, "x")]


def test_bind_errors(spark, config):
    rows = spark.createDataFrame([(1, "x")], ["gid", "a"])
    with pytest.raises(ValueError, match="missing"):
        wv.bind_columns(rows, config())
    with pytest.raises(ValueError, match="not among"):
        wv.bind_columns(rows, config(), ["c"])
    with pytest.raises(ValueError, match="empty"):
        wv.bind_columns(rows, config(input_columns=()))


def test_pack_slots(spark):
    rows = spark.createDataFrame([(7, "x", None), (8, "p", "q")], "gid long, b string, a string")
    found = wv.pack_slots(rows, ["b", "a"])
    assert found.columns == ["gid", "v", "column", "text"]
    assert sorted(tuple(r) for r in found.collect()) == [
        (7, 0, "b", "x"), (7, 1, "a", ""), (8, 0, "b", "p"), (8, 1, "a", "q"),
    ]

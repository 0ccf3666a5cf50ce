from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import clean as CL


def test_blank_to_null(spark):
    df = spark.createDataFrame([("",), ("  ",), (" a ",), (None,), ("\tb\n",)], "s string")
    out = [r.s for r in CL.clean_strings(df).collect()]
    assert out == [None, None, "a", None, "b"]


def test_boolean_like(spark):
    df = spark.createDataFrame([("true",), (" YES ",), ("0",), ("2",), ("maybe",), (None,)], "b string")
    out = [r.b for r in CL.normalize_booleans(df, ["b"]).collect()]
    assert out == ["True", "True", "False", None, None, None]


def test_boolean_numeric(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (2.0,), (None,)], "b double")
    out = [r.b for r in CL.normalize_booleans(df, ["b"]).collect()]
    assert out == ["True", "False", None, None]


def test_code_split(spark):
    rows = [("B/12/S",), ("B/12",), ("B",), ("B/x/S",), ("B/1/S/9",), (None,)]
    df = CL.with_code_parts(spark.createDataFrame(rows, "c string"), "c")
    got = [(r.deck, r.num, r.side) for r in df.collect()]
    assert got == [("B", 12.0, "S"), ("B", 12.0, None), ("B", None, None), ("B", None, "S"), ("B", 1.0, "S/9"), (None, None, None)]


def test_split_id_and_last_token(spark):
    df = spark.createDataFrame([("0001_02", "Ann Lee"), ("0002", "Solo"), ("3_x", None)], "id string, name string")
    out = CL.with_last_token(CL.with_id_parts(df, "id", "g", "m"), "name").collect()
    assert [(r.g, r.m, r.surname) for r in out] == [("0001", 2, "Lee"), ("0002", None, "Solo"), ("3", None, None)]


def test_label_coercion_raises(spark):
    df = spark.createDataFrame([("1",), ("maybe",)], "y string")
    import pytest

    with pytest.raises(Exception):
        CL.coerce_label(df, "y").collect()


def test_interaction_key(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert [r.k for r in df.select(C.interaction_key("x", "y").alias("k")).collect()] == ["a_Unknown", "Unknown_b"]

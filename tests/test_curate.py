from __future__ import annotations

from pyspark.sql import functions as F

from lakeweir.functions.values import VALUE_CLASSES, in_class, value_class
from lakeweir.operators.curate import conform, dedupe_latest, is_empty, stamp
from lakeweir.schemas import CURATED, RAW, record


def test_default_schemas_fit():
    assert len(CURATED) == 17
    assert RAW.names == [*[n for n in CURATED.names if n != "ingestion_at"], "_corrupt_record"]
    assert {f.dataType.simpleString() for f in RAW} == {"string"}


def test_conform_casts_fills_and_drops(spark):
    raw = spark.createDataFrame(
        [("1", "7.25", True, "x"), ("2", "n/a", False, "y"), (None, None, None, None)],
        "id string, lon string, flag boolean, unknown string",
    )
    out = conform(raw, record(id="string", lon="double", flag="double", absent="string"))
    assert out.columns == ["id", "lon", "flag", "absent"]
    assert [tuple(r) for r in out.collect()] == [
        ("1", 7.25, 1.0, None),
        ("2", None, 0.0, None),
        (None, None, None, None),
    ]


def test_conform_keeps_leading_zeros(spark):
    raw = spark.createDataFrame([("00123",)], "postal string")
    assert conform(raw, record(postal="string")).first()[0] == "00123"


def test_stamp(spark):
    df = spark.range(2)
    fixed = stamp(df, "at", "2024-05-06 07:08:09")
    assert {str(r["at"]) for r in fixed.collect()} == {"2024-05-06 07:08:09"}
    assert stamp(df, "at").select("at").distinct().count() == 1


def test_is_empty(spark):
    assert is_empty(spark.range(0))
    assert not is_empty(spark.range(1))


def test_dedupe_keeps_the_first_and_every_null_key(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only"), (None, 1, "x"), (None, 1, "x")]
    df = spark.createDataFrame(rows, "id string, seq int, what string")
    out = dedupe_latest(df, ["id"], [F.desc("seq")])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("a", 2, "new"), ("b", 1, "only"), (None, 1, "x"), (None, 1, "x")], key=repr
    )


def test_dedupe_with_two_keys(spark):
    rows = [("a", None, 1), ("a", None, 2), ("a", "k", 1), ("a", "k", 2)]
    df = spark.createDataFrame(rows, "id string, sub string, seq int")
    out = dedupe_latest(df, ["id", "sub"], [F.desc("seq")])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("a", None, 1), ("a", None, 2), ("a", "k", 2)], key=repr
    )


def test_value_classes(spark):
    cases = {
        "12": "Integral", "-3": "Integral", "+ 4": "Integral", "": "Integral",
        "1.5": "Fractional", "-1.50": "Fractional", ".": "Fractional", "- .5": "Fractional",
        "true": "Boolean", "false": "Boolean", "True": "String",
        "1.0E10": "String", "12\n": "String", "1,5": "String", "abc": "String", "é": "String",
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = df.select("v", value_class(F.col("v"), df.schema["v"].dataType).alias("c")).collect()
    assert {r["v"]: r["c"] for r in got} == cases
    members = df.select("v", *[in_class(F.col("v"), c).alias(c) for c in VALUE_CLASSES]).collect()
    assert {r["v"]: [c for c in VALUE_CLASSES if r[c]] for r in members} == {
        v: [c] for v, c in cases.items()
    }

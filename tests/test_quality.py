from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeweir.errors import QualityGateError, SchemaCheckFailed
from lakeweir.operators import quality
from lakeweir.operators.quality import Check
from lakeweir.plans.presets import SITE_CHECK
from lakeweir.schemas import record


def metrics(report):
    return {(r["column"], r["constraint"]): r["metric"] for r in report.collect()}


def test_schema_problems(spark):
    df = spark.createDataFrame([], "id string, n decimal(10,2), x int, more string")
    expected = record(id="string", x="string", gone="double").add("n", "decimal(5,0)")
    rows = [tuple(r) for r in quality.schema_report(df, expected).collect()]
    assert rows == [
        ("x", "type", "string", "int"),
        ("gone", "missing", "double", None),
        ("more", "extra", None, "string"),
    ]
    with pytest.raises(SchemaCheckFailed, match="gone: missing"):
        quality.require_schema(df.schema, expected)
    quality.require_schema(df.schema, df.schema)


def test_preset_has_the_fourteen_constraints():
    kinds = [c.kind for c in SITE_CHECK.constraints]
    assert (kinds.count("unique"), kinds.count("complete"), kinds.count("data_type")) == (1, 7, 6)


def test_metrics(spark):
    rows = [("a", "x1", 1.5), ("b", "12", None), ("b", None, 2.0), (None, None, 1.0e10)]
    df = spark.createDataFrame(rows, "id string, s string, d double")
    check = (
        Check("c")
        .is_unique("id")
        .is_complete("id", "s")
        .has_data_type("String", "s")
        .has_data_type("Integral", "s")
        .has_data_type("Fractional", "d")
    )
    assert metrics(quality.verify(df, [check])) == {
        ("id", "unique"): pytest.approx(1 / 3),
        ("id", "complete"): 0.75,
        ("s", "complete"): 0.5,
        ("s", "data_type[String]"): 0.5,
        ("s", "data_type[Integral]"): 0.5,
        ("d", "data_type[Fractional]"): 1.0,
    }


def test_all_digit_text_is_not_string(spark):
    df = spark.createDataFrame([("1",), ("22",)], "id string")
    report = quality.verify(df, [Check("c").has_data_type("String", "id")])
    assert report.first()["status"] == "failure"


def test_typed_columns_are_classified_by_type(spark):
    df = spark.createDataFrame([(1, True)], "i int, b boolean")
    check = (
        Check("c")
        .has_data_type("Integral", "i")
        .has_data_type("String", "i")
        .has_data_type("Boolean", "b")
    )
    assert [r["metric"] for r in quality.verify(df, [check]).collect()] == [1.0, 0.0, 1.0]


def test_nothing_to_measure(spark):
    check = Check("c").is_unique("id").is_complete("id").has_data_type("String", "id")
    for rows in ([], [(None,), (None,)]):
        df = spark.createDataFrame(rows, "id string")
        report = quality.verify(df, [check]).collect()
        assert {r["status"] for r in report} == {"failure"}
        assert {r["metric"] for r in report} <= {None, 0.0}


def test_all_values_repeated(spark):
    df = spark.createDataFrame([("a",), ("a",)], "id string")
    row = quality.verify(df, [Check("c").is_unique("id")]).first()
    assert (row["metric"], row["status"], row["message"]) == (0.0, "failure", "metric is not 1.0")


def test_unknown_column_fails_with_a_message(spark):
    df = spark.createDataFrame([("a",)], "id string")
    report = quality.verify(df, [Check("c").is_unique("no").is_complete("no", "id")]).collect()
    assert sorted((r["column"], r["status"], r["message"]) for r in report) == [
        ("id", "success", ""),
        ("no", "failure", "no such column"),
        ("no", "failure", "no such column"),
    ]
    only_unknown = quality.verify(df, [Check("c").is_complete("no")])
    assert only_unknown.first()["status"] == "failure"


def test_two_checks_share_a_metric(spark):
    df = spark.createDataFrame([("a",)], "id string")
    checks = [Check("one").is_unique("id"), Check("two", quality.WARNING).is_unique("id")]
    assert sorted((r["check"], r["level"]) for r in quality.verify(df, checks).collect()) == [
        ("one", "error"),
        ("two", "warning"),
    ]


def test_no_constraints(spark):
    report = quality.verify(spark.range(1), [])
    assert report.count() == 0
    quality.gate(report)


def test_gate_stops_on_errors_only(spark):
    df = spark.createDataFrame([(None,)], "id string")
    quality.gate(quality.verify(df, [Check("w", quality.WARNING).is_complete("id")]))
    report = quality.verify(df, [Check("e").is_complete("id")])
    with pytest.raises(QualityGateError, match=r"complete\(id\)"):
        quality.gate(report)
    assert quality.publish_if_passed(df, report).count() == 0


def test_profile_counts_nulls_as_unknown(spark):
    df = spark.createDataFrame([("a", 1.0), (None, None), ("3", 2.0)], "s string, d double")
    rows = sorted(map(tuple, quality.data_type_profile(df, ["s", "d"]).collect()))
    assert rows == [
        ("d", "Fractional", 2),
        ("d", "Unknown", 1),
        ("s", "Integral", 1),
        ("s", "String", 1),
        ("s", "Unknown", 1),
    ]


def test_digest_uniqueness_agrees(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "s string")
    assert (
        quality.uniqueness(df, "s", by_digest=True).collect()
        == quality.uniqueness(df, "s").collect()
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(
        st.one_of(st.none(), st.sampled_from(["", "1", "-2", "3.5", "true", "x", "y"])), max_size=20
    )
)
def test_metrics_equal_a_plain_count(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    check = Check("c").is_unique("c").is_complete("c")
    for name in quality.VALUE_CLASSES:
        check = check.has_data_type(name, "c")
    got = metrics(quality.verify(df, [check]))
    filled = [v for v in values if v is not None]
    sets = {
        "Integral": {"", "1", "-2"}, "Fractional": {"3.5"}, "Boolean": {"true"}, "String": {"x", "y"},
    }

    def share(part, whole):
        return part / whole if whole else None

    singles = sum(filled.count(v) == 1 for v in filled)
    assert got["c", "unique"] == share(singles, len(filled))
    assert got["c", "complete"] == share(len(filled), len(values))
    for name, members in sets.items():
        hits = sum(v in members for v in filled)
        assert got["c", f"data_type[{name}]"] == share(hits, len(filled))


def test_row_count(spark):
    assert quality.row_count(spark.range(7)).first()[0] == 7
    assert quality.row_count(spark.range(0)).first()[0] == 0


def test_unknown_value_class_is_refused():
    with pytest.raises(ValueError, match="Text"):
        Check("c").has_data_type("Text", "id")

"""Quality report, summary and gate."""

import datetime as dt

import pytest

from ledgerlake import schemas
from ledgerlake.plans import quality, silver

STAMP = "2024-01-01T00:00:00"
AS_OF = "2001-12-31T00:00:00"


def test_silver_passes_all_checks(spark, bronze_smoke):
    b = bronze_smoke
    s = silver.build_silver(b, STAMP)
    report = quality.quality_report(s["users"], s["transactions"], s["transaction_details"],
                                    b["transactions"], b["transaction_details"], AS_OF, STAMP)
    out = report.collect()
    assert len(out) == 18
    assert [tuple(r) for r in out][:2] == [
        ("users", "record_count", "PASS", "142 registros en Silver", STAMP),
        ("transactions", "record_count", "PASS", "1283 registros en Silver", STAMP)]
    assert all(r.status == "PASS" for r in out), [tuple(r) for r in out if r.status != "PASS"]
    detail = {(r.entity, r.check): r.detail for r in out}
    assert detail[("transactions", "bronze_to_silver_traceability")] == \
        "Bronze=1559 → Silver=1283 (se eliminaron 276 invalidos)"
    assert detail[("transaction_details", "bronze_to_silver_traceability")] == "Bronze=6000 → Silver=3334"
    assert detail[("transactions", "freshness")] == "Transaccion mas reciente: 2001-08-01 00:00:00"
    assert quality.assert_quality(report)["pass_rate"] == 100.0


def test_raw_report_fails_expected_checks(spark, bronze_smoke):
    b = bronze_smoke
    report = quality.quality_report(b["users"], b["transactions"], b["transaction_details"],
                                    b["transactions"], b["transaction_details"], AS_OF, STAMP)
    got = {(r.entity, r.check): (r.status, r.detail) for r in report.collect()}
    assert got[("users", "null_check_name")] == ("FAIL", "5 nulls en columna name")
    assert got[("users", "null_check_email")] == ("FAIL", "6 nulls en columna email")
    assert got[("transactions", "null_check_amount")] == ("FAIL", "21 nulls en columna amount")
    assert got[("transactions", "null_check_status")] == ("FAIL", "17 nulls en columna status")
    assert got[("transactions", "amount_positive")] == ("FAIL", "56 transacciones con amount <= 0")
    assert got[("transactions", "status_standardized")] == ("FAIL", "863 registros con status invalido")
    assert got[("transactions", "no_duplicates")] == ("FAIL", "59 duplicados encontrados")
    assert got[("transactions", "bronze_to_silver_traceability")][0] == "PASS"
    with pytest.raises(quality.QualityGateError, match=r"Quality checks fallaron: \d+/18\. Pass rate: "):
        quality.assert_quality(report)


def test_freshness_window_and_empty_table(spark):
    tx = spark.createDataFrame([], schemas.SILVER["transactions"])
    users = spark.createDataFrame([], schemas.SILVER["users"])
    details = spark.createDataFrame([], schemas.SILVER["transaction_details"])
    report = quality.quality_report(users, tx, details, tx, details, AS_OF, STAMP)
    got = {(r.entity, r.check): (r.status, r.detail) for r in report.collect()}
    assert got[("transactions", "freshness")] == ("FAIL", "Transaccion mas reciente: NaT")
    assert got[("transactions", "record_count")] == ("FAIL", "0 registros en Silver")
    assert got[("transactions", "no_duplicates")] == ("PASS", "0 duplicados encontrados")
    fresh = spark.createDataFrame(
        [("t", "u", 1.0, "success", dt.datetime(2001, 8, 1), "s", "bronze")], schemas.SILVER["transactions"])
    rows = {r.as_of: r.is_fresh for r in quality.freshness(fresh, [AS_OF, "2003-01-01T00:00:00"]).collect()}
    assert rows == {AS_OF: True, "2003-01-01T00:00:00": False}


def test_summary_of_empty_report(spark):
    empty = spark.createDataFrame([], schemas.QUALITY_REPORT)
    s = quality.quality_summary(empty).first()
    assert (s.total_checks, s.passed, s.failed, s.pass_rate) == (0, 0, 0, 0.0)
    assert quality.assert_quality(empty)["failed"] == 0


def test_duplicates_count_null_keys_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert quality.duplicate_counts(df, "x", "k").first().duplicates == 2


def test_orphan_rows_counts_rows_not_keys(spark):
    child = spark.createDataFrame([("u1",), ("u9",), ("u9",), ("u9",), (None,), (None,)], "user_id string")
    parent = spark.createDataFrame([("u1",), (None,)], "user_id string")
    assert quality.orphan_rows(child, parent, "user_id").first().orphan_rows == 5
    assert quality.orphan_rows(child.where("user_id = 'u1'"), parent, "user_id").first().orphan_rows == 0


def test_gate_result_tells_outcome_and_message(spark):
    from ledgerlake.plans.quality import gate_result
    from ledgerlake.schemas import QUALITY_REPORT

    def gate(*statuses):
        rows = [("users", f"c{i}", s, "", "") for i, s in enumerate(statuses)]
        return gate_result(spark.createDataFrame(rows, QUALITY_REPORT)).first()

    good = gate("PASS", "PASS")
    assert good.passed_gate and good.message is None
    bad = gate("PASS", "FAIL", "PASS")
    assert not bad.passed_gate and bad.message == "Quality checks fallaron: 1/3. Pass rate: 66.7%"
    none = gate()
    assert none.passed_gate and none.pass_rate == 0.0

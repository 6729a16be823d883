"""Operators on hand-written frames: one test per semantic note."""

from pyspark.sql import functions as F

from ledgerlake.operators import (
    first_failed_rule,
    in_domain,
    keep_first,
    orphans,
    reference_flag,
    reject_table,
    require_in,
    require_not_null,
    require_positive,
    require_reference,
    stamp,
)
from tests.conftest import rows


def test_keep_first_keeps_lowest_sequence(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"), ("a", 3, "later")], "k string, _seq long, v string")
    out = keep_first(df, ["k"], ["_seq"])
    assert out.columns == ["k", "_seq", "v"]
    assert rows(out, "k", "v") == [("a", "early"), ("b", "only")]


def test_keep_first_before_validation_loses_valid_later_copy(spark):
    # N1: the first copy is invalid, the later valid copy must not come back
    df = spark.createDataFrame([("t1", 0, -5.0), ("t1", 1, 10.0), ("t2", 0, 3.0)], "k string, _seq long, amount double")
    out = require_positive(keep_first(df, ["k"], ["_seq"]), "amount")
    assert rows(out, "k", "amount") == [("t2", 3.0)]


def test_keep_first_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 0, "y"), ("k", 0, "z")], "k string, _seq long, v string")
    assert rows(keep_first(df, ["k"], ["_seq"]), "k", "v") == [(None, "y"), ("k", "z")]


def test_keep_first_ties_broken_by_remaining_columns_nulls_first(spark):
    df = spark.createDataFrame([("a", 0, "b"), ("a", 0, None), ("a", 0, "a")], "k string, _seq long, v string")
    assert rows(keep_first(df, ["k"], ["_seq"]), "k", "v") == [("a", None)]


def test_keep_first_counts_copies(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0)], "k string, _seq long")
    out = keep_first(df, ["k"], ["_seq"], copies_col="_copies")
    assert rows(out, "k", "_copies") == [("a", 3), ("b", 1)]


def test_keep_first_plans_partial_aggregation_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("_seq"))
    plan = keep_first(df, ["k"], ["_seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_require_not_null_drops_nan_keeps_empty_string(spark):
    df = spark.createDataFrame([("a", ""), (None, "x"), ("b", None), ("c", "y")], "id string, name string")
    assert rows(require_not_null(df, ["id", "name"]), "id") == [("a",), ("c",)]
    nums = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert require_not_null(nums, ["x"]).count() == 1


def test_require_positive_drops_nan_null_and_non_positive(spark):
    # N2: NaN > 0 is true in Spark, but NaN is not a valid amount
    df = spark.createDataFrame([(1.5,), (0.0,), (-2.0,), (float("nan"),), (None,)], "amount double")
    assert [r[0] for r in require_positive(df, "amount").collect()] == [1.5]


def test_in_domain_counts_null_as_outside(spark):
    # N3: NOT (NULL IN ...) is NULL in SQL; the check must still count it
    df = spark.createDataFrame([("success",), ("pending",), (None,)], "s string")
    flags = [r[0] for r in df.select(in_domain("s", ["success", "failed"])).collect()]
    assert flags == [True, False, False]
    assert df.where(~in_domain("s", ["success", "failed"])).count() == 2


def test_require_in_normalises_and_filters(spark):
    df = spark.createDataFrame([(" Failed\t",), ("SUCCESS",), ("pending",), (None,)], "status string")
    out = require_in(df, "status", ["success", "failed"])
    assert sorted(r[0] for r in out.collect()) == ["failed", "success"]


def test_require_in_unknown_policy_keeps_missing(spark):
    # N8: the documented rule (missing -> "unknown") as an option
    df = spark.createDataFrame([("Web",), (None,), ("pos",)], "channel string")
    out = require_in(df, "channel", ["web", "mobile", "api"], null_policy="unknown")
    assert sorted(r[0] for r in out.collect()) == ["unknown", "web"]
    dropped = require_in(df, "channel", ["web", "mobile", "api"])
    assert [r[0] for r in dropped.collect()] == ["web"]


def test_reference_rules_and_null_keys(spark):
    # N6: a NULL foreign key is not a reference, even when the parent has a NULL key
    child = spark.createDataFrame([("t1",), ("t2",), (None,)], "transaction_id string")
    parent = spark.createDataFrame([("t1",), (None,)], "transaction_id string")
    assert rows(require_reference(child, parent, "transaction_id"), "transaction_id") == [("t1",)]
    assert rows(orphans(child, parent, "transaction_id"), "transaction_id") == [(None,), ("t2",)]


def test_reference_flag_does_not_multiply_rows(spark):
    child = spark.createDataFrame([("u1", 1), ("u2", 2)], "user_id string, v long")
    parent = spark.createDataFrame([("u1",), ("u1",), ("u1",)], "user_id string")
    out = reference_flag(child, parent, "user_id", "ok")
    assert rows(out, "user_id", "ok") == [("u1", True), ("u2", False)]


def test_reject_table_charges_first_failed_rule_and_keeps_zero_rules(spark):
    df = spark.createDataFrame([(5.0, "x"), (-1.0, "success"), (-1.0, "x"), (2.0, "success")],
                               "amount double, status string").withColumn("_copies", F.lit(1).cast("long"))
    rules = [("amount", F.col("amount") > 0), ("status", F.col("status") == "success"),
             ("never", F.lit(True))]
    out = reject_table("tx", df.withColumn("_r", first_failed_rule(rules)), "_r",
                       ["amount", "status", "never"], copies_col="_copies")
    assert rows(out, "rule", "rejected") == [("amount", 2), ("duplicate_key", 0), ("never", 0), ("status", 1)]


def test_stamp_adds_audit_columns(spark):
    df = stamp(spark.createDataFrame([(1,)], "a int"), "2024-01-01T00:00:00")
    assert df.columns == ["a", "_silver_processed_at", "_source"]
    assert tuple(df.first())[1:] == ("2024-01-01T00:00:00", "bronze")
    now = stamp(spark.createDataFrame([(1,)], "a int")).first()["_silver_processed_at"]
    assert len(now) >= 19 and now[10] == "T"

"""Silver cleaning: hand-written frames and the FIXTURES.md step counts."""

import pytest

from ledgerlake import schemas
from ledgerlake.plans import silver
from ledgerlake.sources.fixtures import bronze_sources
from tests.conftest import SF_SMOKE, rows

STAMP = "2024-01-01T00:00:00"


def _users(spark, data):
    return spark.createDataFrame(data, schemas.BRONZE["users"])


def _tx(spark, data):
    return spark.createDataFrame(data, schemas.BRONZE["transactions"])


def _details(spark, data):
    return spark.createDataFrame(data, schemas.BRONZE["transaction_details"])


def test_clean_users(spark):
    users = _users(spark, [
        ("u1", "Ana", "  ANA@X.CO\t", "2024-01-01T00:00:00", 0),
        ("u1", "Ana2", "other@x.co", "2024-01-01T00:00:00", 1),
        ("u2", None, "b@x.co", "2024-01-01T00:00:00", 0),
        ("u3", "", "c@x.co", "2024-01-01T00:00:00", 0),
    ])
    out = silver.clean_users(users, STAMP)
    assert out.columns == [f.name for f in schemas.SILVER["users"].fields]
    assert rows(out, "user_id", "name", "email") == [("u1", "Ana", "ana@x.co"), ("u3", "", "c@x.co")]


def test_clean_transactions_rules(spark):
    users = silver.clean_users(_users(spark, [("u1", "A", "a@x", "2024-01-01T00:00:00", 0)]), STAMP)
    tx = _tx(spark, [
        ("t1", "u1", 10.0, "\tSUCCESS\n", "2024-01-02T03:04:05", 0),
        ("t2", "u1", float("nan"), "success", "2024-01-02T03:04:05", 0),
        ("t3", "u1", 0.0, "success", "2024-01-02T03:04:05", 0),
        ("t4", "u1", 5.0, "pending", "2024-01-02T03:04:05", 0),
        ("t5", "u9", 5.0, "failed", "2024-01-02T03:04:05", 0),
        ("t6", "u1", 7.0, " Failed ", "2024-01-02T03:04:05.5", 0),
        ("t7", "u1", -1.0, "failed", "2024-01-02T03:04:05", 0),
        ("t7", "u1", 9.0, "failed", "2024-01-02T03:04:05", 1),
        (None, "u1", 3.0, "success", "2024-01-03T00:00:00", 0),
    ])
    out = silver.clean_transactions(tx, users, STAMP)
    assert out.columns == [f.name for f in schemas.SILVER["transactions"].fields]
    assert dict(out.dtypes)["created_at"] == "timestamp_ntz"
    # NULL transaction_id is not a rule violation in Silver (only Gold counts ignore it)
    assert rows(out, "transaction_id", "status") == [(None, "success"), ("t1", "success"), ("t6", "failed")]


def test_clean_details_rules_and_unknown_policy(spark):
    tx = spark.createDataFrame([("t1",), ("t2",)], "transaction_id string")
    details = _details(spark, [
        ("d1", "t1", " Nequi", "Web", 100, 0),
        ("d2", "t1", "crypto", "web", 100, 0),
        ("d3", "t1", "card", "pos", 100, 0),
        ("d4", "t1", "card", "api", 0, 0),
        ("d5", "t9", "card", "api", 10, 0),
        ("d6", "t2", None, " mobile ", 10, 0),
        ("d7", "t2", "PSE", None, 10, 0),
        ("d1", "t1", "cash", "api", 5, 1),
    ])
    out = silver.clean_transaction_details(details, tx, STAMP)
    assert rows(out, "detail_id", "payment_method", "channel") == [("d1", "nequi", "web")]
    unknown = silver.clean_transaction_details(details, tx, STAMP, null_policy="unknown")
    assert rows(unknown, "detail_id", "payment_method", "channel") == [
        ("d1", "nequi", "web"), ("d6", "unknown", "mobile"), ("d7", "pse", "unknown")]


def test_invalid_null_policy(spark):
    tx = spark.createDataFrame([("t1",)], "transaction_id string")
    with pytest.raises(ValueError):
        silver.clean_transaction_details(_details(spark, []), tx, STAMP, null_policy="keep")


def test_step_counts_match_fixtures_doc(spark, bronze_smoke):
    b = bronze_smoke
    assert b["users"].count() == 156
    assert silver.dedupe("users", b["users"]).count() == 150
    s = silver.build_silver(b, STAMP)
    assert s["users"].count() == 142
    assert b["transactions"].count() == 1559
    assert silver.dedupe("transactions", b["transactions"]).count() == 1500
    assert silver.transactions_candidates(b["transactions"]).count() == 1338
    assert s["transactions"].count() == 1283
    assert b["transaction_details"].count() == 6000
    assert silver.dedupe("transaction_details", b["transaction_details"]).count() == 4599
    assert silver.details_with_transaction(b["transaction_details"], s["transactions"]).count() == 3935
    assert s["transaction_details"].count() == 3334


def test_rejects_add_up(spark, bronze_smoke):
    b = bronze_smoke
    s = silver.build_silver(b, STAMP)
    rej = {(r["entity"], r["rule"]): r["rejected"] for r in silver.silver_rejects(b, s["users"], s["transactions"]).collect()}
    assert sum(v for (e, _), v in rej.items() if e == "users") == 156 - 142
    assert sum(v for (e, _), v in rej.items() if e == "transactions") == 1559 - 1283
    assert sum(v for (e, _), v in rej.items() if e == "transaction_details") == 6000 - 3334
    assert rej[("transactions", "duplicate_key")] == 59


def test_bronze_sources_read_whole_tables(spark):
    b = bronze_sources(spark, SF_SMOKE)
    customers = spark.read.parquet(f"{SF_SMOKE}/customer.parquet").count()
    assert b["users"].where("_seq = 0").count() == customers


def test_the_silver_job_deduplicates_each_table_once(spark, monkeypatch):
    """Silver rows and reject counts of a day come from one pass over Bronze, and equal the separate plans."""
    from ledgerlake.plans import medallion
    from ledgerlake.session import scratch_root
    from ledgerlake.sources.layers import read_layer, write_layer

    bronze = {
        "users": spark.createDataFrame([
            ("u1", "A", " A@X ", "t", 0), ("u1", None, "late", "t", 1), ("u2", None, "b@x", "t", 0),
            (None, "N", "n@x", "t", 0), ("u3", "C", "c@x", "t", 0)], schemas.BRONZE["users"]),
        "transactions": spark.createDataFrame([
            ("t1", "u1", 5.0, "\tSuccess ", "2024-01-02T00:00:00", 0), ("t1", "u1", 9.0, "failed", "2024-01-02T00:00:00", 1),
            ("t2", "u2", 5.0, "failed", "not a time", 0), ("t3", "u1", -1.0, "failed", "not a time", 0),
            ("t4", None, 5.0, "failed", "not a time", 0), (None, "u3", 5.0, "FAILED", "2024-01-03T00:00:00", 0),
            ("t5", "u3", float("nan"), "failed", None, 0), ("t6", "u3", 1.0, None, None, 0)], schemas.BRONZE["transactions"]),
        "transaction_details": spark.createDataFrame([
            ("d1", "t1", "CARD", " web ", 10, 0), ("d1", "t1", "pse", "web", 10, 1), ("d2", "t1", None, "web", 10, 0),
            ("d3", "t2", "card", "web", 10, 0), ("d4", "t1", "card", "pos", -1, 0), ("d5", "t1", "card", "web", 0, 0),
            ("d6", None, "card", "web", 5, 0), (None, "t1", "pse", "api\x85", 5, 0)], schemas.BRONZE["transaction_details"]),
    }
    root = scratch_root(spark, "test-once")
    for entity, df in bronze.items():
        write_layer(df, root, "bronze", entity, "2024-01-31")
    calls, real = [], silver.dedupe
    monkeypatch.setattr(silver, "dedupe", lambda entity, *args, **kw: calls.append(entity) or real(entity, *args, **kw))
    for policy in ("drop", "unknown"):
        calls.clear()
        result = medallion.run_silver(spark, root, "2024-01-31", STAMP, policy)
        assert sorted(calls) == sorted(bronze)
        want = silver.build_silver(bronze, STAMP, policy)
        for entity in bronze:
            got = read_layer(spark, root, "silver", entity, "2024-01-31", schemas.SILVER[entity])
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want[entity].collect())), entity
            assert result["counts"][entity] == want[entity].count()
        counted = {(r.entity, r.rule): r.rejected for r in silver.silver_rejects(
            bronze, want["users"], want["transactions"], policy).collect()}
        assert {(e, rule): n for e, rules in result["rejects"].items() for rule, n in rules.items()} == counted
    with pytest.raises(ValueError):
        silver.classify("users", bronze["users"], null_policy="keep")


def test_strip_equals_python_strip(spark):
    from ledgerlake.functions.text import strip_all

    ends = ["", " ", "\t\n", "\x1c\x1f", "\x85", " ", "  ", " 　", "​", "\x00"]
    texts = [a + body + b for a in ends for b in ends for body in ("", "x", "a b", "é", "x y")]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", strip_all("s").alias("t")).collect()
    assert [r.t for r in got] == [r.s.strip() for r in got]

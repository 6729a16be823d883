"""Plan properties: native expressions only, pruning reaches the scan."""

import pytest

from ledgerlake import registry
from tests.conftest import SF_SMOKE

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
WRITING = ("ingest_bronze", "layer_roundtrip", "incremental_new_dates", "rerun_with_empty_entity", "all_rejected_day",
           "skip_and_force", "landed_", "text_rejects", "sorted_write", "stored_")
NO_WRITE = [k for k in registry.QUERIES if not k.startswith(WRITING)]


@pytest.mark.parametrize("name", NO_WRITE)
def test_no_python_in_plans(spark, name):
    plan = registry.QUERIES[name](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES), name


def test_scans_read_only_needed_columns(spark):
    df = registry.QUERIES["gold_channel_metrics"](spark, SF_SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # lineitem columns never used by the bronze derivation are not read
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint" in plan or "l_orderkey" in plan


def test_no_cartesian_products(spark):
    for name in NO_WRITE:
        plan = registry.QUERIES[name](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.fixture
def no_broadcast(spark):
    """Plans as for inputs too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def final_plan(df) -> list[str]:
    """Lines of the plan that ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].splitlines()


def exchanges(lines: list[str], key: str) -> list[int]:
    return [i for i, line in enumerate(lines) if f"Exchange hashpartitioning({key}#" in line]


def child(lines: list[str], at: int) -> str:
    """The first operator below line ``at`` that is no code-generation marker or adapter."""
    return next(line for line in lines[at + 1:] if "InputAdapter" not in line and "WholeStageCodegen" not in line)


def test_stored_facts_shuffle_the_details_once(spark, bronze_smoke, no_broadcast):
    """The details meet one exchange on transaction_id, after their partial aggregate; the tables made from the
    stored facts have none, and no aggregate over distinct users."""
    from ledgerlake.plans import gold
    from ledgerlake.plans.medallion import ingest_bronze, load_layer, run_silver
    from ledgerlake.session import scratch_root
    from ledgerlake.sources.layers import read_layer, write_layer

    root = scratch_root(spark, "test-plan-facts")
    ingest_bronze(spark, bronze_smoke, root, "2024-01-31")
    run_silver(spark, root, "2024-01-31", "x")
    s = load_layer(spark, root, "silver", "2024-01-31")
    facts = gold.transaction_facts(s["transactions"], s["transaction_details"])
    lines = final_plan(facts)
    found = exchanges(lines, "transaction_id")
    assert len(found) == 2                                    # the transactions, and the folded details
    assert sum("HashAggregate" in child(lines, i) and "partial_" in child(lines, i) for i in found) == 1
    assert sum("Exchange" in line for line in lines) == 2
    write_layer(facts, root, "gold", "transaction_facts", "2024-01-31")
    write_layer(gold.user_activity(s["transactions"]), root, "gold", "user_activity", "2024-01-31")
    tables = gold.gold_from_facts(
        s["users"], s["transactions"], read_layer(spark, root, "gold", "transaction_facts", "2024-01-31", facts.schema),
        activity=read_layer(spark, root, "gold", "user_activity", "2024-01-31"))
    for name in ("gold_channel_metrics", "gold_payment_method_metrics", "gold_summary"):
        lines = final_plan(tables[name])
        assert not exchanges(lines, "transaction_id") and not exchanges(lines, "user_id"), name
        assert not any("Expand" in line or "distinct" in line for line in lines), name


@pytest.mark.parametrize("name", ["gold_channel_metrics", "gold_payment_method_metrics", "gold_summary", "summary_per_tx"])
def test_chained_gold_folds_details_before_any_shuffle_on_the_transaction(spark, bronze_smoke, no_broadcast, name):
    from ledgerlake.plans import gold

    lines = final_plan(gold.gold_from_bronze(bronze_smoke, with_generated_at=False)[name])
    detail = [i for i in exchanges(lines, "transaction_id")
              if "HashAggregate" in child(lines, i) and "processing_time_ms" in child(lines, i)]
    assert len(detail) == 1                                   # folded map-side, then shuffled
    assert not any("processing_time_ms" in line and "hashpartitioning(transaction_id" in line for line in lines)
    semi = [line for line in lines if "LeftSemi" in line]
    assert all("user_id" in line for line in semi) and len(semi) == 1   # details need no semi-join of their own


def test_chained_user_metrics_fold_per_user_before_the_shuffle(spark, bronze_smoke, no_broadcast):
    from ledgerlake.plans import gold

    lines = final_plan(gold.gold_from_bronze(bronze_smoke)["gold_user_metrics"])
    assert not any("LeftSemi" in line for line in lines)
    for i in exchanges(lines, "user_id"):
        assert "partial_" in child(lines, i)


def test_places_are_joined_without_moving_the_rows(spark, no_broadcast, tmp_path):
    """The starts of the files are broadcast whatever the thresholds: rows are not shuffled by their file."""
    from ledgerlake.operators.position import file_position

    spark.range(100).repartition(3).write.parquet(f"{tmp_path}/rows")
    lines = final_plan(file_position(spark.read.parquet(f"{tmp_path}/rows")))
    assert any("BroadcastHashJoin" in line for line in lines)
    assert not any("SortMergeJoin" in line for line in lines)


def test_the_rewritten_day_is_read_from_the_store(spark, monkeypatch):
    """layer_roundtrip cleans Bronze for its two first writes only."""
    written, real = [], registry.write_layer

    def write(df, root, *args, **kw):
        written.append(any("/silver/" in path for path in df.inputFiles()))
        return real(df, root, *args, **kw)

    monkeypatch.setattr(registry, "write_layer", write)
    rows = registry.QUERIES["layer_roundtrip_details"](spark, SF_SMOKE)
    assert written == [False, False, True]
    assert {r["_silver_processed_at"] for r in rows.select("_silver_processed_at").distinct().collect()} == {registry.PROCESSED_AT}

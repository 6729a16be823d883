"""Layer store, idempotent re-runs, incremental loads, end-to-end run."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import silver
from ledgerlake.plans.medallion import ingest_bronze, read_gold, run_medallion, with_arrival_order
from ledgerlake.plans.quality import QualityGateError
from ledgerlake.session import scratch_root
from ledgerlake.sources.fixtures import bronze_sources
from ledgerlake.sources import layers
from ledgerlake.sources.layers import (
    partition_exists,
    path_exists,
    read_layer,
    read_manifest,
    stored_dates,
    write_layer,
    write_layer_counted,
)
from ledgerlake.streaming import already_processed, ingest_new_dates, new_dates
from tests.conftest import SF_SMOKE, rows


def _users(spark, n, tag):
    return spark.createDataFrame([(f"u{i}", tag) for i in range(n)], "user_id string, name string")


def test_dynamic_overwrite_replaces_only_that_date(spark):
    root = scratch_root(spark, "test-overwrite")
    write_layer(_users(spark, 3, "old"), root, "silver", "users", "2024-01-01")
    write_layer(_users(spark, 2, "keep"), root, "silver", "users", "2024-01-02")
    write_layer(_users(spark, 4, "new"), root, "silver", "users", "2024-01-01")
    day1 = read_layer(spark, root, "silver", "users", "2024-01-01")
    day2 = read_layer(spark, root, "silver", "users", "2024-01-02")
    assert sorted(r.name for r in day1.collect()) == ["new"] * 4
    assert sorted(r.name for r in day2.collect()) == ["keep"] * 2
    assert partition_exists(spark, root, "silver", "users", "2024-01-02")
    assert not partition_exists(spark, root, "silver", "users", "2024-01-03")
    assert not partition_exists(spark, root, "silver", "nothing", "2024-01-03")
    dates = sorted(str(r.date) for r in stored_dates(spark, root, "silver", "users").collect())
    assert dates == ["2024-01-01", "2024-01-02"]
    assert stored_dates(spark, root, "silver", "nothing").count() == 0


def test_read_layer_prunes_partitions(spark):
    root = scratch_root(spark, "test-prune")
    write_layer(_users(spark, 2, "a"), root, "bronze", "users", "2024-01-01")
    df = read_layer(spark, root, "bronze", "users", "2024-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-01" in plan


def test_ingest_skips_when_present_and_force_reloads(spark):
    root = scratch_root(spark, "test-ingest")
    sources = {"users": _users(spark, 3, "x"), "transactions": _users(spark, 2, "y")}
    first = ingest_bronze(spark, sources, root, "2024-01-01")
    assert first["incremental"] is False and first["counts"] == {"users": 3, "transactions": 2}
    again = ingest_bronze(spark, sources, root, "2024-01-01")
    assert again == {"paths": first["paths"], "counts": {"skipped": True}, "incremental": True}
    forced = ingest_bronze(spark, sources, root, "2024-01-01", force=True)
    assert forced["counts"] == {"users": 3, "transactions": 2}
    assert read_layer(spark, root, "bronze", "users", "2024-01-01").count() == 3
    assert already_processed(spark, root, "2024-01-01", ["users", "transactions"])
    assert not already_processed(spark, root, "2024-01-02", ["users"])
    stored = read_layer(spark, root, "bronze", "users", "2024-01-01")
    assert "_seq" in stored.columns


def test_arrival_order_is_added_once(spark):
    df = _users(spark, 3, "x")
    assert "_seq" in with_arrival_order(df).columns
    assert with_arrival_order(df.withColumn("_seq", F.lit(7))).first()["_seq"] == 7


def test_incremental_new_dates(spark):
    root = scratch_root(spark, "test-incremental")
    data = spark.createDataFrame(
        [("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-02"), ("d", "2024-01-03"), ("e", None)],
        "id string, day string").withColumn("day", F.to_date("day"))
    first = ingest_new_dates(spark, data.where("day < '2024-01-02'"), root, "bronze", "events", "day")
    assert first.written == {"2024-01-01": 2} and first.skipped_null_date == 0
    second = ingest_new_dates(spark, data, root, "bronze", "events", "day")
    assert second.written == {"2024-01-02": 1, "2024-01-03": 1}
    assert second.skipped_stored == {"2024-01-01": 2} and second.skipped_null_date == 1
    stored = spark.read.parquet(f"{root}/bronze/events")
    assert stored.count() == 4    # the stored day was not written twice
    assert new_dates(data.withColumnRenamed("day", "date"), stored.select("date")).count() == 0
    late = data.unionByName(spark.createDataFrame([("f", "2024-01-01")], "id string, day string")
                            .withColumn("day", F.to_date("day")))
    assert ingest_new_dates(spark, late, root, "bronze", "events", "day", force=["2024-01-01"]).written == {"2024-01-01": 3}
    assert spark.read.parquet(f"{root}/bronze/events").count() == 5


def test_an_empty_result_replaces_the_partition(spark):
    root = scratch_root(spark, "test-empty")
    full = _users(spark, 3, "x")
    write_layer(full, root, "silver", "users", "2024-01-01")
    write_layer(full, root, "silver", "users", "2024-01-02")
    write_layer(full.limit(0), root, "silver", "users", "2024-01-01")
    assert read_layer(spark, root, "silver", "users", "2024-01-01", full.schema).count() == 0
    assert read_layer(spark, root, "silver", "users", "2024-01-02", full.schema).count() == 3
    assert already_processed(spark, root, "2024-01-01", ["users"], "silver")


def test_a_day_where_everything_is_rejected_still_reports(spark):
    root = scratch_root(spark, "test-rejected")
    sources = dict(bronze_sources(spark, SF_SMOKE))
    sources["users"] = sources["users"].withColumn("email", F.lit(None).cast("string"))
    result = run_medallion(spark, sources, root, "2024-01-31", as_of="2001-12-31T00:00:00")
    assert set(result["silver"]["counts"].values()) == {0}
    report = spark.read.option("header", True).csv(result["quality"]["path"])
    assert {r.status for r in report.where(F.col("check") == "record_count").collect()} == {"FAIL"}
    again = run_medallion(spark, sources, root, "2024-01-31", as_of="2001-12-31T00:00:00")
    assert again["quality"]["path"] != result["quality"]["path"]    # one report per run


def test_end_to_end_run_is_idempotent(spark):
    root = scratch_root(spark, "test-e2e")
    sources = bronze_sources(spark, SF_SMOKE)
    kw = dict(as_of="2001-12-31T00:00:00", processed_at="2024-01-31T06:00:00", checked_at="2024-01-31T06:00:00")
    result = run_medallion(spark, sources, root, "2024-01-31", gate=True, **kw)
    assert result["silver"]["counts"] == {"users": 142, "transactions": 1283, "transaction_details": 3334}
    # per-rule rejects stored by the run equal the one-pass reject table
    s = silver.build_silver(sources, "x")
    table = {(r.entity, r.rule): r.rejected
             for r in silver.silver_rejects(sources, s["users"], s["transactions"]).collect()}
    observed = {(e, rule): n for e, rules in result["silver"]["rejects"].items() for rule, n in rules.items()}
    assert observed == table
    assert observed[("transactions", "duplicate_key")] == 59
    assert result["quality"]["summary"]["passed"] == 18
    gold1 = read_gold(spark, root, "gold_user_metrics", "2024-01-31")
    snapshot = rows(gold1, "user_id", "total_transactions", "total_amount")
    assert len(snapshot) == 142
    again = run_medallion(spark, sources, root, "2024-01-31", **kw)
    assert again["bronze"]["incremental"] is True
    gold2 = read_gold(spark, root, "gold_user_metrics", "2024-01-31")
    assert rows(gold2, "user_id", "total_transactions", "total_amount") == snapshot
    report = spark.read.option("header", True).csv(result["quality"]["path"])
    assert report.columns == ["entity", "check", "status", "detail", "checked_at"]
    assert report.count() == 18
    with pytest.raises(QualityGateError):
        run_medallion(spark, sources, root, "2024-01-31", gate=True, as_of="2003-01-01T00:00:00")


def test_gold_from_stored_facts_equals_separate_plans(spark):
    from ledgerlake.plans.gold import build_gold
    from ledgerlake.plans.medallion import ingest_bronze as ingest, load_layer, run_gold, run_silver

    root = scratch_root(spark, "test-gold-facts")
    ingest(spark, bronze_sources(spark, SF_SMOKE), root, "2024-01-31")
    run_silver(spark, root, "2024-01-31", "x")
    run_gold(spark, root, "2024-01-31")
    for name, df in build_gold(load_layer(spark, root, "silver", "2024-01-31")).items():
        stored = read_gold(spark, root, name, "2024-01-31").drop("generated_at")
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.select(stored.columns).collect()))


# --------------------------------------------------------------------------- versions of a day

def _names(spark, root, day):
    return sorted(r.name for r in read_layer(spark, root, "silver", "users", day).collect())


@pytest.mark.parametrize("step", ["_switch", "_replace", "_clean"])
@pytest.mark.parametrize("rows", [2, 0])
def test_a_write_that_fails_half_way_leaves_a_whole_day(spark, monkeypatch, step, rows):
    """Failing after the files, after the staged manifest, and after the switch: the day is the old one or the new one."""
    root = scratch_root(spark, "test-crash")
    write_layer(_users(spark, 3, "old"), root, "silver", "users", "2024-01-01")
    write_layer(_users(spark, 1, "other"), root, "silver", "users", "2024-01-02")

    def fail(*args):
        raise OSError("no more")

    with monkeypatch.context() as m:
        m.setattr(layers, step, fail)
        with pytest.raises(OSError):
            write_layer(_users(spark, rows, "new"), root, "silver", "users", "2024-01-01")
    assert _names(spark, root, "2024-01-01") == (["new"] * rows if step == "_clean" else ["old"] * 3)
    assert _names(spark, root, "2024-01-02") == ["other"]
    write_layer(_users(spark, 4, "next"), root, "silver", "users", "2024-01-01")
    assert _names(spark, root, "2024-01-01") == ["next"] * 4
    assert len(layers._names(spark, f"{root}/silver/users/date=2024-01-01")) == 2     # the current and the one before
    assert sorted(layers._names(spark, f"{root}/silver/users/_manifest")) == ["2024-01-01.json", "2024-01-02.json"]


def test_a_first_write_that_fails_does_not_count_as_landed(spark, monkeypatch):
    root = scratch_root(spark, "test-crash-first")

    def fail(*args):
        raise OSError("no more")

    with monkeypatch.context() as m:
        m.setattr(layers, "_switch", fail)
        with pytest.raises(OSError):
            ingest_bronze(spark, {"users": _users(spark, 3, "x")}, root, "2024-01-01")
    assert not partition_exists(spark, root, "bronze", "users", "2024-01-01")
    assert stored_dates(spark, root, "bronze", "users").count() == 0
    assert ingest_bronze(spark, {"users": _users(spark, 3, "x")}, root, "2024-01-01")["counts"] == {"users": 3}


def test_a_replace_in_two_steps_that_fails_between_them_rolls_forward(spark, monkeypatch):
    """Where the file system deletes the old manifest first: the staged one is found."""
    root = scratch_root(spark, "test-crash-between")
    write_layer(_users(spark, 3, "old"), root, "silver", "users", "2024-01-01")

    def half(spark_, source, target):
        layers.delete_folder(spark_, target)
        raise OSError("no more")

    with monkeypatch.context() as m:
        m.setattr(layers, "_replace", half)
        with pytest.raises(OSError):
            write_layer(_users(spark, 2, "new"), root, "silver", "users", "2024-01-01")
    assert _names(spark, root, "2024-01-01") == ["new"] * 2
    layers._write_text(spark, f"{root}/silver/users/_manifest/2024-01-01.json.vcut.staged", '{"version": "vc')
    assert _names(spark, root, "2024-01-01") == ["new"] * 2                           # a cut-off one is passed over
    write_layer(_users(spark, 1, "next"), root, "silver", "users", "2024-01-01")
    assert _names(spark, root, "2024-01-01") == ["next"]


def test_rows_of_a_sorted_write_are_those_stored(spark):
    root = scratch_root(spark, "test-sorted")
    df = spark.range(20_000).groupBy((F.col("id") % 15_000).alias("k")).count().repartition(6)
    _, rows_said = write_layer_counted(df, root, "gold", "t", "2024-01-01", [F.desc("count"), F.asc("k")])
    assert rows_said == 15_000 == read_layer(spark, root, "gold", "t", "2024-01-01").count()
    assert read_manifest(spark, root, "gold", "t", "2024-01-01").rows == 15_000


def test_a_reader_that_has_begun_keeps_its_version(spark):
    root = scratch_root(spark, "test-reader")
    write_layer(_users(spark, 3, "old"), root, "silver", "users", "2024-01-01")
    begun = read_layer(spark, root, "silver", "users", "2024-01-01")
    write_layer(_users(spark, 2, "new"), root, "silver", "users", "2024-01-01")
    assert [r.name for r in begun.collect()] == ["old"] * 3
    assert _names(spark, root, "2024-01-01") == ["new"] * 2


def test_dates_written_in_one_job_and_versions_meet(spark):
    root = scratch_root(spark, "test-meet")
    data = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "id string, day string").withColumn("day", F.to_date("day"))
    ingest_new_dates(spark, data, root, "bronze", "events", "day")
    write_layer(spark.createDataFrame([("c",)], "id string"), root, "bronze", "events", "2024-01-01")
    assert [r.id for r in read_layer(spark, root, "bronze", "events", "2024-01-01").collect()] == ["c"]
    assert [r.id for r in read_layer(spark, root, "bronze", "events", "2024-01-02").collect()] == ["b"]
    assert not any(n.startswith("part-") for n in layers._names(spark, f"{root}/bronze/events/date=2024-01-01"))
    ingest_new_dates(spark, data, root, "bronze", "events", "day", force=["2024-01-01"])
    assert [r.id for r in read_layer(spark, root, "bronze", "events", "2024-01-01").collect()] == ["a"]
    assert stored_dates(spark, root, "bronze", "events").count() == 2


# --------------------------------------------------------------------------- places in files

SPLITS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def two_splits(spark):
    saved = {k: spark.conf.get(k) for k in (SPLITS, "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield ("128m", "20k")
    for k, v in saved.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_places_do_not_depend_on_the_splits(spark, two_splits, fmt):
    from ledgerlake.operators import file_position

    root = scratch_root(spark, "test-places")
    schema = "id long, v string"
    spark.range(0, 30_000, 1, 3).selectExpr("id", "concat('v', id % 7) AS v").write.format(fmt).option("header", True).save(f"{root}/in")
    seen = set()
    for size in two_splits:
        spark.conf.set(SPLITS, size)
        df = spark.read.schema(schema).option("header", True).format(fmt).load(f"{root}/in")
        seen.add(df.rdd.getNumPartitions())
        placed = file_position(df)
        assert placed.columns == ["id", "v", "position"]
        wrong = placed.where(F.col("position") != F.col("id") + 1).count()
        assert placed.count() == 30_000 and wrong == 0
    assert len(seen) == 2


def test_landing_the_same_files_under_two_splits_keeps_the_same_rows(spark, two_splits):
    from ledgerlake import schemas

    root = scratch_root(spark, "test-arrival")
    rows_in = spark.range(0, 20_000, 1, 4).selectExpr(
        "concat('u', id % 6000) AS user_id", "concat('n', id) AS name", "concat('e', id, '@x') AS email",
        "'2024-01-01T00:00:00' AS created_at")
    rows_in.write.parquet(f"{root}/in")
    kept = []
    for i, size in enumerate(two_splits):
        spark.conf.set(SPLITS, size)
        ingest_bronze(spark, {"users": spark.read.parquet(f"{root}/in")}, f"{root}/{i}", "2024-01-01")
        users = silver.users_valid(read_layer(spark, f"{root}/{i}", "bronze", "users", "2024-01-01", schemas.BRONZE["users"]))
        kept.append(rows(users, "user_id", "name"))
    assert kept[0] == kept[1] == sorted((f"u{k}", f"n{k}") for k in range(6000))


# --------------------------------------------------------------------------- text sources

CSV = [
    "transaction_id,user_id,amount,status,created_at",
    "t1,u1,10.5,success,2024-01-01T00:00:00",
    "t2,u1,much,success,2024-01-01T00:00:00",             # no number
    "t3,u1,7",                                            # too few fields
    "t4,,8,\"a, b\",2024-01-01T00:00:00",
    "t5,u1,1,failed,2024-01-01T00:00:00,extra",           # too many fields
    "t1,u2,11, Failed ,2024-01-02T00:00:00",
]
JSON = [
    '{"transaction_id": "t1", "user_id": "u1", "amount": 10.5, "status": "success", "created_at": "2024-01-01T00:00:00"}',
    '{"transaction_id": "t2", "amount": "much"}',
    '{"transaction_id": "t3", "us',
    '{"transaction_id": "t4", "amount": 8, "status": "a, b", "created_at": "2024-01-01T00:00:00"}',
    "not json at all",
    '{"transaction_id": "t1", "user_id": "u2", "amount": 11, "status": " Failed ", "created_at": "2024-01-02T00:00:00", "more": 1}',
]


def _text(spark, lines, name):
    path = f"{scratch_root(spark, 'test-text')}/{name}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("fmt,lines", [("csv", CSV), ("json", JSON)])
def test_text_lands_with_its_malformed_lines_beside_it(spark, fmt, lines):
    from ledgerlake import schemas
    from ledgerlake.plans.medallion import malformed_counts
    from ledgerlake.sources.text import TextSource

    root = scratch_root(spark, "test-text-land")
    done = ingest_bronze(spark, {"transactions": TextSource(fmt, _text(spark, lines, fmt))}, root, "2024-01-01")
    assert done["counts"] == {"transactions": 3}
    got = read_layer(spark, root, "bronze", "transactions", "2024-01-01", schemas.BRONZE["transactions"])
    assert [(r.transaction_id, r.user_id, r.amount, r.status) for r in got.orderBy("_seq").collect()] == [
        ("t1", "u1", 10.5, "success"), ("t4", None, 8.0, "a, b"), ("t1", "u2", 11.0, " Failed ")]
    bad = read_layer(spark, root, "bronze", "transactions_malformed", "2024-01-01")
    broken = lines[2:4] + lines[5:6] if fmt == "csv" else lines[1:3] + lines[4:5]
    assert [r.line for r in bad.orderBy("_seq").collect()] == broken
    assert malformed_counts(spark, root, "2024-01-01") == {"transactions": 3}
    # a later landing from a table leaves no malformed lines of the former one
    clean = spark.createDataFrame([("t9", "u1", 1.0, "success", "2024-01-01T00:00:00", 0)], schemas.BRONZE["transactions"])
    ingest_bronze(spark, {"transactions": clean}, root, "2024-01-01", force=True)
    assert malformed_counts(spark, root, "2024-01-01") == {"transactions": 0}


def test_text_format_must_be_known(spark):
    from ledgerlake import schemas
    from ledgerlake.sources.text import read_text

    with pytest.raises(ValueError, match="format"):
        read_text(spark, "xml", "/nowhere", schemas.BRONZE["users"])


def test_paths_are_looked_up_not_read(spark):
    assert not path_exists(spark, f"{scratch_root(spark, 'test-none')}/x")


def test_independent_jobs_run_together_and_the_first_failure_is_raised():
    import threading

    from ledgerlake.session import side_by_side

    meet = threading.Barrier(2, timeout=30)
    assert side_by_side({"a": lambda: meet.wait() * 0 + 1, "b": lambda: meet.wait() * 0 + 2}) == {"a": 1, "b": 2}
    assert side_by_side({}) == {}
    ended = []

    def fails():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        side_by_side({"a": fails, "b": lambda: ended.append(1)})
    assert ended == [1]

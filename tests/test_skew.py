"""Hot keys: one key holding most rows must give exact results through every keyed step."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import keep_first
from ledgerlake.plans import gold, quality

N = 20000
TS = dt.datetime(2024, 1, 1)


def test_keep_first_hot_key(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id").cast("string"))).otherwise(F.lit("hot"))
         .alias("k"),
        (N - F.col("id")).alias("_seq"),
        F.col("id").alias("v"),
    ).repartition(8)
    out = keep_first(df, ["k"], ["_seq"], copies_col="_copies")
    got = {r.k: (r.v, r._copies) for r in out.collect()}
    hot_ids = [i for i in range(N) if i % 10 != 0]
    assert got["hot"] == (max(hot_ids), len(hot_ids))     # lowest _seq = highest id
    assert len(got) == 1 + N // 10


def test_gold_with_hot_transaction_and_user(spark):
    # one transaction carries most details, one user most transactions
    tx = spark.range(1000).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("transaction_id"),
        F.when(F.col("id") < 900, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string")))
         .alias("user_id"),
        (F.col("id") % 7 + 1).cast("double").alias("amount"),
        F.when(F.col("id") % 3 == 0, "failed").otherwise("success").alias("status"),
        F.lit(TS).cast("timestamp_ntz").alias("created_at"),
    )
    details = spark.range(N).select(
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("detail_id"),
        F.when(F.col("id") < N - 1000, F.lit("t0"))
         .otherwise(F.concat(F.lit("t"), (F.col("id") % 1000).cast("string"))).alias("transaction_id"),
        F.lit("card").alias("payment_method"),
        F.when(F.col("id") % 2 == 0, "web").otherwise("api").alias("channel"),
        (F.col("id") % 100 + 1).alias("processing_time_ms"),
    ).repartition(8)
    t_rows = [(f"t{i}", "hot" if i < 900 else f"u{i}", float(i % 7 + 1), "failed" if i % 3 == 0 else "success")
              for i in range(1000)]
    d_rows = [(("t0" if i < N - 1000 else f"t{i % 1000}"), "web" if i % 2 == 0 else "api", i % 100 + 1)
              for i in range(N)]
    amount = {t: a for t, _, a, _ in t_rows}
    status = {t: s for t, _, _, s in t_rows}
    got = {r.channel: r for r in gold.dimension_metrics(tx, details, "channel").collect()}
    for ch in ("web", "api"):
        rows = [d for d in d_rows if d[1] == ch]
        assert got[ch].total_transactions == len({d[0] for d in rows})
        assert got[ch].total_amount == sum(amount[d[0]] for d in rows)
        assert got[ch].successful == sum(status[d[0]] == "success" for d in rows)
    users = spark.createDataFrame([("hot", "h", "h@x", "2024", "s", "bronze")], schemas.SILVER["users"])
    hot = gold.gold_user_metrics(users, tx).first()
    assert hot.total_transactions == 900
    assert hot.total_amount == sum(a for t, u, a, _ in t_rows if u == "hot")
    tx_full = tx.withColumns({"_silver_processed_at": F.lit("s"), "_source": F.lit("bronze")})
    dupes = quality.duplicate_counts(tx_full.unionByName(tx_full.where("user_id = 'hot'")), "tx", "transaction_id")
    assert dupes.first().duplicates == 900


def test_rejects_with_hot_unknown_user(spark):
    from ledgerlake.plans import silver

    users_b = spark.createDataFrame([("u1", "A", "a@x", "2024-01-01T00:00:00", 0)], schemas.BRONZE["users"])
    tx_b = spark.range(5000).select(
        F.concat(F.lit("t"), (F.col("id") % 4000).cast("string")).alias("transaction_id"),
        F.when(F.col("id") % 5 == 0, "u1").otherwise("hot").alias("user_id"),
        F.when(F.col("id") % 7 == 0, -1.0).otherwise(10.0).alias("amount"),
        F.lit("success").alias("status"),
        F.lit("2024-01-02T00:00:00").alias("created_at"),
        F.col("id").alias("_seq"),
    ).repartition(8)
    details_b = spark.createDataFrame([("d1", "t0", "card", "web", 10, 0)], schemas.BRONZE["transaction_details"])
    bronze = {"users": users_b, "transactions": tx_b, "transaction_details": details_b}
    s = silver.build_silver(bronze, "x")
    got = {(r.entity, r.rule): r.rejected
           for r in silver.silver_rejects(bronze, s["users"], s["transactions"]).collect()}
    # keep-first per transaction id: the lowest id among id, id + 4000
    kept = {}
    for i in range(5000):
        kept.setdefault(f"t{i % 4000}", i)
    amount_bad = sum(1 for i in kept.values() if i % 7 == 0)
    hot = sum(1 for i in kept.values() if i % 7 != 0 and i % 5 != 0)
    assert got[("transactions", "duplicate_key")] == 1000
    assert got[("transactions", "amount_not_positive")] == amount_bad
    assert got[("transactions", "invalid_status")] == 0
    assert got[("transactions", "unknown_user")] == hot
    assert s["transactions"].count() == 4000 - amount_bad - hot


def test_chained_gold_with_hot_keys_and_orphans_equals_the_steps(spark):
    """From Bronze in one plan, broadcast off: a hot transaction, a hot user, and details mostly without a transaction."""
    from ledgerlake.plans import silver

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    users_b = spark.range(50).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"), F.lit("n").alias("name"),
        F.lit("e@x").alias("email"), F.lit("2024-01-01T00:00:00").alias("created_at"), F.col("id").alias("_seq"))
    tx_b = spark.range(3000).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "u1").when(F.col("id") % 3 == 1, "nobody")
         .otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("user_id"),
        ((F.col("id") % 9) * 1.5).alias("amount"),
        F.when(F.col("id") % 4 == 0, " Failed").otherwise("SUCCESS").alias("status"),
        F.lit("2024-01-02T00:00:00").alias("created_at"), F.col("id").alias("_seq")).repartition(8)
    details_b = spark.range(N).select(
        F.concat(F.lit("d"), (F.col("id") % (N - 500)).cast("string")).alias("detail_id"),
        F.when(F.col("id") % 3 == 0, "t3").when(F.col("id") % 3 == 1, F.concat(F.lit("gone"), F.col("id").cast("string")))
         .otherwise(F.concat(F.lit("t"), (F.col("id") % 3000).cast("string"))).alias("transaction_id"),
        F.when(F.col("id") % 5 == 0, "PSE").when(F.col("id") % 5 == 1, "gold").otherwise("card ").alias("payment_method"),
        F.when(F.col("id") % 2 == 0, "web").otherwise("API").alias("channel"),
        (F.col("id") % 100 - 3).alias("processing_time_ms"), F.col("id").alias("_seq")).repartition(8)
    bronze = {"users": users_b, "transactions": tx_b, "transaction_details": details_b}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        steps = gold.build_gold(silver.build_silver(bronze, "x"), with_generated_at=False)
        chain = gold.gold_from_bronze(bronze, with_generated_at=False)
        for name, df in steps.items():
            want = sorted(map(tuple, df.collect()))
            assert want and sorted(map(tuple, chain[name].collect())) == want, name
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)

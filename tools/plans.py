"""Write PLANS.md: the physical plans of the pipeline's jobs (as run from stored layers).

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.constants import WHITESPACE  # noqa: E402
from ledgerlake.plans import gold, quality, silver  # noqa: E402
from ledgerlake.plans.medallion import ingest_bronze, load_layer, run_silver  # noqa: E402
from ledgerlake.session import build_session, scratch_root  # noqa: E402
from ledgerlake.sources.fixtures import bronze_sources  # noqa: E402
from ledgerlake.sources.layers import read_layer, write_layer  # noqa: E402

NOTES = {
    "silver_users": "Keep-first is a partial SortAggregate before the exchange and a final one after it: "
                    "copies of a key are folded map-side. The date filter is a PartitionFilter of the scan.",
    "silver_transactions": "Rules run above the final aggregate (they must see the kept copy only); the user "
                           "check is a LEFT SEMI join, sort-merge with skew splitting here; AQE broadcasts Silver users "
                           "whose measured size is small.",
    "silver_transaction_details": "Same shape: keep-first on detail_id, then a LEFT SEMI join on transaction_id.",
    "gold_user_metrics": "Transactions are aggregated per user before the LEFT OUTER join with users; the "
                         "global order is a range exchange on (total_amount, user_id).",
    "transaction_facts": "Details are folded to one row of counters per transaction before their one exchange, on "
                         "transaction_id, which the join with the transactions uses.",
    "gold_channel_metrics_stored": "From the stored facts: each fact row is split by channel (Generate) and summed map-side; "
                                   "no exchange on transaction_id.",
    "gold_summary_stored": "From the stored facts and the stored user activity: two one-row aggregates side by side (Union), "
                           "no distinct aggregate.",
    "gold_channel_metrics_from_bronze": "One plan from Bronze: deduplicated details are folded per transaction; the join with the clean "
                                        "transactions takes the place of a semi-join of every detail row.",
    "quality_report": "One aggregate per table and one anti-join count per foreign key (child rows counted per key first), stacked with Union "
                      "and folded into one row, then Generate(stack) into 18 rows.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.ui.showConsoleProgress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_root(spark, "plans")
    run_date = "2024-01-31"
    ingest_bronze(spark, bronze_sources(spark, sf_dir), root, run_date)
    run_silver(spark, root, run_date, "x")
    b = load_layer(spark, root, "bronze", run_date)
    s = load_layer(spark, root, "silver", run_date)
    facts = gold.transaction_facts(s["transactions"], s["transaction_details"])
    activity = gold.user_activity(s["transactions"])
    write_layer(facts, root, "gold", "transaction_facts", run_date)
    write_layer(activity, root, "gold", "user_activity", run_date)
    stored = gold.gold_from_facts(
        s["users"], s["transactions"], read_layer(spark, root, "gold", "transaction_facts", run_date, facts.schema),
        activity=read_layer(spark, root, "gold", "user_activity", run_date, activity.schema))
    frames = {
        "silver_users": silver.clean_users(b["users"], "x"),
        "silver_transactions": silver.clean_transactions(b["transactions"], s["users"], "x"),
        "silver_transaction_details": silver.clean_transaction_details(b["transaction_details"],
                                                                       s["transactions"], "x"),
        "gold_user_metrics": gold.sorted_user_metrics(gold.gold_user_metrics(s["users"], s["transactions"])),
        "transaction_facts": facts,
        "gold_channel_metrics_stored": stored["gold_channel_metrics"],
        "gold_summary_stored": stored["gold_summary"],
        "gold_channel_metrics_from_bronze": gold.gold_from_bronze(b)["gold_channel_metrics"],
        "quality_report": quality.quality_report(s["users"], s["transactions"], s["transaction_details"],
                                                 b["transactions"], b["transaction_details"],
                                                 "2001-12-31T00:00:00", "x"),
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/plans.py` from stored Bronze/Silver layers of `{sf_dir}` (local[8], AQE on, "
           "broadcast off as for inputs too large for it; the plans are the initial adaptive plans, before runtime re-optimisation).", ""]
    for name, df in frames.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        text = buf.getvalue().strip().replace(WHITESPACE, "<whitespace>")
        out += [f"## {name}", "", NOTES[name], "", "```", text, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

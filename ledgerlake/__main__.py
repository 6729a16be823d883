"""Command line: run the whole job for one date.

    python -m ledgerlake --root /shared/lake --run-date 2024-01-31 \\
        --source users=parquet:/in/users --source transactions=json:/in/tx --source transaction_details=csv:/in/details.csv
    python -m ledgerlake --sf-dir /root/testdata/sf0.01 --root /shared/lake --run-date 2024-01-31

Sources are either files given by ``--source entity=format:path`` for each entity (Parquet, CSV with a
header, JSON lines), or the three Bronze inputs derived from the driver tables of
``--sf-dir``. ``--root`` must lie on storage that all executors share. Prints
the run result as JSON and exits non-zero when ``--gate`` is set and a check
failed. The job runs no Python on executors; for the corpus operators, give spark-submit the
package as ``--py-files``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.constants import ENTITIES
from ledgerlake.plans.medallion import run_medallion
from ledgerlake.plans.quality import QualityGateError
from ledgerlake.session import build_session
from ledgerlake.sources.fixtures import bronze_sources
from ledgerlake.sources.text import FORMATS, TextSource


def parse_source(text: str) -> tuple[str, str, str]:
    """(entity, format, path) of ``entity=format:path``."""
    entity, _, rest = text.partition("=")
    fmt, _, path = rest.partition(":")
    if entity not in ENTITIES or fmt not in ("parquet", *FORMATS) or not path:
        raise argparse.ArgumentTypeError(
            f"{text!r} is not entity=format:path (entities: {', '.join(ENTITIES)}; formats: parquet, {', '.join(FORMATS)})")
    return entity, fmt, path


def file_sources(spark: SparkSession, given: list[tuple[str, str, str]]) -> dict[str, DataFrame | TextSource]:
    """The sources of all entities, in dependency order."""
    found = {entity: spark.read.parquet(path) if fmt == "parquet" else TextSource(fmt, path) for entity, fmt, path in given}
    return {e: found[e] for e in ENTITIES}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m ledgerlake", description=__doc__.splitlines()[0])
    parser.add_argument("--sf-dir", help="directory with customer/orders/lineitem parquet")
    parser.add_argument("--source", action="append", type=parse_source, default=[], metavar="ENTITY=FORMAT:PATH",
                        help="files of one entity; give it for every entity")
    parser.add_argument("--root", required=True, help="layer store root on storage that all executors share")
    parser.add_argument("--run-date", help="partition date YYYY-MM-DD (default: today)")
    parser.add_argument("--as-of", help="freshness reference time (default: now)")
    parser.add_argument("--force", action="store_true", help="reload Bronze even if the date exists")
    parser.add_argument("--gate", action="store_true", help="fail when a quality check fails")
    parser.add_argument("--null-policy", choices=("drop", "unknown"), default="drop")
    parser.add_argument("--master", default=None, help="Spark master (default: from spark-submit / local[*])")
    args = parser.parse_args(argv)
    if bool(args.sf_dir) == bool(args.source):
        parser.error("give either --sf-dir or --source")
    if args.source and sorted(e for e, _, _ in args.source) != sorted(ENTITIES):
        parser.error(f"give --source once for each of {', '.join(ENTITIES)}")

    spark = build_session(master=args.master or "local[*]")
    root = args.root
    try:
        sources = file_sources(spark, args.source) if args.source else bronze_sources(spark, args.sf_dir)
        result = run_medallion(spark, sources, root, args.run_date,
                               as_of=args.as_of, force=args.force, gate=args.gate,
                               null_policy=args.null_policy)
    except QualityGateError as err:
        print(json.dumps({"root": root, "error": str(err)}))
        spark.stop()
        return 2
    result["root"] = root
    print(json.dumps(result, default=str))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

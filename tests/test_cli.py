"""The command line runs the whole job and applies the gate."""

import json
import os
import subprocess
import sys
import tempfile

from tests.conftest import ROOT, SF_SMOKE


def _run(*args):
    return subprocess.run([sys.executable, "-m", "ledgerlake", *args], cwd=ROOT, capture_output=True,
                          text=True, timeout=600)


def test_cli_runs_and_gates():
    root = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-cli-"), "lake")
    ok = _run("--sf-dir", SF_SMOKE, "--root", root, "--run-date", "2024-01-31",
              "--as-of", "2001-12-31T00:00:00", "--gate", "--master", "local[2]")
    assert ok.returncode == 0, ok.stderr[-2000:]
    result = json.loads(ok.stdout.strip().splitlines()[-1])
    assert result["silver"]["counts"]["transactions"] == 1283
    assert result["quality"]["summary"]["failed"] == 0
    stale = _run("--sf-dir", SF_SMOKE, "--root", root, "--run-date", "2024-01-31",
                 "--as-of", "2003-01-01T00:00:00", "--gate", "--master", "local[2]")
    assert stale.returncode == 2
    assert "Quality checks fallaron: 1/18" in stale.stdout


def test_cli_takes_own_files(spark):
    """Users from Parquet, transactions from JSON lines, details from CSV: the same Silver as from the tables."""
    from ledgerlake.plans import silver
    from ledgerlake.session import scratch_root
    from ledgerlake.sources.fixtures import bronze_sources

    root = scratch_root(spark, "test-cli")
    bronze = bronze_sources(spark, SF_SMOKE)
    ordered = {e: df.orderBy(silver.DEDUPE_KEY[e], *silver.DEDUPE_ORDER[e]).drop("_seq") for e, df in bronze.items()}
    ordered["users"].write.parquet(f"{root}/users")
    ordered["transactions"].write.json(f"{root}/tx")
    ordered["transaction_details"].write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/details")
    out = _run("--source", f"users=parquet:{root}/users", "--source", f"transactions=json:{root}/tx",
               "--source", f"transaction_details=csv:{root}/details", "--root", f"{root}/lake", "--run-date", "2024-01-31",
               "--as-of", "2001-12-31T00:00:00", "--gate", "--master", "local[2]")
    assert out.returncode == 0, out.stderr[-2000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["silver"]["counts"] == {"users": 142, "transactions": 1283, "transaction_details": 3334}
    assert result["silver"]["rejects"]["transactions"]["malformed_record"] == 0


def test_cli_refuses_incomplete_sources():
    for args in (["--root", "/x"], ["--root", "/x", "--source", "users=csv:/a"], ["--root", "/x", "--source", "users=xml:/a"]):
        assert _run(*args).returncode == 2

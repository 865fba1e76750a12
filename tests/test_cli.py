"""The command line runs a registered query into a table."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

from tests.conftest import SF001


def test_cli_query(spark):
    from tidemark.session import ensure_checkpoint_dir
    out = os.path.join(tempfile.mkdtemp(prefix="cli-", dir=ensure_checkpoint_dir(spark)), "ua")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-m", "tidemark", "query", "user_age", "--sf", SF001,
                        "--out", out], cwd=repo, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert spark.read.parquet(out).count() == 150


def test_cli_help_lists_jobs():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-m", "tidemark", "--help"], cwd=repo,
                       capture_output=True, text=True, timeout=60)
    for job in ("log-detail", "unique-visitor", "bounce", "db-detail", "order-wide",
                "raw-log-landing", "query"):
        assert job in r.stdout

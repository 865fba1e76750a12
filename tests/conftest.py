from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session
    s = get_session("local[*]", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the session's shared checkpoint folder."""
    from tidemark.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix="t-", dir=base)

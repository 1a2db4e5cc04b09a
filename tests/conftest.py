from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from txrisk.session import build_session, checkpoint_dir

    s = build_session(
        "local[*]",
        app_name="txrisk-tests",
        shuffle_partitions=8,
        extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    # tests only: a private checkpoint folder when the cluster names none
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="txrisk-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="txrisk-test-")


def rows(df, *cols):
    """Collect a small test frame as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())

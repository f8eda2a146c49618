"""The nearest-row operator from a folder outside the repository, with the package on the driver's path only."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from loanproof.queries import queries
from loanproof.session import build_session
spark = build_session("outside", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
print("ROWS", queries()["near_duplicate_screen"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_find_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]

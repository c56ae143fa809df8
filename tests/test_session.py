"""Session helpers that need a process of their own."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
sys.path.insert(0, {repo!r})
from salesmart.session import build_session
from salesmart.functions.projection import ewkb_position
spark = build_session("local[1]", **{{"spark.ui.enabled": "false"}})
hexes = "0101000000" + "000000000000f83f" + "0000000000000440"
print("GOT", spark.createDataFrame([(hexes,)], "g string").select(ewkb_position("g").alias("p")).first().p.x)
"""


def test_python_stages_run_from_another_working_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "GOT 1.5" in run.stdout, run.stderr[-2000:]

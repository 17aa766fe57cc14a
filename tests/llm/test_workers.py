"""Every operator runs where executors have no copy of the package."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("names", [
    ("op1_suffix_dedup", "op3_packing", "op4_secret_scan", "op5_substring_dedup", "op6_jaccard_join", "op7_decontamination"),
    ("op8_lm_scoring", "op9_quality_resampling", "op10_line_dedup", "op11_spelling_variants", "op12_fill_in_middle", "op13_private_data"),
])
def test_workers_need_no_package_on_their_path(tmp_path, names):
    code = f"""
import sys; sys.path.insert(0, {REPO!r})
from panelkit.session import build_session
spark = build_session("far", "local[4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
import __spark_entry__ as e
for name in {names!r}:
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]

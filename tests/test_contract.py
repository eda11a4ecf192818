"""The contract without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as contract
names = set(contract.queries())
assert set(contract.oracle_sql()) <= names
assert "orders_clean" in names and not any(n.startswith("op1") or n == "pipeline" for n in names)
"""


def test_rest_works_without_the_subpackage(tmp_path):
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "tests")
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    assert not (copy / "zonetide" / "llm").exists()
    for _ in range(2):  # also with the pipeline left behind
        subprocess.run([sys.executable, "-c", CODE], cwd=copy, check=True, timeout=120)
        if os.path.exists(f"{ROOT}/corpus_pipeline.py"):
            shutil.copy(f"{ROOT}/corpus_pipeline.py", copy)

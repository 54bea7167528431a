"""The driver's entry, with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rest_works_without_training_data_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    for present in (True, False):
        if not present:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 50 and not [k for k in q if k.startswith('op') or k == 'pipeline']; assert set(s) <= set(q)"
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr

"""The entry without the training data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_subpackage(tmp_path):
    """On a copy without both folders of it, with and without the pipeline beside them, all other queries are there."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "llm", "__pycache__", ".pytest_cache")])
    code = "import __spark_entry__ as e; from sparkdeck.plans import QUERIES; assert set(e.queries()) == set(QUERIES); print(len(e.oracle_sql()))"
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
        assert done.returncode == 0 and int(done.stdout) > 250, done.stderr
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)

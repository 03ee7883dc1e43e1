"""The driver contract, with the training-data operators and without them."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
LISTED = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in q))"


@pytest.mark.parametrize("left_out", [(), ("yearloom/llm", "tests/llm"), ("yearloom/llm", "tests/llm", "corpus_pipeline.py")])
def test_queries_are_listed(tmp_path, left_out):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for x in left_out:
        path = copy / x
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", LISTED], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    total, of_llm = map(int, out.stdout.split())
    assert total > 100 and (of_llm == 0 if left_out else total >= of_llm)

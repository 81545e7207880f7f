"""The driver's entry, with and without the parts that may be taken away."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_entry_without_training_data(tmp_path, keep_pipeline):
    for name in ("corpusloom", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif keep_pipeline or name != "corpus_pipeline.py":
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert not [k for k in q if k.startswith('op') and k[2].isdigit()] and 'pipeline' not in q; assert set(s) <= set(q) and len(q) > 80; print(len(q))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert run.returncode == 0, run.stderr

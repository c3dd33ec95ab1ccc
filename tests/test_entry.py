"""The driver's entry without the llm subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_imports_without_llm(tmp_path, pipeline):
    shutil.copytree(f"{ROOT}/sealstone", tmp_path / "sealstone", ignore=lambda d, names: {n for n in names if n in ("llm", "__pycache__")})
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    check = "import __spark_entry__ as e; q = e.queries(); assert 'verdict_v2' in q and 'pipeline' not in q and not any(k.startswith('op1') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", check], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})

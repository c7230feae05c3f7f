"""The registry stands without the corpus operators and without the pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SAY = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'pipeline' in q, any(n.startswith('op1_') for n in q))"


@pytest.mark.parametrize("gone", [["lakewright/llm"], ["corpus_pipeline.py"], ["lakewright/llm", "corpus_pipeline.py"]])
def test_registry_without(tmp_path, gone):
    shutil.copytree(ROOT / "lakewright", tmp_path / "lakewright", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    had = (tmp_path / "lakewright/llm").exists()
    for name in gone:
        path = tmp_path / name
        shutil.rmtree(path, ignore_errors=True) if path.is_dir() else path.unlink(missing_ok=True)
    out = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and out[1] == "False"
    assert out[2] == str(had and "lakewright/llm" not in gone)

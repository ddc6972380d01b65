"""The entry points without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("left_out", [["llm"], ["llm", "pipeline"], ["pipeline"]])
def test_entry_imports_without_optional_parts(tmp_path, left_out):
    kept = shutil.ignore_patterns("__pycache__", *(["llm"] if "llm" in left_out else []))
    shutil.copytree(ROOT / "shelfwise", tmp_path / "shelfwise", ignore=kept)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists() and not (name.startswith("corpus") and "pipeline" in left_out):
            shutil.copy(ROOT / name, tmp_path)
    found = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert found.returncode == 0, found.stderr
    names = found.stdout.split()
    assert "stock_alerts" in names and "pipeline" not in names
    assert any(name.startswith("op") and name[2].isdigit() for name in names) == (
        "llm" not in left_out and (ROOT / "shelfwise" / "llm").exists()
    )

"""The library and its entry without the training-data package."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_entry_without_the_package(tmp_path):
    """``corpus_pipeline.py`` may go with the package or stay."""
    for name in ("textgraph", "textgraph_checks"):
        shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    check = "import __spark_entry__ as e, textgraph_checks as c; assert e.queries().keys() == c.QUERIES.keys() and e.oracle_sql() == c.SQL"
    for pipeline in (False, True):
        if pipeline and (REPO / "corpus_pipeline.py").exists():
            shutil.copy(REPO / "corpus_pipeline.py", tmp_path)
        subprocess.run([sys.executable, "-c", check], cwd=tmp_path, check=True)

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) >= 38


@pytest.mark.parametrize("folder", ["operators", "sources", "functions", "plans", "streaming"])
def test_the_library_does_not_import_the_optional_part(folder):
    for path in (ROOT / "tidemark" / folder).glob("*.py"):
        assert "tidemark.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()


def test_entry_without_the_optional_part(tmp_path):
    import shutil

    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'latest_per_key' in q and not any(k.startswith('op') and k[2].isdigit() for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)

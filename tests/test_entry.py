"""The entry module with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def test_flagship(spark):
    assert __spark_entry__.entry(spark).columns == ["r", "c", "d"]


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_it_imports_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT / "nephogrid", tmp_path / "nephogrid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'density' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_them():
    for path in (ROOT / "nephogrid").rglob("*.py"):
        if "llm" not in path.parts:
            assert "nephogrid.llm" not in path.read_text()

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_imports_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(x.startswith('op') for x in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True)


def test_nothing_else_imports_the_training_data_operators():
    for p in (ROOT / "lodestrata").rglob("*.py"):
        if "llm" not in p.parts:
            assert "lodestrata.llm" not in p.read_text(), p

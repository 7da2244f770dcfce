import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_works_without_the_training_data_operators(tmp_path):
    shutil.copytree(f"{HERE}/wardgraph", tmp_path / "wardgraph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{HERE}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"], cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    n, m, pipeline = said.stdout.split()
    assert int(n) >= 138 and int(m) >= 138 and pipeline == "False"


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["cve_id", "cwe", "capec", "techniques", "defend", "owasp"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

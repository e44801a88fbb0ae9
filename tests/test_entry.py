import os
import shutil
import subprocess
import sys

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registry_has_all_parts():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60


def test_entry_gives_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_the_rest_works_without_the_llm_part(tmp_path):
    for name in ("guildbook", "__spark_entry__.py"):
        source = os.path.join(TOP, name)
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "guildbook" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(x.startswith('op1') for x in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)

"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as se


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["word", "block", "n", "postings_text"]
    assert df.count() > 0


def test_queries_and_oracles_line_up():
    qs, orc = se.queries(), se.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 150
    assert all(isinstance(v, str) and v.strip() for v in orc.values())


def test_python_operators_run_outside_the_repo_folder(tmp_path):
    """Workers import the package from the shipped zip, not from the cwd."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "import __spark_entry__ as se\n"
        "print('COUNT', se.queries()['transform_map'](s, '/root/testdata/sf0.001').count())\n"
    ) % repo
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "COUNT 150" in out.stdout, out.stderr[-2000:]

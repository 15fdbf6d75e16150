import __spark_entry__ as entry


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert {r["chip"] for r in rows} == {"kk", "mm", "tt", "nn"}
    assert all(29.4 < r["zp"] < 29.6 for r in rows)


def test_every_check_has_a_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100


def test_catalog_needs_no_session():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = "import __spark_entry__ as e; assert len(e.oracle_sql()) > 100"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0

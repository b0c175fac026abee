"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001
here; the driver runs the same comparison at sf0.01)."""

import pytest

from conftest import SF0001
from netquery.plans.registry import load_all
from oracle_harness import compare, duck

QUERIES, ORACLE = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


# Fits of hundreds of trees or stages take minutes also on sf0.001; tests/run_oracle.py and the driver run them.
LONG_FITS = {"model_extra_trees", "model_lightgbm_like", "model_catboost_like", "model_random_forest", "model_gradient_boosting", "model_adaboost",
             "ensemble_bagging", "ensemble_stacking", "evaluate_many", "detection_run", "regression_forest", "tune_randomized"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - LONG_FITS))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF0001, con)
    assert r["ok"], r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


TIME_SENSITIVE = ["fanout", "user_list", "concurrency", "tick_gaps", "rate_limit", "server_replay", "parse_telemetry",
                  "stream_tick_windows", "stream_sessions", "stream_rate_limit", "stream_log_sink", "densify"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, name, QUERIES[name], ORACLE[name], SF0001, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r


def test_python_workers_import_the_package_from_any_cwd(tmp_path):
    """Run a mapInPandas-backed query through __spark_entry__ from a foreign
    directory with a plain session: the package must reach the workers."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "import __spark_entry__ as E\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "print('ROWS', E.queries()['rate_limit_interval'](s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS " in out.stdout, out.stderr[-2000:]

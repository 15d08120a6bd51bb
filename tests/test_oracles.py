"""Every registered query with a SQL twin against DuckDB; the plans of SQL-expressible queries run no Python."""

import io
from contextlib import redirect_stdout

import __spark_entry__
import pytest
from seriesmill.plans import fixtures as X
from seriesmill.plans import registry

from .oracle import SF, both


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_oracle(spark, name):
    mine, theirs = both(spark, registry.QUERIES[name], registry.ORACLE_SQL[name])
    assert mine == theirs and mine


def test_queries_have_every_series(spark):
    everyone = {r.product for r in X.panel(spark, SF).select("product").distinct().collect()}
    assert {p[0] for p in everyone} == {"P", "S", "E"}
    for name in ("ewma_crossover", "ewma_ratios", "seasonal_smoothing", "next_month_forecast", "unpivot_days"):
        assert {r.product for r in registry.QUERIES[name](spark, SF).select("product").distinct().collect()} == everyone, name


@pytest.mark.parametrize("name", ["base_features", "ewma_recursive", "impute_linear", "quality_report", "intervals_quantile", "croston"])
def test_no_python_in_plans(spark, name):
    text = io.StringIO()
    with redirect_stdout(text):
        registry.QUERIES[name](spark, SF).explain()
    assert not any(x in text.getvalue() for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


@pytest.mark.parametrize("name", ["complete_months", "trend_features", "detrended", "lifecycle", "class_statistics_as_of", "interaction_all", "ewma_recursive"])
def test_series_are_shuffled_once(spark, name):
    text = io.StringIO()
    with redirect_stdout(text):
        registry.QUERIES[name](spark, SF).explain()
    assert text.getvalue().count("Exchange hashpartitioning(product#") == 1


def test_filters_and_columns_reach_the_scan(spark):
    text = io.StringIO()
    with redirect_stdout(text):
        registry.QUERIES["clean_rollup"](spark, SF).explain("formatted")
    assert "Not(EqualTo(l_returnflag,R))" in text.getvalue() and "l_tax" not in text.getvalue()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_library_does_not_need_the_llm_subpackage():
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__spark_entry__.__file__).parent
    code = "import sys; sys.modules.update({'seriesmill.llm': None, 'corpus_pipeline': None}); import __spark_entry__ as e; assert len(e.queries()) > 90 and 'pipeline' not in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
    own = [p for p in (root / "seriesmill").rglob("*.py") if "llm" not in p.parts]
    assert not any("llm" in p.read_text() for p in own)

import os
import subprocess
import sys

import compare
import pytest

import __spark_entry__ as entry
from contrail.config import Settings
from contrail.plans import fixtures, oracle, pipeline, registry
from contrail.session import checkpoint_folder, cut_lineage
from contrail.sources import tables


@pytest.fixture(scope="module")
def duck(small):
    con = compare.connect(small)
    yield con
    con.close()


FAST = ("stg_flights", "flights_enriched", "range_classify_bucketed", "military_flights",
        "airport_connections", "route_performance", "airport_network", "daily_counts",
        "military_activity", "anomaly_scores", "dedup_pulls", "state_vectors", "missing_slices",
        "load_flights", "pagerank", "betweenness")


@pytest.mark.parametrize("name", FAST)
def test_query_equals_its_sql(spark, duck, small, name):
    rows, *_, problems = compare.compare(spark, duck, small, name, entry.oracle_sql()[name])
    assert not problems and rows > 0


def test_every_query_has_sql_and_the_entry_runs(spark):
    # the training-data queries have SQL where SQL can express them, and their own tests
    assert set(registry.queries()) == set(oracle.oracle_sql()) and len(oracle.oracle_sql()) > 50
    assert set(entry.queries()) >= set(entry.oracle_sql()) >= set(registry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("package", ["xxhash", "contrail.llm"])
def test_the_entry_does_without_what_only_the_optional_part_needs(package):
    code = (f"import sys; sys.modules[{package!r}] = None; import __spark_entry__ as e; "
            "assert not e.HAS_LLM and 'route_performance' in e.queries(); "
            "assert set(e.oracle_sql()) == set(e.queries())")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_pipeline_refreshes_marts_and_reports(spark, small):
    inputs = (fixtures.raw_flights(spark, small), fixtures.airport_metadata(spark, small),
              fixtures.military_ranges(spark))
    result = pipeline.run_pipeline(spark, *inputs, Settings(marts_schema="marts_run"))
    assert set(tables.list_tables(spark, "marts_run")) >= set(pipeline.MARTS)
    assert all(tables.table_exists(spark, view) for view in pipeline.VIEWS)
    checks = {r["check"]: r["failures"] for r in result.checks.collect()}
    assert len(checks) == 36
    assert checks["unique:airport_graph.hub_rank"] == 0
    assert checks["max_value:flights_enriched.flight_duration_min"] > 0
    assert "alert_line" in result.alerts.columns
    # the models of a run without any flight keep their columns
    empty = pipeline.build_tables(pipeline.flight_models(inputs[0].limit(0), *inputs[1:]))
    for name in ("anomaly_scores", "airport_graph"):
        assert empty[name].columns == result.tables[name].columns
        assert empty[name].isEmpty()


def test_cut_lineage_uses_the_named_folder(spark):
    folder = checkpoint_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = cut_lineage(spark.range(10).withColumnRenamed("id", "n"))
    assert all(folder in f for f in df.inputFiles()) and df.count() == 10

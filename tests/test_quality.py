import pytest

from contrail.operators import quality
from contrail.operators.quality import Check
from contrail.plans import fixtures, pipeline
from contrail.session import checkpoint_folder, cut_lineage


def test_single_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "X"), ("a", -1.0, "X"), ("b", 1441.0, "Y"), (None, None, None),
         (None, 5.0, "Z"), ("c", 1440.0, "Z")], "k string, v double, c string")
    assert [r["k"] for r in quality.unique(df, "k").collect()] == ["a"]
    assert quality.not_null(df, "k").count() == 2
    # bounds are inclusive and null is not a failure
    assert quality.accepted_range(df, "v", 0, 1440).count() == 2
    assert quality.accepted_range(df, "v", low=1).count() == 1
    assert quality.accepted_range(df, "v").count() == 0
    assert {r["c"]: r["n_records"] for r in quality.accepted_values(df, "c", ["X"]).collect()} \
        == {"Y": 1, "Z": 2}
    assert quality.no_negative(df, "v").count() == 1
    assert quality.max_value(df, "v").count() == 1


@pytest.mark.parametrize("flags,failing", [([True] + [False] * 4, 0), ([True] * 2 + [False] * 7, 1)])
def test_military_share(spark, flags, failing):
    df = spark.createDataFrame([(f,) for f in flags], "is_military boolean")
    assert quality.max_ratio(df).count() == failing
    check = Check("m", "is_military", "max_ratio", {"limit": 20.0})
    assert quality.run_suite({"m": df}, [check]).first()["failures"] == failing


def test_suite_agrees_with_the_single_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "X", True), ("a", -1.0, "X", False), (None, 1441.0, "Y", False),
         ("c", None, "Z", False)], "k string, v double, c string, f boolean")
    suite = [Check("m", "k", "unique"), Check("m", "k", "not_null"),
             Check("m", "v", "accepted_range", {"low": 0, "high": 1440}),
             Check("m", "c", "accepted_values", {"values": ("X",)}),
             Check("m", "v", "no_negative"), Check("m", "v", "max_value", {"limit": 1440})]
    report = {(r["column"], r["check"].split(":")[0]): (r["failures"], r["passed"])
              for r in quality.run_suite({"m": df}, suite).collect()}
    assert report == {
        ("k", "unique"): (1, False), ("k", "not_null"): (1, False),
        ("v", "accepted_range"): (2, False), ("c", "accepted_values"): (2, False),
        ("v", "no_negative"): (1, False), ("v", "max_value"): (1, False)}


def test_suite_on_empty_input(spark):
    df = spark.createDataFrame([], "is_military boolean, k string, d date")
    suite = [Check("m", "is_military", "max_ratio", {"limit": 20.0}), Check("m", "k", "unique"),
             Check("m", "d", "not_null")]
    assert all(r["passed"] and r["failures"] == 0
               for r in quality.run_suite({"m": df}, suite).collect())


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        quality.run_suite({"m": spark.range(1)}, [Check("m", "id", "nonsense")])


def test_suite_holds_all_declared_checks():
    kinds = [c.kind for c in quality.SUITE]
    assert len(kinds) == 36
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 21, "unique": 5, "accepted_range": 5, "accepted_values": 2,
        "no_negative": 1, "max_value": 1, "max_ratio": 1}


def test_watched_writes_report_what_the_suite_finds(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "X", True), ("a", -1.0, "X", False), (None, 1441.0, "Y", True),
         ("c", None, "Z", False), ("d", 3.0, "Z", False)], "k string, v double, c string, f boolean")
    suite = [Check("m", "k", "unique"), Check("m", "k", "not_null"), Check("m", "v", "no_negative"),
             Check("m", "v", "accepted_range", {"low": 0, "high": 1440}), Check("m", "f", "max_ratio", {"limit": 20.0}),
             Check("m", "c", "accepted_values", {"values": ("X",)}), Check("other", "k", "not_null"),
             Check("none", "k", "not_null"), Check("none", "c", "accepted_values", {"values": ("X",)})]
    for rows in (df, df.where("f and c = 'X'")):
        models = {"m": rows, "other": df, "none": df.limit(0)}
        watch = quality.Watch(suite)
        written = {name: cut_lineage(watch.add(name, models[name])) for name in ("m", "none")}
        got = watch.report({**written, "other": df}).collect()
        assert sorted(got) == sorted(quality.run_suite(models, suite).collect())


def test_a_watched_run_reads_the_raw_flights_once(spark, small):
    raw = cut_lineage(fixtures.raw_flights(spark, small))
    seeds = fixtures.airport_metadata(spark, small), fixtures.military_ranges(spark)
    lazy = pipeline.build_tables(pipeline.flight_models(raw, *seeds))
    watch = quality.Watch()
    built = pipeline.build_tables(pipeline.flight_models(raw, *seeds, watch), watch=watch)
    report = watch.report(built)
    # what the checks still read after the writes: staged tables, neither raw rows nor a seed's join
    assert not set(report.inputFiles()) & set(raw.inputFiles())
    for name in ("stg_flights", "stg_airports", "flights_enriched", "airport_network"):
        assert all(checkpoint_folder(spark) in f for f in built[name].inputFiles())
    assert sorted(report.collect()) == sorted(quality.run_suite(lazy).collect())
    for name in pipeline.VIEWS:
        assert built[name].columns == lazy[name].columns and built[name].count() == lazy[name].count()


def test_enriched_checks_count_what_a_repeated_airport_multiplies(spark, small):
    # two rows of one id for an airport: its flights are enriched twice, and count twice
    seed = fixtures.airport_metadata(spark, small)
    twice = seed.unionByName(seed.where("airport_id = ' n001'"))
    raw, ranges = fixtures.raw_flights(spark, small), fixtures.military_ranges(spark)
    checks = [c for c in quality.SUITE if c.model in ("stg_flights", "stg_airports", "flights_enriched")]
    watch = quality.Watch(checks)
    built = pipeline.build_tables(pipeline.flight_models(raw, twice, ranges, watch), watch=watch)
    got = {r["check"]: r["failures"] for r in watch.report(built).collect()}
    plain = quality.run_suite(vars(pipeline.flight_models(raw, twice, ranges)), checks)
    assert got == {r["check"]: r["failures"] for r in plain.collect()}
    assert got["unique:stg_airports.airport_id"] == 1 and got["max_value:flights_enriched.flight_duration_min"] > 0


def test_lines_are_dealt_by_order_at_any_size(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixtures.raw_flights(spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "RoundRobin" not in plan and plan.count("hashpartitioning(l_orderkey") == 1

"""Promotion gate, aliases, tags, versions (REG-1..REG-8, ORD-2..4, JOI-3/4, SCL-8)."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from framelake.operators import registry
from framelake.schemas import METRIC_NAME_MAP

RUNS = "name string, run_id long, status string, start_time timestamp, params map<string,string>, tags map<string,string>, metrics map<string,double>"


def _runs(spark, rows):
    t = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(n, r, s, t, {}, {"k": "v"}, ({} if m is None else {"mAP50": m})) for n, r, s, m in rows], RUNS
    )


def _versions(spark, rows):
    return spark.createDataFrame(rows, "name string, run_id long, version string")


def _aliases(spark, rows):
    return spark.createDataFrame(rows, "name string, alias string, version string")


def _decide(spark, runs, versions, aliases, gain=1.02):
    return {r["name"]: r for r in registry.promotion(_runs(spark, runs), _versions(spark, versions), _aliases(spark, aliases), min_gain=gain).collect()}


def test_first_deploy_and_gate_strictness(spark):
    runs = [("a", 1, "FINISHED", 0.5), ("a", 2, "FINISHED", 0.4), ("b", 3, "FINISHED", 0.51), ("b", 4, "FINISHED", 0.5)]
    versions = [("a", 1, "1"), ("a", 2, "2"), ("b", 3, "1"), ("b", 4, "2")]
    # b: champion is run 4 (0.5); 0.51 > 0.5 * 1.02 is false (equal is not enough)
    d = _decide(spark, runs, versions, [("b", "champion", "2")])
    assert d["a"]["decision"] == "promoted" and d["a"]["reason"] == "first_deploy_no_champion"
    assert d["a"]["challenger_version"] == "2"
    assert d["b"]["decision"] == "kept_champion"
    assert d["b"]["reason"] == "mAP50 0.51000 did not beat champion 0.50000 * 1.02 (0.51000)"
    assert d["b"]["challenger_version"] == "2" and d["b"]["challenger_is_champion"] is True
    d = _decide(spark, runs, versions, [("b", "champion", "2")], gain=1.01)
    assert d["b"]["decision"] == "promoted" and d["b"]["reason"].startswith("mAP50 0.51000 > champion 0.50000 * 1.01")


def test_champion_without_metric_promotes_unconditionally(spark):
    runs = [("a", 1, "FINISHED", 0.1), ("a", 2, "FINISHED", None)]
    d = _decide(spark, runs, [("a", 1, "1"), ("a", 2, "2")], [("a", "champion", "2")])
    assert d["a"]["promote"] and d["a"]["reason"] == "first_deploy_no_champion"


def test_error_statuses(spark):
    runs = [("a", 1, "RUNNING", 0.9), ("b", 2, "FINISHED", None), ("c", 3, "FINISHED", 0.3)]
    d = _decide(spark, runs, [("b", 2, "1")], [])
    assert d["a"]["status"] == "error_no_runs" and d["a"]["decision"] is None
    assert d["b"]["status"] == "error_no_metric"
    assert d["c"]["status"] == "error_no_version" and d["c"]["best_run_id"] == 3


def test_ties_and_nulls_order_and_integer_versions(spark):
    runs = [("a", 5, "FINISHED", 0.7), ("a", 3, "FINISHED", 0.7), ("a", 1, "FINISHED", None)]
    versions = [("a", 3, "9"), ("a", 3, "10"), ("a", 5, "11"), ("a", 1, "2")]
    d = _decide(spark, runs, versions, [])
    assert d["a"]["best_run_id"] == 3 and d["a"]["best_version"] == "10"
    assert d["a"]["challenger_version"] == "11"
    ranked = registry.rank_runs(_runs(spark, runs)).orderBy("rank").collect()
    assert [r["run_id"] for r in ranked] == [3, 5, 1]


def test_no_second_version_leaves_alias(spark):
    runs = [("a", 1, "FINISHED", 0.9), ("a", 2, "FINISHED", 0.1)]
    aliases = _aliases(spark, [("a", "challenger", "old")])
    dec = registry.promotion(_runs(spark, runs), _versions(spark, [("a", 1, "1")]), aliases)
    moved = sorted(tuple(r) for r in registry.move_aliases(aliases, dec).collect())
    assert moved == [("a", "challenger", "old"), ("a", "champion", "1")]


def test_decision_tag_replaces_old_tag(spark):
    runs = _runs(spark, [("a", 1, "FINISHED", 0.9)]).withColumn(
        "tags", F.create_map(F.lit("promotion_decision"), F.lit("old"), F.lit("k"), F.lit("v")))
    dec = registry.promotion(runs, _versions(spark, [("a", 1, "1")]), _aliases(spark, []))
    tags = registry.decision_tags(runs, dec).first()["tags"]
    assert tags == {"k": "v", "promotion_decision": "promoted"}


def test_clean_metrics_renames_and_skips(spark):
    df = spark.createDataFrame([({"metrics/mAP50(B)": "0.5", "metrics/recall(B)": "n/a", "fitness": "1", "metrics/precision(B)": "1e-3"},)],
                               "r map<string,string>")
    m = df.select(registry.clean_metrics("r", METRIC_NAME_MAP).alias("m")).first()["m"]
    assert m == {"mAP50": 0.5, "precision": 0.001}


def test_register_versions_and_latest_run(spark):
    versions = _versions(spark, [("a", 1, "9"), ("a", 2, "10")])
    new = spark.createDataFrame([("a", 7), ("a", 5), ("b", 1)], "name string, run_id long")
    got = sorted(tuple(r) for r in registry.register_versions(versions, new).collect())
    assert got == [("a", 5, "11"), ("a", 7, "12"), ("b", 1, "1")]
    runs = _runs(spark, [("a", 1, "FINISHED", 0.1), ("a", 2, "FINISHED", 0.2)]).withColumn(
        "start_time", F.when(F.col("run_id") == 2, F.lit(datetime(2025, 1, 1))).otherwise(F.col("start_time")))
    assert registry.latest_run(runs).first()["run_id"] == 2
    logged = registry.log_runs(runs, _runs(spark, [("a", 2, "FAILED", None)]))
    assert sorted((r["run_id"], r["status"]) for r in logged.collect()) == [(1, "FINISHED"), (2, "FAILED")]


def test_nan_metric_counts_as_not_logged(spark):
    from datetime import datetime

    t = datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("m", 1, "FINISHED", t, {}, {"mAP50": float("nan")}), ("m", 2, "FINISHED", t, {}, {"mAP50": 0.4})],
        "name string, run_id long, status string, start_time timestamp, tags map<string,string>, metrics map<string,double>")
    ranks = {r["run_id"]: r["rank"] for r in registry.rank_runs(runs).collect()}
    versions = spark.createDataFrame([("m", 1, "1"), ("m", 2, "2")], "name string, run_id long, version string")
    aliases = spark.createDataFrame([], "name string, alias string, version string")
    p = registry.promotion(runs, versions, aliases).first()
    assert ranks == {2: 1, 1: 2} and p["best_run_id"] == 2 and p["challenger_version"] == "1"


def test_version_of_two_runs_takes_the_smallest_run(spark):
    from datetime import datetime

    t = datetime(2024, 1, 1)
    runs = spark.createDataFrame([("m", i, "FINISHED", t, {}, {"mAP50": i / 10}) for i in (1, 2, 3)],
                                 "name string, run_id long, status string, start_time timestamp, tags map<string,string>, metrics map<string,double>")
    versions = spark.createDataFrame([("m", 3, "5"), ("m", 2, "5")], "name string, run_id long, version string")
    aliases = spark.createDataFrame([("m", "champion", "5")], "name string, alias string, version string")
    assert registry.champion_metric(runs, versions, aliases).first()["champion_run_id"] == 2


def test_unfinished_runs_are_no_challengers(spark):
    runs = [("a", 1, "FINISHED", 0.9), ("a", 2, "RUNNING", 0.8), ("a", 3, "FINISHED", None)]
    d = _decide(spark, runs, [("a", 1, "1"), ("a", 2, "2"), ("a", 3, "3"), ("a", 9, "4")], [("a", "champion", "4"), ("z", "champion", "1")])
    assert set(d) == {"a"} and d["a"]["challenger_version"] == "3"
    assert d["a"]["champion_version"] == "4" and d["a"]["champion_metric"] is None  # its run is not in the table
    d = _decide(spark, runs[:2], [("a", 1, "1"), ("a", 2, "2")], [("a", "champion", "77")])
    assert d["a"]["challenger_version"] is None and d["a"]["champion_version"] == "77" and d["a"]["reason"] == "first_deploy_no_champion"


def test_candidates_by_experiment(spark):
    """Runs are chosen by experiment, not by the name they were logged under; the champion's run may be elsewhere."""
    runs = _runs(spark, [("x", 1, "FINISHED", 0.5), ("y", 2, "FINISHED", 0.7), ("y", 3, "FINISHED", 0.6), ("m", 4, "FINISHED", 0.9)])
    runs = runs.withColumn("experiment", F.when(F.col("run_id") < 4, "e1").otherwise("e2"))
    versions = _versions(spark, [("m", 2, "10"), ("m", 1, "9"), ("m", 4, "11"), ("n", 3, "1")])
    aliases = _aliases(spark, [("m", "champion", "11")])
    scopes = spark.createDataFrame([("m", "e1"), ("n", "e1"), ("o", "e9"), ("m", "e1")], "name string, experiment string")
    d = {r["name"]: r for r in registry.promotion(runs, versions, aliases, scopes=scopes).collect()}
    assert (d["m"]["best_run_id"], d["m"]["best_version"], d["m"]["challenger_version"]) == (2, "10", "9")
    assert d["m"]["champion_metric"] == 0.9 and d["m"]["decision"] == "kept_champion"
    assert d["n"]["status"] == "error_no_version" and d["n"]["best_run_id"] == 2 and d["o"]["status"] == "error_no_runs"
    assert len(d) == 3
    assert [r["run_id"] for r in registry.decision_tags(runs, registry.promotion(runs, versions, aliases, scopes=scopes)).collect()] == [2]


def test_candidates_of_an_experiment_are_not_copied_to_each_model(spark):
    """Same decisions as with every candidate of every model, which is what the table grouped by model held before."""
    rng = random.Random(4)
    exps = ["e1", "e2", "e3", None]
    runs = [(rng.choice([*range(40), None]), rng.choice(exps), rng.choice(["FINISHED", "FAILED", None]), rng.choice([{}, {"mAP50": rng.random()}, {"mAP50": float("nan")}, None]))
            for _ in range(150)]
    runs = spark.createDataFrame([("logged", *r) for r in runs], "name string, run_id long, experiment string, status string, metrics map<string,double>")
    names = [f"m{i}" for i in range(30)]
    versions = [(rng.choice([*names, "x", None]), rng.choice([*range(50), None]), str(v)) for v in range(700)]
    aliases = spark.createDataFrame([(n, "champion", rng.choice([v for m, _, v in versions if m == n] or ["9999"])) for n in names[::2]], "name string, alias string, version string")
    versions = spark.createDataFrame(versions, "name string, run_id long, version string")
    scopes = spark.createDataFrame([(n, rng.choice([*exps, "e9"])) for n in [*names, None] * 2], "name string, experiment string")
    got = sorted(repr(r) for r in registry.promotion(runs, versions, aliases, scopes=scopes).collect())
    tagged = registry._tagged(runs, versions, aliases, "mAP50", scopes)
    assert tagged.where("finished is not null").count() < registry.candidates(runs, scopes).where("status is not null").count() / 3

    def every_candidate(runs, versions, scopes, metric):
        c = registry.candidates(runs, scopes).select("name", "run_id", (F.col("status") == "FINISHED").alias("finished"), registry.get_metric("metrics", metric).alias("metric"))
        return versions.withColumn("version", F.col("version").cast("long")).unionByName(c, allowMissingColumns=True)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(registry, "_contenders", every_candidate)
        want = registry.promotion(runs, versions, aliases, scopes=scopes).collect()
    assert got == sorted(repr(r) for r in want) and {r["status"] for r in want} > {"ok"}
    assert registry.promotion(runs, versions, aliases, scopes=scopes.where("experiment = 'none'")).count() == 0

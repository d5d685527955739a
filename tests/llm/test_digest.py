import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.llm import digest as dg


def true_error(values, estimate, q):
    v = np.sort(values)
    t = q * (len(v) - 1)
    return max(0.0, np.searchsorted(v, estimate, "left") - 1 - t, t - np.searchsorted(v, estimate, "right")) / len(v)


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 20000), st.integers(0, 5), st.integers(1, 9))
def test_merged_digests_keep_the_bound(n, kind, parts):
    rng = np.random.default_rng(n)
    v = [rng.lognormal(3, 2, n), rng.random(n), np.round(rng.random(n) * 3), np.full(n, 7.0), rng.standard_cauchy(n), np.where(rng.random(n) < 0.4, 900000.0, rng.random(n))][kind]
    pieces = [dg.recluster(np.zeros(len(x), dtype=np.int64), x, np.ones(len(x))) for x in np.array_split(v, parts)]
    g, m, w = dg.recluster(*(np.concatenate(c) for c in zip(*pieces, strict=True)))
    assert w.sum() == n
    got = dg.quantiles(g, m, w, 1, dg.QUANTILES)[0]
    for q, x in zip(dg.QUANTILES, got, strict=True):
        assert true_error(v, x, q) <= dg.BOUND
    if n <= 200:
        np.testing.assert_allclose(got, np.quantile(v, dg.QUANTILES), rtol=1e-9, atol=1e-12)


SCHEMA = "result_id long, run_id string, replay_round int, line_number long, status_code int, latency_ms double, model string, sent_at timestamp, recorded_at timestamp, grouping string, n int, part string, r int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "g", 1, "p", 2) for r in rows], SCHEMA)


def test_results(spark):
    t = dt.datetime(2025, 3, 1, 12)
    late = t + dt.timedelta(days=2)
    rows = [(i, "hot", 0, i, 200, float(i), "m", t, t) for i in range(3000)]
    rows += [(5, "hot", 0, 5, 200, 5.0, "m", t, late), (5, "hot", 0, 5, 200, 5.0, "m", t, late), (9001, "one", 0, 1, None, 0.0, None, t, t), (9002, "none", 0, 1, 500, None, "m", t, t), (9003, None, None, None, None, 1.5, None, None, None), (9004, "nan", 0, 1, 200, float("nan"), "m", t, t)]
    got = {(r["grouping"], r["run_id"], r["model"], r["status_code"]): r for r in dg.latency_percentiles(frame(spark, rows)).collect() if r["grouping"] != "run_day"}
    hot = got[("run", "hot", None, None)]
    assert hot["n"] == 3000 and abs(hot["p50"] - 1499.5) < 15 and hot["err50"] <= dg.BOUND and hot["err99"] <= dg.BOUND
    assert got[("run", "one", None, None)]["p99"] == 0.0
    assert got[("run", "none", None, None)]["n"] == 0 and got[("run", "none", None, None)]["p50"] is None and got[("run", "none", None, None)]["n_null"] == 1
    assert got[("run", "nan", None, None)]["n_null"] == 1
    assert got[("run", None, None, None)]["p50"] == 1.5
    assert got[("model_status", None, None, None)]["n"] == 2
    assert dg.latency_percentiles(frame(spark, rows).limit(0)).count() == 0


def test_partitions_do_not_matter(spark):
    t = dt.datetime(2025, 3, 1)
    rows = [(i, f"r{i % 3}", 0, i * 37, 200, float((i * 7919) % 1000), "m", t, t) for i in range(2000)]
    a = dg.latency_percentiles(frame(spark, rows)).where("grouping = 'run'")
    b = dg.latency_percentiles(frame(spark, rows).repartition(7)).where("grouping = 'run'")
    x, y = ({r["run_id"]: (r["n"], r["err50"] <= dg.BOUND, r["err95"] <= dg.BOUND) for r in z.collect()} for z in (a, b))
    assert x == y and len(x) == 3


def test_reports(spark):
    d = dt.date(2025, 3, 1)
    t = dt.datetime(2025, 3, 2)
    rows = [(1, "a", d, 0, 3, {"200": 3}, [1.0, 2.0, 3.0], t), (1, "a", d, 0, 3, {"200": 3}, [1.0, 2.0, 3.0], t), (2, "a", d, 1, 2, {"200": 1, "None": 1}, [10.0], t), (3, "b", d, 0, 0, None, None, t), (4, "c", None, 0, 1, {"200": None}, [], None)]
    df = spark.createDataFrame(rows, "stats_id long, run_id string, replay_day date, worker int, completed long, status_counts map<string,long>, latencies_ms array<double>, reported_at timestamp")
    got = {(r["grouping"], r["run_id"]): r for r in dg.report_percentiles(df).collect()}
    a = got[("run", "a")]
    assert (a["n"], a["results"], a["p50"]) == (4, 5, 2.5) and a["err50"] == 0
    assert got[("run", "b")]["n"] == 0 and got[("run", "b")]["p50"] is None and got[("run_day", "c")]["results"] == 0
    assert dg.report_percentiles(df.limit(0)).count() == 0


def test_combination_equals_direct(spark):
    """Digests of days, merged, answer as digests of all rows."""
    df = spark.range(5000).select((F.col("id") % 5).cast("string").alias("run_id"), F.to_date(F.lit("2025-03-01")).alias("replay_day"), ((F.col("id") * 7919) % 5000).cast("double").alias("v"))
    got = {r["run_id"]: r["p95"] for r in dg.merge(dg.digests(df.repartition(6), {"run": ["run_id"]}, "v"), ["run_id"]).collect()}
    for k in range(5):
        v = np.array([(i * 7919) % 5000 for i in range(k, 5000, 5)], dtype=float)
        assert true_error(v, got[str(k)], 0.95) <= dg.BOUND


def test_merging_in_two_levels(spark):
    df = spark.range(8000).select((F.col("id") % 2).cast("string").alias("run_id"), F.when(F.col("id") % 9 > 0, F.col("id").cast("double")).alias("v"))
    parts = dg.digests(df.repartition(12), {"run": ["run_id"]}, "v")
    one, two = ({r["run_id"]: r for r in dg.merge(parts, ["run_id"], fan_in=k).collect()} for k in (256, 2))
    for k in ("0", "1"):
        v = np.array([i for i in range(8000) if i % 2 == int(k) and i % 9], dtype=float)
        assert (one[k]["n"], one[k]["n_null"]) == (two[k]["n"], two[k]["n_null"]) == (len(v), 4000 - len(v))
        assert true_error(v, two[k]["p95"], 0.95) <= dg.BOUND


def test_many_groups_are_clustered_seldom(monkeypatch):
    calls = []
    real = dg.recluster
    monkeypatch.setattr(dg, "recluster", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(dg, "_COMPACT", 100)
    own = dg._Groups(dg.DELTA)
    for i in range(200):
        own.add(np.arange(50) + 50 * i, np.ones(50), np.ones(50))
    assert len(own.done()[0]) == 10000 and len(calls) < 15


def test_estimates_against_sorted_values(spark):
    t = dt.datetime(2025, 3, 1)
    rng = np.random.default_rng(4)
    v = {f"r{k}": rng.lognormal(2, 1.5, 4000) for k in range(3)}
    rows = [(i, r, 0, i, 200, float(x), "m", t, t) for r, xs in v.items() for i, x in enumerate(xs)]
    for r in dg.latency_percentiles(frame(spark, rows)).where("grouping = 'run'").collect():
        for q, name in zip(dg.QUANTILES, ("50", "95", "99"), strict=True):
            low, high = np.quantile(v[r["run_id"]], [max(0, q - dg.BOUND), min(1, q + dg.BOUND)])
            assert low <= r[f"p{name}"] <= high
            assert abs(true_error(v[r["run_id"]], r[f"p{name}"], q) - r[f"err{name}"]) < 1e-9

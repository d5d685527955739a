"""Scans, sources, stores, rewards and layouts against serial forms and small cases."""

import math
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillspark.functions import masks as mk
from quillspark.functions import rewards as rw
from quillspark.functions import scoring as sc
from quillspark.functions.scans import reverse_scan, reverse_scan_flat
from quillspark.operators import balance as bl
from quillspark.operators import groups as gp
from quillspark.operators import ordering as od
from quillspark.operators import retrieval as rt
from quillspark.operators import trace as tr
from quillspark.operators.recorder import Recorder
from quillspark.sources import configs, readers
from quillspark.sources.cursor import PromptSource, State
from quillspark.streaming.health import Monitor, health_events
from quillspark.streaming.store import GroupStore, collect_and_recycle, poll


def serial(x, offsets, decay):
    y = np.array(x, dtype=float)
    for a, b in zip(offsets, offsets[1:], strict=False):
        for t in range(b - 2, a - 1, -1):
            y[t] += decay * y[t + 1]
    return y


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=12), st.integers(1, 9), st.floats(0, 1))
def test_chunked_scan(lengths, chunk, decay):
    offsets = np.r_[0, np.cumsum(lengths)].astype(int)
    x = np.random.default_rng(1).normal(size=offsets[-1])
    np.testing.assert_allclose(reverse_scan_flat(x, offsets, decay, chunk), serial(x, offsets, decay), atol=1e-9)


@pytest.mark.parametrize(("rows", "width", "chunk"), [(16, 4096, 64), (32, 8192, 128), (1, 131072, 256)])
def test_scan_of_long_sequences(rows, width, chunk):
    rng = np.random.default_rng(0)
    r, v = rng.normal(size=(rows, width)), rng.normal(size=(rows, width))
    delta = r + 0.99 * np.c_[v[:, 1:], np.zeros(rows)] - v
    offsets = np.arange(rows + 1) * width
    got = reverse_scan_flat(delta.ravel(), offsets, 0.99 * 0.95, chunk)
    np.testing.assert_allclose(got, serial(delta.ravel(), offsets, 0.99 * 0.95), atol=1e-5)


def test_scan_is_linear():
    def seconds(n):
        x = np.ones(n)
        best = math.inf
        for _ in range(3):
            t = time.perf_counter()
            reverse_scan_flat(x, np.array([0, n]), 0.9)
            best = min(best, time.perf_counter() - t)
        return best

    seconds(1000)
    assert seconds(1_600_000) < 24 * max(seconds(200_000), 1e-3)  # eightfold work


def test_scan_column(spark):
    df = spark.createDataFrame([([1.0, 1.0, 1.0],), ([],), (None,), ([2.0],)], "x array<double>")
    assert [r[0] for r in df.select(reverse_scan(F.col("x"), 0.5, 2)).collect()] == [[1.75, 1.5, 1.0], [], None, [2.0]]


def test_lags_sums_and_percentiles_of_hot_groups(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"), F.col("id").alias("k"), (F.col("id") * 37 % 101).cast("double").alias("v"), F.lit(1).alias("row"))
    df = df.unionByName(spark.createDataFrame([(None, 9001, 2.0, 1), (None, 9002, None, 1), ("empty", 9003, None, 1)], "g string, k long, v double, row int"))
    p = df.toPandas().sort_values("k")
    got = od.previous(df, "g", ["k"], "v", "before").toPandas().sort_values("k")
    want = p.groupby("g", dropna=False)["v"].shift(1)
    assert got.set_index("k")["before"].fillna(-1).sort_index().tolist() == want.fillna(-1).set_axis(p["k"]).sort_index().tolist()
    got = od.running_sum(df, "g", ["k"], "v", "s").toPandas().set_index("k")["s"].fillna(0)
    want = p.assign(v=p["v"].fillna(0)).groupby("g", dropna=False)["v"].cumsum() - p["v"].fillna(0)
    np.testing.assert_allclose(got.sort_index().to_numpy(), want.set_axis(p["k"]).sort_index().to_numpy())
    got = {r["g"]: r for r in od.exact_percentiles(df, "g", "v", {"p50": 0.5, "p99": 0.99}).collect()}
    for g, own in p.groupby("g", dropna=False):
        v = own["v"].dropna()
        r = got[None if g != g else g]
        if len(v):
            assert r["p50"] == pytest.approx(np.quantile(v, 0.5)) and r["p99"] == pytest.approx(np.quantile(v, 0.99))
        else:
            assert r["p50"] is None


def test_open_spans_under_many_open_ones(spark):
    n = 150  # a closed root, and open spans nested below it
    rows = [("t", k, 10 * k, "span_start", f"s{k}", f"i{k}", f"i{k - 1}" if k else None) for k in range(n)] + [("t", n, 5000, "span_end", "s0", "i0", None), ("t", n + 1, 9000, "event", "e", None, None)]
    rows += [("c", 0, 0, "span_start", "a", "x", "y"), ("c", 1, 5, "span_start", "b", "y", "x"), ("c", 2, 50, "event", "e", None, None)]
    ev = spark.createDataFrame(rows, "trace string, ord long, ts long, type string, name string, span_id string, parent_id string")
    got = {(r["trace"], r["span_id"]): r for r in tr.close_open(tr.pair_spans(ev)).collect()}
    assert got[("t", f"i{n - 1}")]["shown_end"] == 5000 and got[("t", f"i{n - 1}")]["clipped_by"] == "ancestor_end"
    assert got[("c", "x")]["shown_end"] == 50 and len(got) == n + 1


def test_bottlenecks(spark):
    rows = [("r", f"tiny{i}", "Other Compute", 2) for i in range(6)] + [("r", "topk", "TopK / MoE Routing", 5), ("r", "cudaGraphLaunch", "Other Compute", 5000), ("r", "aten::copy_", "Memory Ops", 100_001), ("q", "gemm", "x", 100), ("q", "cudaGraphLaunch", "x", 4999)]
    k = spark.createDataFrame(rows, "rank string, name string, label string, dur long")
    util = spark.createDataFrame([("r", 79.0), ("q", 95.0)], "rank string, util double")
    got = {(r["rank"], r["issue"], r["severity"]) for r in tr.bottlenecks(k, util, "rank").collect()}
    assert got == {("r", "utilization", "high"), ("r", "launch_stalls", "high"), ("r", "routing", "medium"), ("r", "copies", "medium"), ("r", "tiny_kernels", "low")}


def test_recorder(spark):
    ticks = iter(range(100))
    rec = Recorder(clock=lambda: next(ticks))
    with rec.span("a", "t", x=1, y=None) as late:
        late["z"] = 2
        with pytest.raises(KeyError), rec.span("b", "t"):
            rec.next_attempt("t")
            raise KeyError("k")
    rec.event("p", "t")
    rows = rec.table(spark).collect()
    assert [(r["type"], r["name"], r["attempt"], r["error"]) for r in rows] == [("span_start", "a", 0, None), ("span_start", "b", 0, None), ("span_end", "b", 1, "KeyError"), ("span_end", "a", 1, None), ("event", "p", 1, None)]
    assert rows[0]["attrs"] == {"x": "1"} and rows[3]["attrs"] == {"z": "2"} and rows[1]["parent_id"] == rows[0]["span_id"] and rows[4]["parent_id"] is None
    assert Recorder().table(spark).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.lists(st.lists(st.integers(0, 4), min_size=3, max_size=3), min_size=1, max_size=12))
def test_best_of(k, scores):
    s = np.array(scores, dtype=float).T
    top_s, top_i = np.zeros((3, 0)), np.zeros((3, 0), dtype=int)
    for a in range(0, s.shape[1], 4):
        top_s, top_i = rt.best_of(top_s, top_i, s[:, a : a + 4], np.arange(a, min(a + 4, s.shape[1])), k)
    for q in range(3):
        want = sorted((-v, i) for i, v in enumerate(s[q]))[:k]
        assert list(zip((-top_s[q]).tolist(), top_i[q].tolist(), strict=True)) == want


def test_bm25_edges(spark):
    docs = spark.createDataFrame([(1, "red fox fox"), (2, "blue fox"), (3, None), (4, ""), (5, "green")], "doc_id long, text string")
    q = spark.createDataFrame([("a", "fox"), ("b", "fox RED"), ("c", "nothing"), ("d", None)], "query_id string, text string")
    got = {}
    for r in rt.bm25_top_k(docs, q, 5, block=2).collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    assert got == {"a": [1, 2], "b": [1, 2]}
    assert rt.bm25_top_k(docs, q.limit(0), 5).count() == 0 and rt.bm25_top_k(docs.limit(0), q, 5).count() == 0


def test_pooling(spark):
    t = spark.createDataFrame([("a", 1, [1.0, 2.0], 0), ("a", 2, [3.0, 4.0], 1), ("b", 1, [5.0, 6.0], 0)], "s string, k int, v array<double>, m int")
    assert {r["s"]: r["pooled"] for r in rt.pool(t, "s", "k", "v", "mean", "m").collect()} == {"a": [3.0, 4.0], "b": [0.0, 0.0]}
    assert {r["s"]: r["pooled"] for r in rt.pool(t, "s", "k", "v", "cls").collect()} == {"a": [1.0, 2.0], "b": [5.0, 6.0]}
    with pytest.raises(ValueError, match="pooled"):
        rt.pool(t, "s", "k", "v", "pooler")
    with pytest.raises(ValueError, match="unknown"):
        rt.pool(t, "s", "k", "v", "max")


def test_cursor(spark):
    p = spark.range(10).withColumnRenamed("id", "k")
    s = PromptSource(p, "k", seed=None, copies=2, state=State(offset=8))
    s.add(spark.createDataFrame([(100,), (101,)], "k long"))
    a = s.take(3).orderBy("group_index", "index").collect()
    assert [(r["origin"], r["k"], r["group_index"], r["index"]) for r in a] == [("buffer", 100, 0, 0), ("buffer", 100, 0, 1), ("buffer", 101, 1, 2), ("buffer", 101, 1, 3), ("dataset", 8, 2, 4), ("dataset", 8, 2, 5)]
    b = s.take(4).where("index % 2 = 0").orderBy("index").collect()
    assert [(r["epoch"], r["k"]) for r in b] == [(0, 9), (1, 0), (1, 1), (1, 2)] and s.saved() == {"epoch": 1, "offset": 3, "group_index": 7, "index": 14}
    assert s.take(30).select("k").distinct().count() == 10 and s.state.epoch == 2  # wraps once
    assert s.take(0).count() == 0
    x, y = (PromptSource(p.repartition(n), "k").take(10).orderBy("pos").collect() for n in (1, 5))
    assert [r["k"] for r in x] == [r["k"] for r in y] != list(range(10))


def test_store(spark, tmp_path):
    s = GroupStore(spark, str(tmp_path / "s"), "group_index bigint, reward double", 2)
    assert s.queued() == 0 and s.read()[0].count() == 0
    rows = lambda *g: spark.createDataFrame([(x, 0.5) for x in g], "group_index long, reward double")
    s.append(rows(1, 2))
    assert s.read()[0].count() == 0 and s.queued() == 0
    s.append(rows(1, 3), 1)
    s.append(rows(1, 3), 1)  # a repeated batch replaces itself
    assert s.queued() == 2
    data, report = s.read()
    assert sorted(r["group_index"] for r in data.collect()) == [1, 1] and report.first()["total_samples"] == 4
    s.append(rows(1, 2, 2))  # later members begin a new group
    data, report = s.read()
    assert sorted(r["group_index"] for r in data.collect()) == [2, 2, 2] and report.first()["total_samples"] == 3
    assert sorted(r["group_index"] for r in s.waiting().collect()) == [1, 3]


def test_recycling_and_polls(spark):
    df = spark.createDataFrame([(1, 5, "a", None), (1, 6, "b", None), (2, 7, "", None), (3, 8, "c", 2), (3, 9, "d", None), (4, 1, "x", None)], "group_index int, done int, response string, start_rollout_id int")
    kept = spark.createDataFrame([(1,), (2,), (3,)], "group_index int")
    got, back = collect_and_recycle(df, kept, 2, "done", 7)
    assert sorted(r["group_index"] for r in got.collect()) == [1, 1, 2]
    assert sorted((r["response"], r["start_rollout_id"]) for r in back.collect()) == [("c", 2), ("d", 7)]
    got, back = collect_and_recycle(df, kept, 9, "done", 7)  # fewer than asked for: nothing is aborted
    assert got.count() == 5 and back.count() == 0
    n = iter(range(1, 9))
    assert poll(lambda: next(n), 3, sleep=lambda s: None) == (3, 3)
    assert poll(lambda: 0, 3, retries=2, sleep=lambda s: None) == (0, 3)


def test_rewards_by_name(spark):
    rows = [("math", "\\frac{1}{2}", "0.5", None), ("boxed_math", "so \\boxed{7}", "7", None), ("boxed_math", "no box", "7", None), ("deepscaler", "<think>x</think> \\boxed{7}", "7", None), ("dapo", "Answer: 7", "7", None), ("f1", "red fox", "red", None), ("gpqa", "Answer: B", "B", None), (None, "red", "red", {"rm_type": "f1"}), ("", "red", "red", None), ("remote_rm", "abc", "x", None)]
    df = spark.createDataFrame(rows, "kind string, response string, label string, metadata map<string,string>")
    got = [round(r[0], 3) for r in df.select(rw.reward(F.col("kind"), F.col("response"), F.col("label"), F.col("metadata"), default="f1", scorers={"remote_rm": lambda r, t: F.length(r)})).collect()]
    assert got == [1.0, 1.0, 0.0, 1.0, 1.0, 0.667, 1.0, 1.0, 1.0, 3.0]
    one = spark.createDataFrame([("random", "abc", "x")] * 2, "kind string, response string, label string")
    assert len({r[0] for r in one.select(rw.reward(F.col("kind"), F.col("response"), F.col("label"))).collect()} | {0.0, 1.0}) == 2
    for kind in ("ifbench", "other", "boxed_", ""):
        bad = spark.createDataFrame([(kind, "a", "b")], "kind string, response string, label string")
        with pytest.raises(PySparkException, match="no scorer"):
            bad.select(rw.reward(F.col("kind"), F.col("response"), F.col("label"))).collect()


def test_masks_of_a_tool_flow(spark):
    turns = [("system", "SYS", None), ("user", "U", None), ("assistant", "<think>\nA\n</think>\nB", None), ("tool", "T", None), ("assistant", "C", 0), ("assistant", "D", 1)]
    df = spark.createDataFrame([(1, turns), (2, [])], "k int, m array<struct<role string, content string, step_loss_mask int>>")
    text = df.select("k", mk.render(F.col("m")).alias("t")).where("k = 1").first()["t"]

    def picked(family):
        return [text[r["start"] : r["end"]] for r in mk.trained_ranges(df, "k", "m", family).orderBy("turn").collect()]

    assert picked("per_turn") == picked("prefixed") == ["<think>\nA\n</think>\nB<|im_end|>\n", "D<|im_end|>\n"]
    assert picked("full_text") == ["A\n</think>\nB<|im_end|>\n", "D<|im_end|>\n"]
    m = {r["k"]: r["mask"] for r in mk.token_masks(df, "k", "m", "full_text").collect()}
    assert "".join(c for c, b in zip(text, m[1], strict=True) if b) == "A\n</think>\nB<|im_end|>\nD<|im_end|>\n" and m[2] == []
    last = {r["k"]: r["mask"] for r in mk.token_masks(df, "k", "m", "last_reply").collect()}
    assert sum(last[1]) == 1 and last[1][-1] == 1 and len(last[1]) == len("<|im_start|>system\nSYS<|im_end|>\n<|im_start|>assistant\nD") and last[2] == []
    with pytest.raises(ValueError, match="family"):
        mk.trained_ranges(df, "k", "m", "other")


def test_agent_rewards(spark):
    def run(g, *agents):
        return [(g, k, role, r, text, sol, pick) for k, (role, r, text, sol, pick) in enumerate(agents)]

    rows = run(1, ("solver", 0.0, "a", "a", None), ("rewriter", 1.0, "x s1", "s1", None), ("rewriter", 0.0, "y s2", "s2", None), ("selector", 0.0, "p", None, 0))
    rows += run(2, ("solver", 1.0, "a", "a", None), ("rewriter", 1.0, "x s1", "s1", None), ("rewriter", 0.0, "y s2", "s2", None), ("selector", 0.0, "p", None, 1))
    rows += run(3, ("solver", 1.0, "a", None, None), ("rewriter", 1.0, "x", "x", None)) + run(4, ("solver", 1.0, "a", "a", None), ("rewriter", 1.0, "x", None, None), ("selector", 1.0, "p", None, 0))
    rows += run(5, ("solver", 1.0, "a", "a", None), ("rewriter", 1.0, "x", "x", None), ("selector", 1.0, "p", None, 7))
    df = spark.createDataFrame(rows, "group_index int, sample_index int, role string, reward double, text string, solution string, pick int")
    got = {}
    for r in gp.agent_rewards(df).orderBy("sample_index").collect():
        got.setdefault(r["group_index"], []).append(round(r["reward"], 2))
    assert got == {1: [0.0, 1.2, 0.0, 1.2], 2: [0.8, 0.8, 0.0, 0.0], 3: [0.8], 4: [0.8, 0.8], 5: [0.8, 0.8, 0.0]}


def test_pass_at_and_over_sampling(spark):
    x = spark.createDataFrame([(1, 0, 2), (4, 0, 4), (4, 1, 2), (4, 3, 2)], "n int, c int, k int").select(F.when(F.col("k") == 2, gp.pass_at(F.col("n"), F.col("c"), 2)).otherwise(gp.pass_at(F.col("n"), F.col("c"), 4)))
    assert [r[0] for r in x.collect()] == [1.0, 0.0, 0.5, 1.0]  # too few tries count as passed
    v = spark.range(40).select("id", (F.col("id") % 2 == 0).alias("keep"))
    got = {r["batch"]: r["needed"] for r in gp.over_sampling(v, "id", 4, 8).collect()}
    assert [got[k] for k in range(10)] == [True] * 4 + [False] * 6  # 8 accepted after 15 rooms, 7 of them rejected
    assert all(r["needed"] for r in gp.over_sampling(v, "id", 4, 99).collect()) and gp.over_sampling(v.limit(0), "id", 4, 8).count() == 0


def test_small_columns(spark):
    df = spark.createDataFrame([("AAAAAP////8=", '[{"a": 1, "b": null}, 3]', "one\ntwo three\nfour")], "code string, kw string, text string")
    r = df.select(sc.decode_int32(F.col("code")).alias("i"), sc.kwargs_list(F.col("kw"), F.lit(3)).alias("k"), sc.paragraphs(F.col("text"), F.array(F.lit("two"), F.lit("one two"), F.lit("three"), F.lit("no"))).alias("p"), sc.instruction_ids(F.array(F.lit(" a "), F.lit(None), F.lit(" "))).alias("d")).first()
    assert r["i"] == [0, -1] and r["k"] == ['{"a": 1}', "{}", "{}"] and r["p"] == "two three\none\ntwo three" and r["d"] == ["a"]
    n = spark.createDataFrame([(0,), (10,)], "n int")
    full = [x[0] for x in n.select(sc.flops(F.col("n"), 8, 2, 1, 4, 16, 2, 100)).collect()]
    assert full == [0.0, 2 * (2 * 10 * 8 * 8 + 4 * 10 * 8 * 4 + 2 * 2 * 100 * 4 + 2 * 10 * 64 + 6 * 10 * 8 * 16) + 2 * 10 * 8 * 100]
    assert [x[0] for x in n.select(sc.flops(F.col("n"), 8, 2, 1, 4, 16, 3, 100, experts=2, expert_ffn=5, moe_every=[0, 1, 0])).collect()] != full
    with pytest.raises(PySparkException):
        df.select(sc.reshape(F.array(*[F.lit(1)] * 5), 2, 2)).collect()


def test_configuration_tables(spark):
    with pytest.raises(ValueError, match="rows"):
        configs.table_rows(spark.range(configs.MOST_ROWS + 1), "id")
    x = spark.range(1).select(configs.merged_column(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit(None).cast("string")), F.lit(""), F.lit(None).cast("map<string,string>")).alias("m")).first()["m"]
    assert x == {"a": "1", "b": None}


def test_requests(spark):
    lines = spark.createDataFrame([(1, '{"a": 1}'), (2, " "), (3, "[1]"), (4, "{"), (5, None)], "n long, t string")
    got = [(r["replay_round"], r["line_number"], r["error"]) for r in readers.read_requests(lines, "n", "t", 2, 4).orderBy("replay_round", "line_number").collect()]
    assert got == [(1, 1, None), (1, 3, "JSON line must be an object"), (1, 4, "Invalid JSON"), (2, 1, None)]
    assert readers.read_requests(lines.limit(0), "n", "t").count() == 0


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(RuntimeError, match="checkpoint"):
        od.ensure_checkpoint_dir(Session())


def test_written_tables_are_dropped(spark):
    t = od.materialize(spark.range(5))
    assert t.count() == 5 and od._WRITTEN
    od.drop_tables(spark)
    assert not od._WRITTEN


def test_health(spark):
    rows = [("a", k, ok) for k, ok in enumerate([True, False, True, True, None, True])] + [("b", 0, True)]
    df = spark.createDataFrame(rows, "engine string, round int, ok boolean")
    got = {(r["engine"], r["round"]): r["event"] for r in health_events(df, recover_every=3).collect()}
    assert [got[("a", k)] for k in range(6)] == ["passed", "killed", "skipped", "passed", "killed", "skipped"] and got[("b", 0)] == "passed"
    assert health_events(df.limit(0)).count() == 0
    calls, waits = [], []

    def kill(part):
        calls.append(part)
        if part == "y2":
            raise OSError

    m = Monitor({"x": ["x1"], "y": ["y1", "y2"]}, lambda w: w == "x", kill, lambda p: calls.append("+" + p), 1.0, 5.0, waits.append)
    m.run(1)
    assert m.log == []  # paused at first
    m.resume()
    m.run(2)
    assert m.log == [("x", "passed"), ("y", "killed"), ("y2", "kill failed"), ("x", "passed"), ("y", "skipped")] and waits == [5.0, 1.0, 1.0]
    assert m.recover() == ["y"] and calls == ["y1", "y2", "+y1", "+y2"]
    m.pause()
    m.run(1)
    assert len(m.log) == 5


def test_checked_partitions():
    lengths = [5, 4, 3, 3, 3]
    assert abs(sum(lengths[i] for i in bl.checked_partitions(lengths, 2)[0]) - 9) <= 1
    parts = bl.checked_partitions([5, 4, 3, 3, 2, 1], 3, True)
    assert sorted(i for p in parts for i in p) == list(range(6)) and all(len(p) == 2 for p in parts)
    with pytest.raises(ValueError, match="items"):
        bl.checked_partitions([1], 2)
    with pytest.raises(ValueError, match="equal"):
        bl.checked_partitions([1, 2, 3], 2, True)

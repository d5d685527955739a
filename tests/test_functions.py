"""Functions without SQL: grading, balancing, sources and the group buffer."""

import gzip
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import grading as gr
from quillspark.functions import masks as mk
from quillspark.functions import scoring as sc
from quillspark.functions import tokens as tk
from quillspark.functions.remote import with_retries
from quillspark.operators import balance as bl
from quillspark.operators import groups as gp
from quillspark.operators import trace as tr
from quillspark.operators.ordering import drop_tables, materialize, row_index
from quillspark.plans.registry import Hooks, load_hook
from quillspark.sources import configs, pull, readers, sinks
from quillspark.streaming import buffer as bf


@pytest.mark.parametrize(("text", "box"), [("a \\boxed{1} b \\boxed{\\frac{1}{2}}", "\\boxed{\\frac{1}{2}}"), ("\\boxed{1", None), ("none", None), (None, None), ("\\boxed{a{b}c} x", "\\boxed{a{b}c}")])
def test_last_box(text, box):
    assert gr.last_box(text) == box


@pytest.mark.parametrize(("given_", "truth", "same"), [
    ("1/2", "\\frac{1}{2}", True), ("0.5", "\\frac12", True), ("2/4", "1/2", False), ("1,000", "1000", True), ("(1,2)", "(1, 2)", True), ("(1,2]", "(1,2)", False), ("x+1", "1+x", True), ("2x", "x*2", True),
    ("3", "4", False), ("", "4", False), ("\\text{yes}", "yes", True), ("10\\%", "10", True), ("\\sqrt{4}", "2", False), ("sqrt(8)", "2*sqrt(2)", True), ("5 cm", "5", True), ("7 3/4", "31/4", True), (None, "4", False),
])
def test_grade(given_, truth, same):
    assert gr.grade(given_, truth) is same


def test_scores():
    assert gr.score("So Answer: 42", "42") == (1.0, True, "42")
    assert gr.score("Answer: 41", "42")[0] == -1.0
    assert gr.score("no", "abc")[1] is False
    assert gr.score("\\boxed{7}", "7", strict=True) == (1.0, True, "7")
    assert gr.reasoned_reward("<think>a</think> \\boxed{3}", "3") == 1.0
    assert gr.reasoned_reward("\\boxed{3}", "3") == 0.0
    assert gr.math_reward("\\boxed{3}", "\\boxed{3}") and not gr.math_reward("3", "3") and not gr.math_reward("\\boxed{3}", "")
    assert gr.final_answer("x = 1,234 dollars") == "1234"
    assert gr.balanced_json('x {"a": "}", "b": {"c": 1}} y', 2) == '{"a": "}", "b": {"c": 1}}'
    assert gr.balanced_json("{", 0) is None


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=8, max_size=40))
def test_largest_differencing(lengths):
    parts = bl.largest_differencing(lengths, 4)
    assert sorted(i for p in parts for i in p) == list(range(len(lengths)))
    sums = [sum(lengths[i] for i in p) for p in parts]
    assert max(sums) - min(sums) <= max(lengths)
    if len(lengths) % 4 == 0:
        assert {len(p) for p in bl.largest_differencing(lengths, 4, True)} == {len(lengths) // 4}


def test_balance_edges():
    with pytest.raises(ValueError):
        bl.largest_differencing([1, 2, 3], 2, True)
    with pytest.raises(ValueError):
        bl.largest_differencing([], 2)
    assert bl.first_fit([5, 6, 5, 4], 10) == [0, 1, 0, 1]
    assert bl.first_fit([20, 1], 10) == [0, 1]
    assert bl.least_loaded([3, 3, 1, 1], 2) == [0, 1, 0, 1]
    assert bl.chunks_by_size([4, 4, 4], 8) == [0, 1, 2]
    assert bl.balanced([3], 4) == [0]


def serial_gae(r, v, g, lam):
    out, nxt = [], 0.0
    for t in reversed(range(len(r))):
        d = r[t] + g * (v[t + 1] if t + 1 < len(v) else 0.0) - v[t]
        nxt = d + g * lam * nxt
        out.append(nxt)
    return out[::-1]


def test_scans(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random() for _ in range(n)], [rng.random() for _ in range(n)]) for i, n in enumerate([0, 1, 2, 7, 300])]
    df = spark.createDataFrame(rows, "i int, r array<double>, v array<double>")
    got = {x["i"]: x["a"] for x in df.select("i", tk.gae(F.col("r"), F.col("v"), 0.99, 0.95)[0].alias("a")).collect()}
    for i, r, v in rows:
        np.testing.assert_allclose(got[i], serial_gae(r, v, 0.99, 0.95), atol=1e-9)
    one = spark.createDataFrame([([0.1, 0.2], [0, 0])], "kl array<double>, m array<int>")
    with pytest.raises(Exception, match="no token with mask 1"):
        one.select(tk.reinforce_returns(F.lit(1.0), F.col("kl"), F.col("m"), 0.1, 0.9)).collect()
    tails = spark.createDataFrame([([1, 2, 3],)], "a array<int>").select(tk.tail(F.col("a"), F.lit(0)).alias("all"), tk.tail(F.col("a"), F.lit(2)).alias("two")).first()
    assert tails["all"] == [1, 2, 3] and tails["two"] == [2, 3]


def test_mismatch_errors(spark):
    df = spark.createDataFrame([(1, 0, -0.1, -0.2, 1)], "seq int, pos int, train double, rollout double, mask int")
    with pytest.raises(ValueError):
        tk.mismatch_weights(df, "geometric", normalize=True)
    with pytest.raises(ValueError):
        tk.approx_kl(F.lit(1.0), F.lit(1.0), "k9")
    with pytest.raises(Exception, match="masked token"):
        tk.whiten(df.withColumn("mask", F.lit(0)), "train", "mask", "w").collect()


def test_groups(spark):
    rows = [(1, 0, 1.0), (1, 1, 1.0), (2, 2, 0.25), (3, 3, 0.0), (3, 4, 1.0), (4, 5, None)]
    df = spark.createDataFrame(rows, "group_index int, sample_index int, reward double")
    got = {r["group_index"]: (r["keep"], r["reason"]) for r in gp.reward_filter(df).collect()}
    assert got == {1: (False, "zero_std_1.0"), 2: (False, "zero_std_0.2"), 3: (True, None), 4: (False, None)}
    assert {r["metric"]: r["value"] for r in gp.zero_std(df).collect()} == {"zero_std/count_1.0": 1, "zero_std/count_0.2": 1}
    assert gp.pass_rates(df, 1).count() == 0
    two = {r["k"]: r["pass_rate"] for r in gp.pass_rates(df, 2).collect()}
    assert two == {1: 0.75, 2: 1.0}
    valid = {r["sample_index"]: r["reward"] for r in gp.normalize_valid(spark.createDataFrame([(1, 0, 0.0), (1, 1, 0.0), (1, 2, 5.0), (2, 3, 0.5), (2, 4, 0.5), (3, 5, -1.0)], "group_index int, sample_index int, reward double")).collect()}
    assert valid == {0: 0.0, 1: 0.0, 2: 5.0, 3: 0.0, 4: 0.0, 5: -1.0}
    left = gp.bag_anti_join(spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k int, o int"), spark.createDataFrame([(1,), (9,)], "k int"), "k", "o")
    assert sorted(r["o"] for r in left.collect()) == [2, 3]


def test_row_index(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("x"))
    assert all(r["x"] == r["row"] for r in row_index(df, "x").collect())
    assert row_index(df.limit(0), "x").count() == 0


def test_written_tables(spark):
    df = materialize(spark.range(5))
    assert df.count() == 5
    drop_tables(spark)
    with pytest.raises(Exception, match="(?i)not.*(exist|found)"):
        df.count()


def test_tag_scores(spark):
    ok = "<think>a</think><search>q</search><information>Paris it is</information><think>b</think> <answer>Paris</answer>"
    rows = [(ok,), ("<answer>Paris</answer>",), ("<think>a</think> x <answer>Paris</answer>",), ("",)]
    got = [r["v"] for r in spark.createDataFrame(rows, "t string").select(sc.valid_sequence(F.col("t")).alias("v")).collect()]
    assert got == [True, False, False, False]
    golds = F.array(F.lit("the Paris!"))
    s = spark.createDataFrame([("<answer>x</answer>" + ok,), (ok,)], "t string").select(sc.answer_of(F.col("t")).alias("a"), sc.retrieval_correct(F.col("t"), golds).alias("r"), sc.exact_match(sc.answer_of(F.col("t"), 1), golds).alias("e")).collect()
    assert s[0]["a"] == "Paris" and s[1]["a"] is None and s[0]["r"] and s[0]["e"]


def test_sources(spark, tmp_path):
    assert readers.split_path("a@[1:3]") == ("a", 1, 3) and readers.split_path("a@[:]") == ("a", None, None) and readers.split_path("a") == ("a", None, None)
    with pytest.raises(ValueError):
        readers.split_path("a@[-1:2]")
    f = tmp_path / "x.jsonl"
    f.write_text('{"a": 1}\n\n{"a": \n{"a": 2}\nnot json\n{"a": 3}\n')
    assert sorted(r["a"] for r in readers.read_rows(spark, str(f), "a int").collect()) == [1, 2, 3]
    assert sorted(r["a"] for r in readers.read_rows(spark, f"{f}@[1:]", "a int", ["a"]).collect()) == [2, 3]
    assert readers.parse_lines(spark.read.text(str(f)), "a int")[1].count() == 2
    with pytest.raises(ValueError):
        readers.read_rows(spark, "a.csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_rows(spark, str(tmp_path / "none.parquet"))
    trace = tmp_path / "t.json.gz"
    trace.write_bytes(gzip.compress(json.dumps({"traceEvents": [{"cat": "kernel", "ph": "X", "name": "k", "ts": 1, "dur": 2, "tid": 3}]}).encode()))
    assert readers.trace_events(spark.read.text(str(trace), wholetext=True)).first()["name"] == "k"
    bad = spark.createDataFrame([(1, "a <image> b", [])], "id int, t string, m array<string>")
    with pytest.raises(Exception, match="differ in number"):
        readers.interleave(bad, "id", "t", "m").collect()
    good, rejected = pull.checked(spark.createDataFrame([('{"uid": 1}',), (None,), ("x",)], "item string"))
    assert good.count() == 0 and rejected.count() == 3


def test_sinks_and_configs(spark, tmp_path):
    df = spark.range(3)
    sinks.write_lines(df, str(tmp_path / "l"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_lines(df, str(tmp_path / "l"))
    sinks.write_lines(df, str(tmp_path / "l"), overwrite=True)
    assert sinks.load_cursor(spark, str(tmp_path / "c")) is None
    sinks.save_cursor(spark, str(tmp_path / "c"), epoch=2, offset=7)
    assert sinks.load_cursor(spark, str(tmp_path / "c")) == {"epoch": 2, "offset": 7}
    assert configs.resolve("x", {"x": None}, {"x": 1}, {"x": 2}) is None and configs.resolve("x", {}, {"x": 1}, {"x": 2}) == 1
    assert configs.merged_metadata({"a": 1, "rm_type": "f1"}, "math", {"a": 2}) == {"a": 2, "rm_type": "math"}
    with pytest.raises(ValueError):
        configs.pairs(["a", "b", "c"])
    with pytest.raises(ValueError):
        configs.dataset_list([{"path": "p"}])


def test_trace_cases(spark):
    ev = [(1, 0, 0, "span_start", "a", 1, None), (1, 1, 5, "span_start", "b", 2, 1), (1, 2, 6, "note", "n", None, None), (1, 3, 9, "span_end", "b", 2, None), (1, 4, 12, "span_end", "z", 9, None), (2, 0, 0, "span_start", "x", 1, 2), (2, 1, 1, "span_start", "y", 2, 1)]
    df = spark.createDataFrame(ev, "trace int, ord int, ts long, type string, name string, span_id int, parent_id int")
    spans = tr.pair_spans(df)
    assert sorted((r["trace"], r["state"]) for r in spans.collect()) == [(1, "closed_span"), (1, "open_span"), (1, "orphan_end"), (1, "point_event"), (2, "open_span"), (2, "open_span")]
    depth = {(r["trace"], r["span_id"]): r["depth"] for r in tr.depths(spans.where("state in ('closed_span', 'open_span')").select("trace", "span_id", "parent_id")).collect()}
    assert depth[(1, 1)] == 0 and depth[(1, 2)] == 1 and depth[(2, 1)] == 0  # a cycle
    inner = {(r["trace"], r["ord"]): r["inferred_parent"] for r in tr.infer_parents(df.select("trace", "ord", "type", "span_id")).collect()}
    assert inner[(1, 2)] == 2 and inner[(1, 4)] == 1
    merged = tr.merge_intervals(spark.createDataFrame([(1, 0, 2), (1, 2, 3), (1, 5, 6), (1, 1, 1)], "g int, s int, f int"), ["g"], "s", "f")
    assert sorted((r["s"], r["f"]) for r in merged.collect()) == [(0, 3), (5, 6)]


def test_masks(spark):
    df = spark.createDataFrame([(1, [("user", "hi", None), ("assistant", "yo", 1), ("assistant", "no", 0)])], "id int, m array<struct<role string, content string, step_loss_mask int>>")
    text = df.select(mk.render(F.col("m")).alias("t")).first()["t"]
    for r in mk.turn_spans(df, "id", "m").collect():
        assert text[r["start"] : r["end"]] in ("hi", "yo", "no") and r["trained"] == (text[r["start"] : r["end"]] == "yo")


def test_remote_retries():
    waits, left = [], [3]

    def call(p):
        left[0] -= 1
        if left[0] >= 0:
            raise ConnectionError
        return 1.0

    assert with_retries(call, {}, sleep=waits.append) == 1.0
    assert [int(w) for w in waits] == [1, 2, 4] or all(a <= b + 1 for a, b in zip(waits, [1, 2, 4], strict=True))
    with pytest.raises(ConnectionError):
        with_retries(lambda p: (_ for _ in ()).throw(ConnectionError()), {}, tries=2, sleep=lambda s: None)


def test_hooks(spark):
    with pytest.raises(ValueError):
        Hooks(nonsense=len)
    with pytest.raises(ImportError):
        load_hook("plain")
    with pytest.raises(AttributeError):
        load_hook("json.nothing")
    assert load_hook("json.dumps") is json.dumps
    seen = []
    Hooks(log=lambda m: True).log(None, seen.append)
    Hooks(log=lambda m: None).log(1, seen.append)
    assert seen == [1]


def test_buffer_late_and_timeout(spark, tmp_path):
    rows = [(1, i, float(i % 2), i) for i in range(5)] + [(2, 9, 1.0, 9)]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "group_index long, sample_index long, reward double, arrived_at long").write.parquet(src)
    out = str(tmp_path / "out")
    bf.run_to_end(bf.group_buffer(bf.file_stream(spark, src), 4), out, str(tmp_path / "s"))
    got = spark.read.parquet(out).collect()
    assert sorted(r["sample_index"] for r in got) == [0, 1, 2, 3] and all(r["complete"] for r in got)
    spark.createDataFrame([(1, 20 + i, 0.0, 20 + i) for i in range(3)], "group_index long, sample_index long, reward double, arrived_at long").write.mode("append").parquet(src)
    bf.run_to_end(bf.group_buffer(bf.file_stream(spark, src), 4), out, str(tmp_path / "s"))
    assert spark.read.parquet(out).where("emission = 1").count() == 4  # the late member began a new group

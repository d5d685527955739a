"""Span reconstruction and interval analytics over event logs.

Events have ``trace, ord, ts, type`` (``span_start``, ``span_end`` or other), ``name, span_id, parent_id``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import materialize


def infer_parents(events: DataFrame) -> DataFrame:
    """Adds the span that is innermost when the event happens. Within one trace events are an ordered fold; traces are spread."""
    kinds = {c: t for c, t in events.dtypes}

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        stack: list = []
        inner = []
        rows = rows.sort_values("ord")
        for kind, span in zip(rows["type"], rows["span_id"], strict=True):
            inner.append(stack[-1] if stack else None)
            if kind == "span_start" and span is not None:
                stack.append(span)
            elif kind == "span_end" and span in stack:
                del stack[len(stack) - 1 - stack[::-1].index(span)]
        return rows.assign(inferred_parent=pd.Series(inner, index=rows.index, dtype=object))

    return events.groupBy("trace").applyInPandas(fold, ", ".join(f"{c} {t}" for c, t in kinds.items()) + f", inferred_parent {kinds['span_id']}")


def pair_spans(events: DataFrame) -> DataFrame:
    """``trace, span_id, name, parent_id, start, end, state``: starts and ends of equal ids are paired in their order.

    A start without an end is ``open_span``, an end without a start ``orphan_end``, other events are ``point_event``. An end before
    its start pairs with nothing.
    """
    w = Window.partitionBy("trace", "span_id").orderBy("ord")
    starts = events.where("type = 'span_start' and span_id is not null").withColumn("nth", F.row_number().over(w))
    ends = events.where("type = 'span_end'").withColumn("nth", F.row_number().over(w))
    a, b = starts.alias("a"), ends.alias("b")
    on = (F.col("a.trace") == F.col("b.trace")) & (F.col("a.span_id") == F.col("b.span_id")) & (F.col("a.nth") == F.col("b.nth")) & (F.col("b.ord") > F.col("a.ord"))
    spans = a.join(b, on, "full_outer").select(
        F.coalesce("a.trace", "b.trace").alias("trace"), F.coalesce("a.span_id", "b.span_id").alias("span_id"), F.coalesce("a.name", "b.name").alias("name"), F.coalesce("a.parent_id", "b.parent_id").alias("parent_id"), F.col("a.ts").alias("start"), F.col("b.ts").alias("end"),
        F.when(F.col("b.ts").isNull(), "open_span").when(F.col("a.ts").isNull(), "orphan_end").otherwise("closed_span").alias("state"),
    )
    points = events.where("type not in ('span_start', 'span_end')").select("trace", F.lit(None).cast(dict(events.dtypes)["span_id"]).alias("span_id"), "name", F.col("parent_id"), F.col("ts").alias("start"), F.col("ts").alias("end"), F.lit("point_event").alias("state"))
    return spans.unionByName(points)


def depths(spans: DataFrame) -> DataFrame:
    """``trace, span_id, depth`` by pointer doubling: 2^k levels after k rounds; spans that lead into a cycle get 0."""
    spans = materialize(spans.select("trace", "span_id", "parent_id"))
    most = spans.groupBy("trace").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    ids = spans.select("trace", "span_id")
    known = spans.select("trace", F.col("span_id").alias("anc"))
    state = spans.select("trace", "span_id", F.col("parent_id").alias("anc")).join(known.withColumn("_k", F.lit(1)), ["trace", "anc"], "left")
    state = materialize(state.select("trace", "span_id", F.when(F.col("_k") == 1, F.col("anc")).alias("anc"), F.coalesce("_k", F.lit(0)).cast("long").alias("depth")))
    for _ in range(int(most).bit_length() + 1):
        if state.where("anc is not null").isEmpty():
            break
        up = state.select("trace", F.col("span_id").alias("anc"), F.col("anc").alias("next"), F.col("depth").alias("more"))
        state = materialize(state.join(up, ["trace", "anc"], "left").select("trace", "span_id", F.col("next").alias("anc"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
    return ids.join(state, ["trace", "span_id"]).select("trace", "span_id", F.when(F.col("anc").isNotNull(), F.lit(0)).otherwise(F.col("depth")).cast("long").alias("depth"))


def close_open(spans: DataFrame) -> DataFrame:
    """Adds ``shown_end`` and ``clipped_by`` to open spans: the first of the trace's last time, the next sibling's start and the end of the
    nearest closed ancestor (by pointer doubling, however deep; a cycle has none), never before the start."""
    spans = materialize(spans)
    whole = Window.partitionBy("trace")
    x = spans.withColumn("row_end", F.max(F.greatest("start", F.coalesce("end", "start"))).over(whole))
    x = x.where("state in ('closed_span', 'open_span')").withColumn("_s", F.unix_micros("start") if dict(spans.dtypes)["start"].startswith("timestamp") else F.col("start"))
    x = x.withColumn("sibling", F.min("start").over(Window.partitionBy("trace", "parent_id").orderBy("_s").rangeBetween(1, Window.unboundedFollowing)))
    most = x.groupBy("trace").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    up = x.select("trace", F.col("span_id").alias("hop"), F.col("end").alias("found"), F.lit(1).alias("_k"))
    # the end of a closed parent, else the open parent to look on from
    walk = x.select("trace", "span_id", F.col("parent_id").alias("hop"), "state").join(up, ["trace", "hop"], "left")
    walk = materialize(walk.select("trace", "span_id", "state", F.col("found").alias("anc_end"), F.when((F.col("_k") == 1) & F.col("found").isNull(), F.col("hop")).alias("hop")))
    for _ in range(int(most).bit_length() + 1):
        if walk.where("hop is not null and state = 'open_span'").isEmpty():
            break
        ahead = walk.select("trace", F.col("span_id").alias("hop"), F.col("anc_end").alias("found"), F.col("hop").alias("next"))
        walk = materialize(walk.join(ahead, ["trace", "hop"], "left").select("trace", "span_id", "state", F.coalesce("anc_end", "found").alias("anc_end"), F.when(F.coalesce("anc_end", "found").isNull(), F.col("next")).alias("hop")))
    out = x.where("state = 'open_span'").join(walk.select("trace", "span_id", "anc_end"), ["trace", "span_id"])
    anc = F.when(F.col("anc_end") > F.col("start"), F.col("anc_end"))
    first = F.least("row_end", "sibling", anc)
    why = F.when(first <= F.col("start"), "self").when(first == F.col("row_end"), "row_end").when(first == F.col("sibling"), "next_sibling_start").otherwise("ancestor_end")
    return out.select("trace", "span_id", F.greatest(first, F.col("start")).alias("shown_end"), why.alias("clipped_by"))


def merge_intervals(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Union of the intervals of each group; touching intervals merge.

    Intervals are merged inside ranges of (group, start) first, so that a group of any size is spread, and what is left of them once more.
    """
    ranged = df.select(*by, start, end).repartitionByRange(*by, start, end).withColumn("_range", F.spark_partition_id())
    return _islands(_islands(ranged, ["_range", *by], start, end), by, start, end).select(*by, start, end)


def _islands(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = df.withColumn("_new", (before.isNull() | (F.col(start) > before)).cast("int")).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def gaps(merged: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Idle time between merged intervals."""
    w = Window.partitionBy(*by).orderBy(start)
    return merged.select(*by, F.col(end).alias("gap_start"), F.lead(start).over(w).alias("gap_end")).where("gap_end > gap_start")


def top(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= k).drop("_rn")


#: Kernel labels by the first rule of whose words all, or any, stand in the lower-case name.
KERNELS = [
    ("any", ("nccl",), "NCCL Communication"),
    ("all", ("deep_ep", "dispatch",), "DeepEP Dispatch (MoE)"),
    ("all", ("deep_ep", "combine",), "DeepEP Combine (MoE)"),
    ("all", ("deep_ep", "clean",), "DeepEP Buffer Clean"),
    ("any", ("deep_ep",), "DeepEP (other)"),
    ("all", ("flash", "attn",), "Flash Attention"),
    ("any", ("sparse_attn",), "Sparse Attention (MLA)"),
    ("any", ("paged_mqa",), "Paged MQA/MLA Logits"),
    ("any", ("attention", "fmha",), "Attention (other)"),
    ("any", ("deep_gemm", "sm90_fp8_gemm",), "DeepGEMM (FP8)"),
    ("any", ("nvjet",), "NvJet GEMM"),
    ("any", ("gemm", "cutlass", "matmul", "cublas",), "GEMM/MatMul (other)"),
    ("any", ("topk",), "TopK / MoE Routing"),
    ("any", ("quant",), "Quantization (FP8)"),
    ("any", ("norm",), "Normalization"),
    ("any", ("triton", "fused",), "Fused/Triton Kernels"),
    ("any", ("elementwise",), "Elementwise Ops"),
    ("any", ("reduce", "softmax",), "Reduce/Softmax"),
    ("any", ("embedding",), "Embedding"),
    ("any", ("memcpy", "memset",), "Memory Ops"),
    ("any", ("index", "scatter", "gather",), "Index/Gather/Scatter"),
    ("all", ("cat", "batched",), "Concat/Cat"),
]
#: Entries of a server's reply that a trace keeps where they are set, beside ``finish_reason``.
META_KEYS = [
    "prompt_tokens",
    "completion_tokens",
    "cached_tokens",
    "pd_prefill_bootstrap_queue_duration",
    "pd_prefill_forward_duration",
    "pd_prefill_transfer_queue_duration",
    "pd_prefill_retry_count",
    "pd_decode_prealloc_duration",
    "pd_decode_transfer_duration",
    "pd_decode_forward_duration",
    "pd_bootstrap_duration",
    "pd_alloc_waiting_duration",
    "pd_transfer_speed_gb_s",
    "pd_transfer_total_mb",
]


def kernel_class(name: Column) -> Column:
    low, out = F.lower(name), F.lit("Other Compute")
    for how, words, label in reversed(KERNELS):
        tests = [low.contains(w) for w in words]
        test = tests[0]
        for t in tests[1:]:
            test = test & t if how == "all" else test | t
        out = F.when(test, label).otherwise(out)
    return out


def reply_attributes(meta: Column, finish_reason: Column) -> Column:
    """Map of the kept entries of a reply that are set, and why it ended."""
    kept = F.map_filter(meta, lambda k, v: k.isin(*META_KEYS) & v.isNotNull())
    reason = F.when(finish_reason.isNotNull(), F.create_map(F.lit("finish_reason"), finish_reason)).otherwise(F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(kept, lambda k, v: k != "finish_reason"), reason)


def bottlenecks(kernels: DataFrame, util: DataFrame, by: str, launch: str = "cudaGraphLaunch", copy: str = "aten::copy_", host: tuple[str, ...] = ("cudaGraphLaunch", "aten::copy_")) -> DataFrame:
    """``by, issue, severity`` of each profile (``by, name, label, dur`` in microseconds; ``util`` has ``by, util`` in percent).

    Rules: less than 90 % busy (less than 80 % is severe), launches of 5 ms or more, dispatch above 15 % and routing above 5 % of the kernels' time, more than
    100 ms of copies, more than five of the 30 kernels with most time below 3 microseconds on average.
    """
    device = ~F.col("name").isin(*host)
    k = kernels.withColumn("_dev", F.when(device, F.col("dur")).otherwise(0))

    def part(c: Column) -> Column:
        return F.sum(F.when(c, F.col("dur")).otherwise(0))

    sums = k.groupBy(by).agg(
        F.sum("_dev").alias("total"), F.count(F.when((F.col("name") == launch) & (F.col("dur") >= 5000), 1)).alias("launches"), part(device & (F.col("label") == "DeepEP Dispatch (MoE)")).alias("dispatch"),
        part(device & (F.col("label") == "TopK / MoE Routing")).alias("routing"), part(F.col("name") == copy).alias("copies"),
    )
    names = k.where(device).groupBy(by, "name").agg(F.sum("dur").alias("t"), F.avg("dur").alias("mean"))
    tiny = top(names, [by], [F.desc("t"), F.col("name")], 30).groupBy(by).agg(F.count(F.when(F.col("mean") < 3, 1)).alias("tiny"))
    x = sums.join(util, by, "left").join(tiny, by, "left")
    rules = [
        (F.col("util") < 90, "utilization", F.when(F.col("util") < 80, "high").otherwise("medium")), (F.col("launches") > 0, "launch_stalls", F.lit("high")), (F.col("dispatch") / F.col("total") > 0.15, "dispatch", F.lit("high")),
        (F.col("routing") / F.col("total") > 0.05, "routing", F.lit("medium")), (F.col("copies") > 100_000, "copies", F.lit("medium")), (F.col("tiny") > 5, "tiny_kernels", F.lit("low")),
    ]
    found = F.array(*[F.when(c, F.struct(F.lit(n).alias("issue"), s.alias("severity"))) for c, n, s in rules])
    return x.select(by, F.explode(F.filter(found, lambda e: e.isNotNull())).alias("e")).select(by, "e.issue", "e.severity")

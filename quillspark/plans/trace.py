"""Queries of trace, profile, retrieval and ordering operators (T*, J*, O*). A user's events are one trace."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.operators import retrieval as rt
from quillspark.operators import trace as tr
from quillspark.operators.ordering import exact_percentiles
from quillspark.operators.recorder import Recorder
from quillspark.plans.registry import op, table
from quillspark.plans.tokens import r6

# events as span log: of four events of a user, two start (a span and its child), one ends the child, the last ends the
# span or, in every third round, is a point, which leaves the span open
E = """o AS (SELECT user_id AS trace, event_id, epoch_us(ts) AS us, value, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ord FROM events),
 e AS (SELECT trace, ord, us, value, event_type AS name, CASE WHEN ord % 4 < 2 THEN 'span_start' WHEN ord % 4 = 2 OR ord // 4 % 3 <> 0 THEN 'span_end' ELSE 'event' END AS type,
  CASE WHEN ord % 4 = 0 THEN ord // 4 * 2 WHEN ord % 4 < 3 THEN ord // 4 * 2 + 1 WHEN ord // 4 % 3 <> 0 THEN ord // 4 * 2 END AS span_id,
  CASE WHEN ord % 4 = 1 THEN ord // 4 * 2 WHEN ord % 4 = 0 AND ord // 4 % 5 <> 0 THEN ord // 4 * 2 - 2 END AS parent_id FROM o)"""
P = """p AS (SELECT a.trace, a.span_id, a.name, a.parent_id, a.us AS s, b.us AS f, CASE WHEN b.us IS NULL THEN 'open_span' ELSE 'closed_span' END AS state FROM (SELECT * FROM e WHERE type = 'span_start') a LEFT JOIN (SELECT * FROM e WHERE type = 'span_end') b ON a.trace = b.trace AND a.span_id = b.span_id AND b.ord > a.ord)"""


def events(spark, d):
    """The span log; times in microseconds."""
    e = table(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    o = e.select(F.col("user_id").alias("trace"), "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "value", F.col("event_type").alias("name"), (F.row_number().over(w) - 1).cast("long").alias("ord"))
    k, g = F.col("ord") % 4, F.floor(F.col("ord") / 4).cast("long")
    kind = F.when(k < 2, "span_start").when((k == 2) | (g % 3 != 0), "span_end").otherwise("event")
    span = F.when(k == 0, g * 2).when(k < 3, g * 2 + 1).when(g % 3 != 0, g * 2)
    parent = F.when(k == 1, g * 2).when((k == 0) & (g % 5 != 0), g * 2 - 2)
    return o.select("*", kind.alias("type"), span.alias("span_id"), parent.alias("parent_id"))


def spans(spark, d):
    return tr.pair_spans(events(spark, d))


_RECORDED = "SELECT * FROM (VALUES ('span_start', 'rollout', NULL, 0, NULL), ('span_start', 'generate', 'rollout', 0, NULL), ('event', 'token', 'generate', 0, NULL), ('span_end', 'generate', 'rollout', 0, 'ValueError'), ('span_start', 'generate', 'rollout', 1, NULL), ('span_end', 'generate', 'rollout', 1, NULL), ('span_end', 'rollout', NULL, 1, NULL)) AS v(type, name, parent, attempt, error), (SELECT unnest(['a', 'b']) AS trace)"


@op("T1", f"WITH {E} SELECT 'log' AS trace, type, name, CAST(NULL AS VARCHAR) AS parent, 0 AS attempt, CAST(NULL AS VARCHAR) AS error, count(*) AS n FROM e GROUP BY type, name UNION ALL SELECT trace, type, name, parent, attempt, error, 1 FROM ({_RECORDED})")
def t1(spark, d):
    """A log's events by kind, and those of a recorder: nested spans of two traces, of which the first attempt fails."""
    rec = Recorder()
    with rec.span("rollout", "a", "b"):
        try:
            with rec.span("generate", "a", "b"):
                rec.event("token", "a", "b")
                raise ValueError
        except ValueError:
            for t in ("a", "b"):
                rec.next_attempt(t)
        with rec.span("generate", "a", "b"):
            pass
    r = rec.table(spark)
    names = r.where("type = 'span_start'").select("trace", F.col("span_id").alias("parent_id"), F.col("name").alias("parent"))
    own = r.join(names, ["trace", "parent_id"], "left").select("trace", "type", "name", "parent", "attempt", "error", F.lit(1).cast("long").alias("n"))
    log = events(spark, d).groupBy("type", "name").agg(F.count(F.lit(1)).alias("n"))
    return log.select(F.lit("log").alias("trace"), "type", "name", F.lit(None).cast("string").alias("parent"), F.lit(0).alias("attempt"), F.lit(None).cast("string").alias("error"), "n").unionByName(own)


@op("T2", "SELECT DISTINCT sample_index, concat_ws(',', 'completion_tokens=' || response_length, 'finish_reason=' || status, 'prompt_tokens=' || length(prompt)) AS kept FROM samples WHERE metadata IS NOT NULL")
def t2(spark, d):
    """Of a reply's meta data the whitelisted entries that are set, and the reason of its end; other entries, as ``turns``, are left out."""
    own = F.create_map(F.lit("prompt_tokens"), F.length("prompt").cast("string"), F.lit("completion_tokens"), F.col("response_length").cast("string"), F.lit("e2e_latency"), F.lit("1"))
    kept = tr.reply_attributes(F.map_concat("metadata", own), F.col("status"))
    text = F.array_join(F.array_sort(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return table(spark, d, "samples").where("metadata is not null").select("sample_index", text.alias("kept")).distinct()


_STACK = "CASE WHEN e.type = 'span_start' AND e.span_id IS NOT NULL THEN list_append(r.stack, e.span_id) WHEN e.type = 'span_end' AND list_contains(r.stack, e.span_id) THEN list_filter(r.stack, lambda v, p: p <> len(r.stack) + 1 - list_position(list_reverse(r.stack), e.span_id)) ELSE r.stack END"


@op("T3", f"WITH RECURSIVE {E}, r AS (SELECT trace, CAST(-1 AS BIGINT) AS ord, CAST([] AS BIGINT[]) AS stack, CAST(NULL AS BIGINT) AS inferred_parent FROM (SELECT DISTINCT trace FROM e) UNION ALL SELECT e.trace, e.ord, {_STACK}, r.stack[len(r.stack)] FROM r JOIN e ON e.trace = r.trace AND e.ord = r.ord + 1) SELECT trace, ord, inferred_parent FROM r WHERE ord >= 0")
def t3(spark, d):
    return tr.infer_parents(events(spark, d).select("trace", "ord", "type", "span_id")).select("trace", "ord", "inferred_parent")


@op("T4", f"WITH {E}, {P} SELECT trace, state, count(*) AS n, CAST(sum(coalesce(f - s, 0)) AS BIGINT) AS us FROM p GROUP BY 1, 2 UNION ALL SELECT trace, 'point_event', count(*), 0 FROM e WHERE type = 'event' GROUP BY 1")
def t4(spark, d):
    return spans(spark, d).groupBy("trace", "state").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col("end") - F.col("start"), F.lit(0))).alias("us"))


@op("T5", f"WITH RECURSIVE {E}, {P}, r AS (SELECT trace, span_id, 0 AS depth FROM p WHERE parent_id IS NULL UNION ALL SELECT p.trace, p.span_id, r.depth + 1 FROM p JOIN r ON p.trace = r.trace AND p.parent_id = r.span_id) SELECT trace, span_id, CAST(depth AS BIGINT) AS depth FROM r")
def t5(spark, d):
    s = spans(spark, d).where("state in ('closed_span', 'open_span')").select("trace", "span_id", "parent_id")
    return tr.depths(s)


@op("T6", f"""WITH RECURSIVE {E}, {P}, b AS (SELECT trace, max(us) AS row_end FROM e GROUP BY 1),
 a AS (SELECT trace, span_id, parent_id AS cur, CAST(NULL AS BIGINT) AS f FROM p WHERE state = 'open_span' UNION ALL SELECT a.trace, a.span_id, CASE WHEN p.f IS NULL THEN p.parent_id END, p.f FROM a JOIN p ON a.trace = p.trace AND a.cur = p.span_id),
 c AS (SELECT trace, span_id, max(f) AS anc FROM a GROUP BY 1, 2),
 g AS (SELECT x.trace, x.span_id, x.s, row_end, (SELECT min(y.s) FROM p y WHERE y.trace = x.trace AND y.parent_id IS NOT DISTINCT FROM x.parent_id AND y.s > x.s) AS sib, CASE WHEN anc > x.s THEN anc END AS anc FROM p x JOIN b ON x.trace = b.trace JOIN c ON c.trace = x.trace AND c.span_id = x.span_id WHERE state = 'open_span'),
 l AS (SELECT *, least(row_end, sib, anc) AS first FROM g)
 SELECT trace, span_id, greatest(first, s) AS shown_end, CASE WHEN first <= s THEN 'self' WHEN first = row_end THEN 'row_end' WHEN first = sib THEN 'next_sibling_start' ELSE 'ancestor_end' END AS clipped_by FROM l""")
def t6(spark, d):
    return tr.close_open(spans(spark, d))


@op("T7", f"WITH {E}, {P} SELECT trace, role, count(*) AS lanes, round(sum(v), 4) AS total FROM (SELECT p.trace, unnest([{{'role': 'prefill', 'v': e.value - 20}}, {{'role': 'decode', 'v': 20 - e.value}}], recursive := true) FROM p JOIN e ON p.trace = e.trace AND p.span_id = e.span_id AND e.type = 'span_end' WHERE state = 'closed_span') WHERE v > 0 GROUP BY 1, 2")
def t7(spark, d):
    """Virtual lanes of closed spans: one for each role with a positive duration among the attributes of its end."""
    ends = events(spark, d).where("type = 'span_end'").select("trace", "span_id", F.create_map(F.lit("prefill"), F.col("value") - 20, F.lit("decode"), 20 - F.col("value")).alias("attrs"))
    closed = spans(spark, d).where("state = 'closed_span'").select("trace", "span_id")
    lanes = closed.join(ends, ["trace", "span_id"]).select("trace", F.explode(F.map_filter("attrs", lambda k, v: v > 0)).alias("role", "v"))
    return lanes.groupBy("trace", "role").agg(F.count(F.lit(1)).alias("lanes"), F.round(F.sum("v"), 4).alias("total"))


@op("T8", f"WITH {E}, {P}, i AS (SELECT trace, s, coalesce(f, s) AS f, state FROM p UNION ALL SELECT trace, us, us, 'point_event' FROM e WHERE type = 'event') SELECT trace, min(s) AS start, max(f) AS finish, max(f) - min(s) AS duration, count(*) AS items, count(*) FILTER (state = 'closed_span') AS closed, count(*) FILTER (state = 'open_span') AS opened, count(*) FILTER (state = 'point_event') AS points FROM i GROUP BY 1")
def t8(spark, d):
    def n(state):
        return F.count(F.when(F.col("state") == state, 1))

    end = F.coalesce("end", "start")
    return spans(spark, d).groupBy("trace").agg(F.min("start").alias("start"), F.max(end).alias("finish"), (F.max(end) - F.min("start")).alias("duration"), F.count(F.lit(1)).alias("items"), n("closed_span").alias("closed"), n("open_span").alias("opened"), n("point_event").alias("points"))


@op("T9", f"WITH {E} SELECT min(us) AS start, max(us) AS finish, count(DISTINCT trace) AS traces FROM e")
def t9(spark, d):
    return events(spark, d).agg(F.min("ts").alias("start"), F.max("ts").alias("finish"), F.count_distinct("trace").alias("traces"))


_NAMES = ["ncclKernel_AllReduce", "deep_ep_dispatch", "deep_ep_combine", "flash_fwd_attn", "nvjet_hsh", "cutlass_gemm", "topk_transform", "per_token_quant", "rmsnorm_fwd", "triton_poi", "vectorized_elementwise", "softmax_reduce", "embedding_bag", "memcpy_dtod", "index_select", "batched_cat", "cudaGraphLaunch", "aten::copy_", "other"]
_KERNEL = f"{_NAMES}[event_id % {len(_NAMES)} + 1]"
_CLASS = "CASE " + " ".join(f"WHEN {(' AND ' if how == 'all' else ' OR ').join(f'contains(lower(name), {chr(39)}{w}{chr(39)})' for w in words)} THEN '{label}'" for how, words, label in tr.KERNELS) + " ELSE 'Other Compute' END"
K = f"k AS (SELECT event_id, user_id AS rank, event_type AS stream, epoch_us(ts) AS s, epoch_us(ts) + CAST(floor(value * 60000000) AS BIGINT) AS f, CAST(floor(value * 60000000) AS BIGINT) AS dur, {_KERNEL} AS name FROM events)"
MI = "i AS (SELECT rank, s, f, CASE WHEN s > coalesce(max(f) OVER (PARTITION BY rank ORDER BY s, f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS fresh FROM k), j AS (SELECT rank, s, f, sum(fresh) OVER (PARTITION BY rank ORDER BY s, f ROWS UNBOUNDED PRECEDING) AS island FROM i), m AS (SELECT rank, min(s) AS s, max(f) AS f FROM j GROUP BY rank, island)"
G = "g AS (SELECT * FROM (SELECT rank, f AS gap_start, lead(s) OVER (PARTITION BY rank ORDER BY s) AS gap_end FROM m) WHERE gap_end > gap_start), h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY gap_end - gap_start DESC, gap_start) AS rn FROM g) WHERE rn <= 15)"


def kernels(spark, d):
    """Events as kernel launches: a user is a rank, an event type a stream."""
    e = table(spark, d, "events")
    dur, s = F.floor(F.col("value") * 60000000).cast("long"), F.unix_micros(F.col("ts").cast("timestamp"))
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("event_id") % len(_NAMES) + 1).cast("int"))
    return e.select("event_id", F.col("user_id").alias("rank"), F.col("event_type").alias("stream"), s.alias("s"), (s + dur).alias("f"), dur.alias("dur"), name.alias("name"))


def busy(spark, d):
    return tr.merge_intervals(kernels(spark, d).select("rank", "s", "f"), ["rank"], "s", "f")


def idle(spark, d):
    return tr.gaps(busy(spark, d), ["rank"], "s", "f")


@op("T10", f"WITH {K} SELECT event_id, {_CLASS} AS label FROM k")
def t10(spark, d):
    return kernels(spark, d).select("event_id", tr.kernel_class(F.col("name")).alias("label"))


@op("T11", f"WITH {K} SELECT name, {_CLASS} AS label, count(*) AS n, CAST(sum(dur) AS BIGINT) AS total, round(avg(dur), 4) AS mean FROM k GROUP BY name ORDER BY total DESC, name LIMIT 30")
def t11(spark, d):
    g = kernels(spark, d).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("dur").alias("total"), F.round(F.avg("dur"), 4).alias("mean"))
    return g.withColumn("label", tr.kernel_class(F.col("name"))).orderBy(F.desc("total"), "name").limit(30)


@op("T12", f"WITH {K}, {MI} SELECT rank, CAST(sum(f - s) AS BIGINT) AS busy, max(f) - min(s) AS span, round(100.0 * sum(f - s) / (max(f) - min(s)), 4) AS util FROM m GROUP BY rank")
def t12(spark, d):
    b, span = F.sum(F.col("f") - F.col("s")), F.max("f") - F.min("s")
    return busy(spark, d).groupBy("rank").agg(b.alias("busy"), span.alias("span"), F.round(100.0 * b / span, 4).alias("util"))


@op("T13", f"WITH {K}, {MI}, {G} SELECT rank, gap_start, gap_end FROM h")
def t13(spark, d):
    return tr.top(idle(spark, d), ["rank"], [F.desc(F.col("gap_end") - F.col("gap_start")), F.col("gap_start")], 15)


@op("T14", f"WITH {K}, {MI}, {G} SELECT h.rank, gap_start, coalesce(arg_min(o.name, o.event_id), 'unknown') AS cause FROM h LEFT JOIN k o ON o.rank = h.rank + 1 AND o.s < gap_end AND o.f > gap_start GROUP BY 1, 2")
def t14(spark, d):
    """The first operation, by its place in the file, that overlaps a gap; the next user's events stand for host operations."""
    g, o = t13(spark, d).alias("g"), kernels(spark, d).alias("o")
    hit = g.join(o, (F.col("o.rank") == F.col("g.rank") + 1) & (F.col("o.s") < F.col("g.gap_end")) & (F.col("o.f") > F.col("g.gap_start")), "left")
    return hit.groupBy("g.rank", "g.gap_start").agg(F.coalesce(F.min_by("o.name", "o.event_id"), F.lit("unknown")).alias("cause"))


@op("T15", f"WITH {K} SELECT rank, stream, count(*) AS n, CAST(sum(dur) AS BIGINT) AS total, max(f) - min(s) AS span, CASE WHEN max(f) > min(s) THEN round(100.0 * sum(dur) / (max(f) - min(s)), 4) ELSE 0 END AS util FROM k GROUP BY 1, 2")
def t15(spark, d):
    span = F.max("f") - F.min("s")
    return kernels(spark, d).groupBy("rank", "stream").agg(F.count(F.lit(1)).alias("n"), F.sum("dur").alias("total"), span.alias("span"), F.when(span > 0, F.round(100.0 * F.sum("dur") / span, 4)).otherwise(0.0).alias("util"))


@op("T16", f"WITH {K}, l AS (SELECT rank, s, f, (row_number() OVER (PARTITION BY rank ORDER BY s, event_id) - 1) // 3 AS step FROM k WHERE name = 'cudaGraphLaunch') SELECT rank, step, arg_max(f, s) - min(s) AS span FROM l GROUP BY 1, 2 HAVING count(*) = 3")
def t16(spark, d):
    """Three launches make a decode step; a rest is left out."""
    w = Window.partitionBy("rank").orderBy("s", "event_id")
    x = kernels(spark, d).where("name = 'cudaGraphLaunch'").withColumn("step", F.floor((F.row_number().over(w) - 1) / 3))
    return x.groupBy("rank", "step").agg((F.max_by("f", "s") - F.min("s")).alias("span"), F.count(F.lit(1)).alias("n")).where("n = 3").drop("n")


@op("T17", f"WITH {K} SELECT rank, CAST(sum(dur) FILTER (contains(lower(name), 'nccl')) AS BIGINT) AS nccl, CAST(sum(dur) FILTER (contains(name, 'deep_ep')) AS BIGINT) AS deep_ep, CAST(sum(dur) FILTER (name = 'aten::copy_') AS BIGINT) AS copies FROM k GROUP BY 1")
def t17(spark, d):
    def part(c):
        return F.sum(F.when(c, F.col("dur")))

    n = F.col("name")
    return kernels(spark, d).groupBy("rank").agg(part(F.lower(n).contains("nccl")).alias("nccl"), part(n.contains("deep_ep")).alias("deep_ep"), part(n == "aten::copy_").alias("copies"))


@op("T18", f"WITH {K} SELECT CASE WHEN dur < 60000000 THEN '<1m' WHEN dur < 300000000 THEN '1-5m' ELSE '>=5m' END AS bucket, count(*) AS n, CAST(sum(dur) AS BIGINT) AS total FROM k GROUP BY 1")
def t18(spark, d):
    b = F.when(F.col("dur") < 60_000_000, "<1m").when(F.col("dur") < 300_000_000, "1-5m").otherwise(">=5m")
    return kernels(spark, d).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("dur").alias("total"))


@op("T19", f"""WITH {K}, {MI}, u AS (SELECT rank, 100.0 * sum(f - s) / (max(f) - min(s)) AS util FROM m GROUP BY rank), l AS (SELECT *, {_CLASS} AS label, name NOT IN ('cudaGraphLaunch', 'aten::copy_') AS dev FROM k),
 c AS (SELECT rank, sum(CASE WHEN dev THEN dur ELSE 0 END) AS total, count(*) FILTER (name = 'cudaGraphLaunch' AND dur >= 5000) AS launches, sum(CASE WHEN dev AND label = 'DeepEP Dispatch (MoE)' THEN dur ELSE 0 END) AS dispatch, sum(CASE WHEN dev AND label = 'TopK / MoE Routing' THEN dur ELSE 0 END) AS routing, sum(CASE WHEN name = 'aten::copy_' THEN dur ELSE 0 END) AS copies FROM l GROUP BY rank),
 y AS (SELECT rank, count(*) FILTER (mean < 3) AS tiny FROM (SELECT rank, name, avg(dur) AS mean, row_number() OVER (PARTITION BY rank ORDER BY sum(dur) DESC, name) AS rn FROM l WHERE dev GROUP BY rank, name) WHERE rn <= 30 GROUP BY rank)
 SELECT rank, 'utilization' AS issue, CASE WHEN util < 80 THEN 'high' ELSE 'medium' END AS severity FROM u WHERE util < 90 UNION ALL SELECT rank, 'launch_stalls', 'high' FROM c WHERE launches > 0 UNION ALL SELECT rank, 'dispatch', 'high' FROM c WHERE dispatch / total > 0.15 UNION ALL SELECT rank, 'routing', 'medium' FROM c WHERE routing / total > 0.05
 UNION ALL SELECT rank, 'copies', 'medium' FROM c WHERE copies > 100000 UNION ALL SELECT rank, 'tiny_kernels', 'low' FROM y WHERE tiny > 5""")
def t19(spark, d):
    b, span = F.sum(F.col("f") - F.col("s")), F.max("f") - F.min("s")
    util = busy(spark, d).groupBy("rank").agg((100.0 * b / span).alias("util"))
    k = kernels(spark, d).select("rank", "name", tr.kernel_class(F.col("name")).alias("label"), "dur")
    return tr.bottlenecks(k, util, "rank")


@op("T20", f"WITH {K}, {MI}, u AS (SELECT rank, 100.0 * sum(f - s) / (max(f) - min(s)) AS util FROM m GROUP BY rank) SELECT round(max(util) - min(util), 4) AS spread, max(util) - min(util) > 5 AS imbalanced FROM u")
def t20(spark, d):
    b, span = F.sum(F.col("f") - F.col("s")), F.max("f") - F.min("s")
    u = busy(spark, d).groupBy("rank").agg((100.0 * b / span).alias("util"))
    x = F.max("util") - F.min("util")
    return u.agg(F.round(x, 4).alias("spread"), (x > 5).alias("imbalanced"))


RR = "rr AS (SELECT DISTINCT result_id, run_id, ok, status_code, latency_ms, stream FROM replay_results)"


def results(spark, d):
    return table(spark, d, "replay_results").select("result_id", "run_id", "ok", "status_code", "latency_ms", "stream").distinct()


@op("T21", f"WITH {RR} SELECT run_id, round(quantile_cont(latency_ms, 0.5), 5) AS p50, round(quantile_cont(latency_ms, 0.95), 5) AS p95, round(quantile_cont(latency_ms, 0.99), 5) AS p99 FROM rr GROUP BY 1")
def t21(spark, d):
    """Exact percentiles with linear interpolation; a run of any size is ranked over ranges of its values."""
    x = exact_percentiles(results(spark, d), "run_id", "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return x.select("run_id", *[F.round(p, 5).alias(p) for p in ("p50", "p95", "p99")])


@op("T22", f"WITH {RR} SELECT run_id, count(*) AS completed, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (stream) AS streams, count(*) FILTER (status_code IS NULL) AS no_status, count(*) FILTER (status_code = 200) AS ok_200, round(quantile_cont(latency_ms, 0.5), 5) AS p50 FROM rr GROUP BY 1")
def t22(spark, d):
    def n(c):
        return F.count(F.when(c, 1))

    return results(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("completed"), n(F.col("ok")).alias("succeeded"), n(~F.col("ok")).alias("failed"), n(F.col("stream")).alias("streams"), n(F.col("status_code").isNull()).alias("no_status"), n(F.col("status_code") == 200).alias("ok_200"), F.round(F.percentile("latency_ms", 0.5), 5).alias("p50"))


@op("T23", "SELECT prompt_id, array_to_string(list_transform(list_filter(messages, lambda m: m.content IS NOT NULL), lambda m: m.content), '') AS stitched FROM prompts WHERE messages IS NOT NULL")
def t23(spark, d):
    """Pieces of a streamed reply, joined in their order."""
    piece = table(spark, d, "prompts").where("messages is not null").select("prompt_id", F.posexplode("messages.content").alias("pos", "text")).where("text is not null")
    parts = F.sort_array(F.collect_list(F.struct("pos", "text")))
    return piece.groupBy("prompt_id").agg(F.array_join(F.transform(parts, lambda s: s["text"]), "").alias("stitched"))


# ---- retrieval ----------------------------------------------------------------------------------------------------
@op("J1", "SELECT query_id, vec_id, round(score, 5) AS score, CAST(rn AS INT) AS rank FROM (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) DESC, v.vec_id) AS rn FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0) WHERE rn <= 5")
def j1(spark, d):
    v = table(spark, d, "embeddings")
    x = rt.dense_top_k(v, v.where("vec_id % 50 = 0"), 5)
    return x.select("query_id", "vec_id", F.round("score", 5).alias("score"), F.col("rank").cast("int").alias("rank"))


@op("J2", """WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents WHERE text IS NOT NULL), l AS (SELECT count(*) AS n, avg(len(t)) AS av FROM d),
 q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(prompt), '[a-z0-9]+')) AS term FROM eval_items), p AS (SELECT doc_id, any_value(ln) AS ln, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS ln, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
 f AS (SELECT term, count(*) AS df FROM p GROUP BY term), s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 1.9 / (tf + 0.9 * (1 - 0.4 + 0.4 * p.ln / av))), 6) AS score FROM q JOIN p ON q.term = p.term JOIN f ON f.term = p.term, l GROUP BY 1, 2)
 SELECT query_id, doc_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rn FROM s) WHERE rn <= 3""")
def j2(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    q = table(spark, d, "eval_items").select(F.col("item_id").alias("query_id"), F.col("prompt").alias("text"))
    return rt.bm25_top_k(docs, q, 3)


@op("J3", """WITH x AS (SELECT label, vec_id, vec_id % 2 AS mask, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
 SELECT label, CAST(i AS BIGINT) AS i, round(sum(v * mask) / greatest(sum(mask), 1e-9), 5) AS mean, round(arg_min(v, vec_id), 5) AS cls, round(arg_min(v, vec_id) + 1, 5) AS pooler FROM x GROUP BY label, i""")
def j3(spark, d):
    """Pooled vectors of sequences of token vectors: a label's vectors are its tokens, odd ids have mask 1; the model's own pooled output is a column."""
    e = table(spark, d, "embeddings").select("label", "vec_id", (F.col("vec_id") % 2).alias("mask"), F.col("embedding").cast("array<double>").alias("vec"))
    own = e.groupBy("label").agg(F.transform(F.min_by("vec", "vec_id"), lambda v: v + 1).alias("vec"))
    kinds = {k: rt.pool(e, "label", "vec_id", "vec", k, "mask", own).select("label", F.posexplode("pooled").alias("i", k)) for k in ("mean", "cls", "pooler")}
    x = kinds["mean"].join(kinds["cls"], ["label", "i"]).join(kinds["pooler"], ["label", "i"])
    return x.select("label", F.col("i").cast("long").alias("i"), *[F.round(k, 5).alias(k) for k in kinds])


@op("J4", "SELECT s.sample_index, p.prompt_id, p.data_source FROM (SELECT DISTINCT sample_index, prompt_id FROM samples) s JOIN prompts p ON s.prompt_id = p.prompt_id")
def j4(spark, d):
    s = table(spark, d, "samples").select("sample_index", "prompt_id").distinct()
    return s.join(table(spark, d, "prompts").select("prompt_id", "data_source"), "prompt_id")


@op("J5", "SELECT item_id, 'query: ' || prompt AS e5, 'Represent this sentence for searching relevant passages: ' || prompt AS bge FROM eval_items")
def j5(spark, d):
    return table(spark, d, "eval_items").select("item_id", F.concat(F.lit("query: "), "prompt").alias("e5"), F.concat(F.lit("Represent this sentence for searching relevant passages: "), "prompt").alias("bge"))


@op("J6", "SELECT DISTINCT a.sample_index, a.reward, b.response_length FROM samples a JOIN samples b ON a.sample_index = b.sample_index")
def j6(spark, d):
    """Columns of equal position, joined on the row id."""
    s = table(spark, d, "samples")
    return s.select("sample_index", "reward").distinct().join(s.select("sample_index", "response_length").distinct(), "sample_index")


@op("J7", "SELECT doc_id, doc_id % 2 = 0 AS scored, CASE WHEN doc_id % 2 = 0 THEN n_chars END AS score, text AS document FROM documents")
def j7(spark, d):
    """Replies with a score have {document, score}, others the document alone."""
    hit = F.when(F.col("doc_id") % 2 == 0, F.struct(F.col("text").alias("document"), F.col("n_chars").alias("score")))
    x = table(spark, d, "documents").select("doc_id", "text", hit.alias("hit"))
    return x.select("doc_id", F.col("hit").isNotNull().alias("scored"), F.col("hit.score").alias("score"), F.coalesce("hit.document", "text").alias("document"))


@op("J8", f"WITH {K}, {MI}, {G} SELECT h.rank, count(*) AS overlaps FROM h JOIN k o ON o.rank = h.rank + 1 AND o.s < gap_end AND o.f > gap_start GROUP BY 1")
def j8(spark, d):
    g, o = t13(spark, d).alias("g"), kernels(spark, d).alias("o")
    return g.join(o, (F.col("o.rank") == F.col("g.rank") + 1) & (F.col("o.s") < F.col("g.gap_end")) & (F.col("o.f") > F.col("g.gap_start"))).groupBy("g.rank").agg(F.count(F.lit(1)).alias("overlaps"))


@op("J9", f"WITH {E}, {P} SELECT c.trace, c.span_id, q.name AS parent_name FROM p c JOIN p q ON c.trace = q.trace AND c.parent_id = q.span_id")
def j9(spark, d):
    s = spans(spark, d).where("state in ('closed_span', 'open_span')")
    parent = s.select("trace", F.col("span_id").alias("parent_id"), F.col("name").alias("parent_name"))
    return s.select("trace", "span_id", "parent_id").join(parent, ["trace", "parent_id"]).select("trace", "span_id", "parent_name")


@op("J10", "SELECT DISTINCT a.sample_index, a.reward AS actor, coalesce(b.response_length, 0) AS critic FROM samples a JOIN samples b ON a.sample_index = b.sample_index AND a.group_index = b.group_index")
def j10(spark, d):
    s = table(spark, d, "samples")
    return s.select("sample_index", "group_index", F.col("reward").alias("actor")).distinct().join(s.select("sample_index", "group_index", F.coalesce("response_length", F.lit(0)).alias("critic")).distinct(), ["sample_index", "group_index"]).drop("group_index")


@op("O1", "SELECT group_index, min(sample_index) AS first_index FROM samples GROUP BY 1 ORDER BY 2")
def o1(spark, d):
    return table(spark, d, "samples").groupBy("group_index").agg(F.min("sample_index").alias("first_index")).orderBy("first_index")


@op("O2", f"WITH {E}, {P} SELECT trace, span_id, s AS start, name FROM p ORDER BY trace, s, f, name")
def o2(spark, d):
    return spans(spark, d).where("state in ('closed_span', 'open_span')").orderBy("trace", "start", "end", "name").select("trace", "span_id", "start", "name")


@op("O3", "SELECT 'prompt' AS kind, prompt_id AS id FROM prompts UNION ALL SELECT 'item', item_id FROM eval_items")
def o3(spark, d):
    a = table(spark, d, "prompts").select(F.lit("prompt").alias("kind"), F.col("prompt_id").alias("id"))
    return a.unionByName(table(spark, d, "eval_items").select(F.lit("item").alias("kind"), F.col("item_id").alias("id")))

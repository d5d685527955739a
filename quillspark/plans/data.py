"""Queries of sources, sinks, balancing, masks, streaming and hooks (S*, K*, R*, W*, X*, H*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions import masks as mk
from quillspark.functions import tokens as tk
from quillspark.operators import balance as bl
from quillspark.operators.groups import normalize, pass_rates, reward_filter
from quillspark.operators.ordering import previous, row_index, scratch
from quillspark.plans.groups import S, samples, sql
from quillspark.plans.registry import Hooks, op, table
from quillspark.plans.tokens import r6
from quillspark.sources import configs, pull, readers, sinks
from quillspark.streaming import buffer as bf
from quillspark.streaming.health import health_events
from quillspark.streaming.store import GroupStore, collect_and_recycle, poll


def shared(spark, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{scratch(spark, name)}/data"


# ---- sources ------------------------------------------------------------------------------------------------------
@op("S1", "SELECT prompt_id, prompt FROM prompts WHERE prompt IS NOT NULL")
def s1(spark, d):
    """JSON lines with blank and broken ones between them: those are skipped."""
    p = table(spark, d, "prompts").where("prompt is not null")
    lines = p.select(F.to_json(F.struct("prompt_id", "prompt")).alias("value"))
    noise = p.select(F.when(F.col("prompt_id") % 2 == 0, "  ").otherwise('{"prompt_id": ').alias("value"))
    return readers.parse_lines(lines.unionByName(noise), "prompt_id bigint, prompt string")[0]


@op("S2", "SELECT doc_id, n_chars FROM documents")
def s2(spark, d):
    return readers.read_rows(spark, f"{d}/documents.parquet").select("doc_id", "n_chars")


@op("S3", "SELECT count(*) AS n FROM eval_items")
def s3(spark, d):
    """The format follows the suffix; an unknown one is an error."""
    return readers.read_rows(spark, f"{d}/eval_items.parquet").agg(F.count(F.lit(1)).alias("n"))


@op("S4", "SELECT item_id FROM eval_items ORDER BY item_id LIMIT 40 OFFSET 10")
def s4(spark, d):
    return readers.read_rows(spark, f"{d}/eval_items.parquet@[10:50]", order=["item_id"]).select("item_id")


@op("S5", """WITH x AS (SELECT prompt_id, CASE WHEN prompt IS NOT NULL THEN prompt ELSE array_to_string(list_transform(messages, lambda m: '<|im_start|>' || m.role || chr(10) || coalesce(m.content, '') || '<|im_end|>' || chr(10)), '') || '<|im_start|>assistant' || chr(10) END AS text, prompt IS NOT NULL AS plain, label, coalesce(metadata, '{}') AS metadata, data_source FROM prompts WHERE prompt IS NOT NULL OR messages IS NOT NULL)
 SELECT prompt_id, text, label, metadata, CASE WHEN data_source IS NULL THEN NULL ELSE 2 END AS tools FROM x WHERE NOT plain OR length(text) <= 400""")
def s5(spark, d):
    """The whole dataset step: conversations under a template with the header of a reply, meta data by default empty, tools parsed, long texts dropped."""
    p = table(spark, d, "prompts").withColumn("tools", F.when(F.col("data_source").isNotNull(), F.concat(F.lit('["search", "'), "data_source", F.lit('"]'))))
    x = readers.build_dataset(p, "prompt", "messages", template=lambda m: F.concat(mk.render(m), F.lit(mk.HEADER)), tools="tools", max_length=400)
    return x.select("prompt_id", "text", "label", "metadata", F.when(F.col("tools").isNotNull(), F.size("tools")).alias("tools"))


@op("S6", "SELECT prompt_id, 2 AS tools FROM prompts")
def s6(spark, d):
    tools = F.concat(F.lit('["search", "'), F.col("prompt_id").cast("string"), F.lit('"]'))
    return table(spark, d, "prompts").select("prompt_id", F.size(readers.tool_list(tools)).alias("tools"))


@op("S7", "SELECT prompt_id, coalesce(len(messages), 1) AS turns, coalesce(messages[1].role, 'user') AS first_role FROM prompts WHERE prompt IS NOT NULL OR messages IS NOT NULL")
def s7(spark, d):
    m = readers.as_messages(F.col("prompt"), F.col("messages"))
    return table(spark, d, "prompts").where("prompt is not null or messages is not null").select("prompt_id", F.size(m).cast("long").alias("turns"), F.element_at(m, 1)["role"].alias("first_role"))


@op("S8", "SELECT item_id, 0 AS pos, 'text' AS kind, 'look ' AS value FROM eval_items UNION ALL SELECT item_id, 1, 'image', path FROM eval_items UNION ALL SELECT item_id, 2, 'text', ' and ' FROM eval_items UNION ALL SELECT item_id, 3, 'video', CAST(row_no AS VARCHAR) FROM eval_items")
def s8(spark, d):
    x = table(spark, d, "eval_items").select("item_id", F.lit("look <image> and <video>").alias("text"), F.array("path", F.col("row_no").cast("string")).alias("media"))
    return readers.interleave(x, "item_id", "text", "media")


@op("S9", "SELECT prompt_id, array_to_string(list_transform(messages, lambda m: '<|im_start|>' || m.role || chr(10) || coalesce(m.content, '') || '<|im_end|>' || chr(10)), '') AS text FROM prompts WHERE messages IS NOT NULL")
def s9(spark, d):
    return table(spark, d, "prompts").where("messages is not null").select("prompt_id", mk.render(F.col("messages")).alias("text"))


@op("S10", "SELECT ds_name, n_samples_per_eval_prompt AS n, temperature, top_p FROM eval_datasets")
def s10(spark, d):
    """Dataset, defaults, arguments, in this order; an explicit null stays null."""
    rows = [r.asDict() for r in configs.table_rows(table(spark, d, "eval_datasets"), "ds_name")]
    defaults, args = {"top_p": 0.7}, {"temperature": 1.0, "n_samples_per_eval_prompt": 1}
    out = [(r["ds_name"], *(configs.resolve(f, r, defaults, args) for f in ("n_samples_per_eval_prompt", "temperature", "top_p"))) for r in rows]
    return spark.createDataFrame(out, "ds_name string, n int, temperature double, top_p double")


@op("S11", "SELECT ds_name AS name, path FROM eval_datasets")
def s11(spark, d):
    rows = {r["ds_name"]: {"path": r["path"]} for r in configs.table_rows(table(spark, d, "eval_datasets"), "ds_name")}
    return spark.createDataFrame([(c["name"], c["path"]) for c in configs.dataset_list(rows)], "name string, path string")


@op("S12", "SELECT item_id, coalesce(rm_type, 'own') AS rm_type, CASE WHEN item_id % 2 = 0 THEN 'over' ELSE 'row' END AS origin, path FROM eval_items i JOIN (SELECT path, max(rm_type) AS rm_type FROM eval_datasets GROUP BY path) USING (path)")
def s12(spark, d):
    """Row meta data, then the dataset's scorer, then overrides; the last wins, in the engine and for one row on the driver alike."""
    types = table(spark, d, "eval_datasets").groupBy("path").agg(F.max("rm_type").alias("rm_type"))
    own = F.create_map(F.lit("rm_type"), F.lit("own"), F.lit("origin"), F.lit("row"), F.lit("path"), F.col("path"))
    over = F.when(F.col("item_id") % 2 == 0, F.create_map(F.lit("origin"), F.lit("over")))
    x = table(spark, d, "eval_items").join(types, "path").select("item_id", configs.merged_column(own, F.col("rm_type"), over).alias("m"))
    return x.select("item_id", *[F.col("m")[k].alias(k) for k in ("rm_type", "origin", "path")])


@op("S13", "SELECT 'aime' AS name, '/data/a.jsonl' AS path UNION ALL SELECT 'x', 'p' UNION ALL SELECT 'y', 'q'")
def s13(spark, d):
    rows = configs.pairs(["/data/a.jsonl"]) + configs.pairs(["x", "p", "y", "q"])
    return spark.createDataFrame([(r["name"], r["path"]) for r in rows], "name string, path string")


@op("S14", "SELECT prompt_id FROM (SELECT prompt_id, row_number() OVER (ORDER BY prompt_id) - 1 AS rn, count(*) OVER () AS n FROM prompts) WHERE rn < CAST(floor(n * 0.15) AS BIGINT) // 2 OR rn >= n - (CAST(floor(n * 0.15) AS BIGINT) + 1) // 2")
def s14(spark, d):
    return readers.head_and_tail(table(spark, d, "prompts").select("prompt_id"), 0.15, "prompt_id")


@op("S15", "SELECT prompt_id, messages[1].content AS prompt, label AS ground_truth FROM prompts WHERE messages IS NOT NULL")
def s15(spark, d):
    x = table(spark, d, "prompts").where("messages is not null").select("prompt_id", "messages", F.struct(F.col("label").alias("ground_truth")).alias("reward_model"))
    return x.select("prompt_id", F.element_at("messages", 1)["content"].alias("prompt"), F.col("reward_model.ground_truth").alias("ground_truth"))


@op("S16", "SELECT prompt_id, array_to_string(list_transform(messages, lambda m: m.role), ',') AS roles FROM prompts WHERE messages IS NOT NULL")
def s16(spark, d):
    """Turns with allowed roles; any other role is an error."""
    ok = F.forall("messages", lambda m: m["role"].isin("system", "user", "assistant", "tool"))
    roles = F.array_join(F.transform("messages", lambda m: m["role"]), ",")
    return table(spark, d, "prompts").where("messages is not null").select("prompt_id", F.when(ok, roles).otherwise(F.raise_error(F.lit("unknown role"))).alias("roles"))


@op("S17", "SELECT ds_name AS env, path AS split, row_no AS task FROM eval_items JOIN eval_datasets USING (path)")
def s17(spark, d):
    """Tasks of each environment and split, written as JSON lines in one directory each and read again."""
    path = shared(spark, "tasks")
    x = table(spark, d, "eval_items").join(table(spark, d, "eval_datasets").select("ds_name", "path"), "path").select(F.col("ds_name").alias("env"), F.col("path").alias("split"), F.col("row_no").alias("task"))
    x.write.partitionBy("env").json(path)
    return spark.read.schema("split string, task int, env string").json(path).select("env", "split", "task")


@op("S18", "SELECT prompt_id, prompt_id % 3 <> 0 AS accepted FROM prompts")
def s18(spark, d):
    """Pulled items need all keys; others are rejected."""
    full = F.to_json(F.struct(F.col("prompt_id").cast("string").alias("uid"), F.lit("i").alias("instance_id"), F.array(F.lit("m")).alias("messages"), F.lit(1.0).alias("reward"), F.struct(F.lit(1).alias("t")).alias("extra_info")))
    part = F.to_json(F.struct(F.col("prompt_id").cast("string").alias("uid")))
    good, bad = pull.checked(table(spark, d, "prompts").select("prompt_id", F.when(F.col("prompt_id") % 3 != 0, full).otherwise(part).alias("item")))
    return good.select("prompt_id", F.lit(True).alias("accepted")).unionByName(bad.select("prompt_id", F.lit(False).alias("accepted")))


@op("S19", """WITH l AS (SELECT row_number() OVER (ORDER BY prompt_id) AS line_number, CASE WHEN prompt_id % 11 = 0 THEN '  ' ELSE coalesce(metadata, '[1]') END AS line FROM prompts), b AS (SELECT *, row_number() OVER (ORDER BY line_number) - 1 AS p, count(*) OVER () AS n FROM l WHERE trim(line) <> ''), r AS (SELECT *, unnest([1, 2]) AS replay_round FROM b)
 SELECT replay_round, line_number, CASE WHEN NOT json_valid(line) THEN 'Invalid JSON' WHEN json_type(TRY_CAST(line AS JSON)) <> 'OBJECT' THEN 'JSON line must be an object' END AS error FROM r WHERE (replay_round - 1) * n + p < 300""")
def s19(spark, d):
    """Request lines in two rounds, at most 300 of all; blank lines are skipped, broken ones become error rows and count as well."""
    p = row_index(table(spark, d, "prompts").select("prompt_id", F.when(F.col("prompt_id") % 11 == 0, "  ").otherwise(F.coalesce("metadata", F.lit("[1]"))).alias("line")), "prompt_id", name="line_number")
    x = readers.read_requests(p.withColumn("line_number", F.col("line_number") + 1), "line_number", "line", rounds=2, cap=300)
    return x.select("replay_round", "line_number", "error")


@op("S20", "SELECT event_id, event_type AS name, round(value, 4) AS dur FROM events")
def s20(spark, d):
    """Events of trace documents, each of one user and at most 1,000 events."""
    e = F.struct(F.lit("kernel").alias("cat"), F.lit("X").alias("ph"), F.col("event_type").alias("name"), F.col("event_id").cast("double").alias("ts"), F.col("value").alias("dur"), F.col("user_id").cast("string").alias("tid"))
    docs = table(spark, d, "events").groupBy("user_id", F.floor(F.col("event_id") / 1000)).agg(F.to_json(F.struct(F.collect_list(e).alias("traceEvents"))).alias("value"))
    return readers.trace_events(docs).select(F.col("ts").cast("long").alias("event_id"), "name", F.round("dur", 4).alias("dur"))


@op("S21", "SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM documents WHERE doc_id % 50 = 0)")
def s21(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.join(docs.where("doc_id % 50 = 0").select("doc_id"), "doc_id", "left_semi")


@op("S22", "SELECT doc_id, pos, CASE pos WHEN 0 THEN 'data' WHEN 1 THEN 'base64' ELSE 'file' END AS kind, CASE pos WHEN 0 THEN strlen(text) WHEN 1 THEN 20 END AS bytes FROM documents, (SELECT unnest([0, 1, 2]) AS pos) WHERE text <> ''")
def s22(spark, d):
    """Images of a conversation's parts, in order: a data address of the document's own bytes, bare base64, a file; text parts and parts without an image are none."""
    def part(kind, text, image):
        return F.struct(F.lit(kind).alias("type"), text.alias("text"), image.alias("image"))

    no = F.lit(None).cast("string")
    raw = F.base64(F.encode("text", "UTF-8"))
    first = F.array(part("text", F.lit("look"), no), part("image", no, F.concat(F.lit("data:image/png;base64,"), raw)), part("image", no, no))
    second = F.array(part("image", no, F.base64(F.lpad(F.col("doc_id").cast("string"), 20, "0").cast("binary"))), part("image", no, F.lit("img/a.png")), part("text", F.lit("b"), F.lit("img/b.png")))
    m = F.array(F.struct(F.lit("user").alias("role"), first.alias("content")), F.struct(F.lit("user").alias("role"), second.alias("content")))
    x = table(spark, d, "documents").where("text <> ''").select("doc_id", m.alias("messages"))
    i = readers.message_images(x, "doc_id", "messages")
    return i.select("doc_id", "pos", readers.image_kind(F.col("image")).alias("kind"), F.octet_length(readers.image_bytes(F.col("image"))).cast("long").alias("bytes"))


# ---- sinks --------------------------------------------------------------------------------------------------------
@op("K1", sql("SELECT 7 AS rollout_id, false AS is_eval, count(*) AS n FROM s UNION ALL SELECT 7, true, count(*) FROM s WHERE status = 'truncated'"))
def k1(spark, d):
    path, s = shared(spark, "dump"), samples(spark, d, "sample_index", "reward", "status")
    sinks.dump_rollout(s, path, 7)
    sinks.dump_rollout(s.where("status = 'truncated'"), path, 7, True)
    return spark.read.parquet(path).groupBy("rollout_id", F.col("is_eval").cast("boolean").alias("is_eval")).agg(F.count(F.lit(1)).alias("n"))


@op("K2", sql("SELECT sample_index % 4 AS rank, count(*) AS n FROM s GROUP BY 1"))
def k2(spark, d):
    path = shared(spark, "ranks")
    sinks.dump_ranks(samples(spark, d, "sample_index").withColumn("rollout_id", F.lit(1)).withColumn("rank", F.col("sample_index") % 4), path)
    return spark.read.parquet(path).groupBy(F.col("rank").cast("long").alias("rank")).agg(F.count(F.lit(1)).alias("n"))


@op("K3", "SELECT 1 AS epoch, 44 AS position, count(*) AS rows FROM prompts")
def k3(spark, d):
    """A cursor, saved and restored; none saved gives none."""
    path = shared(spark, "cursor")
    if sinks.load_cursor(spark, path) is not None:
        raise AssertionError("a new path holds no cursor")
    sinks.save_cursor(spark, path, epoch=1, position=44, rows=table(spark, d, "prompts").count())
    c = sinks.load_cursor(spark, path)
    return spark.createDataFrame([(c["epoch"], c["position"], c["rows"])], "epoch bigint, position bigint, rows bigint")


@op("K4", sql("SELECT 'rollout/' || coalesce(status, 'none') AS metric, CAST(count(*) AS DOUBLE) AS value, 3 AS step, 'rollout/step' AS step_key FROM s GROUP BY 1"))
def k4(spark, d):
    path = shared(spark, "metrics")
    m = samples(spark, d, "sample_index", "status").groupBy(F.concat(F.lit("rollout/"), F.coalesce("status", F.lit("none"))).alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    sinks.append_metrics(m, path, 3, "rollout/step")
    return spark.read.parquet(path)


@op("K5", "SELECT count(*) AS n FROM samples")
def k5(spark, d):
    """Batches of a stream, appended to the buffer's table."""
    path = shared(spark, "append")

    def add(batch, _):
        batch.write.mode("append").parquet(path)

    src = bf.file_stream(spark, f"{d}/samples.parquet").select("sample_index", "group_index")
    q = src.writeStream.foreachBatch(add).option("checkpointLocation", shared(spark, "offsets")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@op("K6", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def k6(spark, d):
    path, source = shared(spark, "timeline"), f"{d}/events.parquet"
    for _ in range(2):  # the second call reads what the first wrote
        out = sinks.cached(spark, source, path, lambda: table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))
    return out


@op("K7", "SELECT item_id, row_no FROM eval_items")
def k7(spark, d):
    path = shared(spark, "lines")
    sinks.write_lines(table(spark, d, "eval_items").select("item_id", "row_no"), path)
    return readers.parse_lines(spark.read.text(path), "item_id bigint, row_no int")[0]


# ---- balancing ----------------------------------------------------------------------------------------------------
def steps(spark, d):
    """Samples with lengths, in steps of 64 by index."""
    return samples(spark, d, "sample_index", "response_length").select("sample_index", F.floor(F.col("sample_index") / 64).cast("long").alias("step"), F.coalesce("response_length", F.lit(0)).cast("long").alias("len"))


_STEP = "x AS (SELECT sample_index, sample_index // 64 AS step, CAST(coalesce(response_length, 0) AS BIGINT) AS len FROM s)"


@op("R11", sql("SELECT step, count(*) AS n, count(*) // 4 AS each FROM x GROUP BY 1 HAVING count(*) % 4 = 0", _STEP))
def r11(spark, d):
    """Equal numbers of samples for four ranks."""
    w = Window.partitionBy("step")
    x = steps(spark, d).withColumn("n", F.count(F.lit(1)).over(w)).where("n % 4 = 0").select("sample_index", "step", "len")
    x = bl.per_group(x, ["step"], "sample_index", "len", lambda v: bl.balanced(v, 4, True))
    g = x.groupBy("step", "part").agg(F.count(F.lit(1)).alias("k")).groupBy("step").agg(F.sum("k").alias("n"), F.max("k").alias("each"), F.min("k").alias("least"))
    return g.where("each = least").select("step", "n", "each")


_FOLD = "i AS (SELECT step, sample_index, len, row_number() OVER (PARTITION BY step ORDER BY sample_index) AS k FROM x)"


def folded(start: str, update: str, part: str, out: str) -> str:
    """SQL of a fold over the items of each step: state, its update by an item of ``len``, and the item's part by the state before."""
    return (
        f"WITH RECURSIVE {S}, {_STEP}, {_FOLD}, r AS (SELECT step, 0 AS k, CAST(NULL AS BIGINT) AS sample_index, CAST(NULL AS BIGINT) AS len, {start} AS state, CAST(NULL AS BIGINT) AS part FROM (SELECT DISTINCT step FROM x)"
        f" UNION ALL SELECT i.step, i.k, i.sample_index, i.len, {update}, {part} FROM r JOIN i ON i.step = r.step AND i.k = r.k + 1) {out}"
    )


_LEAST = "list_position(r.state, list_min(r.state))"
_ROOM = "coalesce(list_filter(range(1, len(r.state) + 1), lambda p: r.state[p] >= i.len)[1], len(r.state) + 1)"


@op("R12")
def r12(spark, d):
    return bl.per_group(steps(spark, d), ["step"], "sample_index", "len", lambda v: bl.balanced(v, 8))


@op("R13", sql("SELECT step, sample_index, count(*) OVER w AS n, CAST(sum(len) OVER w AS BIGINT) AS total, CAST(8 AS BIGINT) AS parts, count(*) OVER w // 8 * 8 = count(*) OVER w AS equal FROM x WHERE step IN (SELECT step FROM x GROUP BY 1 HAVING count(*) >= 8) WINDOW w AS (PARTITION BY step)", _STEP))
def r13(spark, d):
    """Checked partitions of every step with enough samples, with equal numbers where the samples allow it: no partition is empty, and every sample comes back once."""
    w = Window.partitionBy("step")  # one step is one bounded batch
    x = steps(spark, d).withColumn("_n", F.count(F.lit(1)).over(w)).where("_n >= 8").drop("_n")

    def part(lengths):
        out = [0] * len(lengths)
        for p, items in enumerate(bl.checked_partitions(lengths, 8, len(lengths) % 8 == 0)):
            for i in items:
                out[i] = p
        return out

    y = bl.per_group(x, ["step"], "sample_index", "len", part)
    sizes = y.groupBy("step", "part").agg(F.count(F.lit(1)).alias("k")).groupBy("step").agg(F.count(F.lit(1)).alias("parts"), (F.min("k") == F.max("k")).alias("same"))
    n, total = F.count(F.lit(1)).over(w), F.sum("len").over(w)
    z = y.select("step", "sample_index", n.alias("n"), total.alias("total")).join(sizes, "step")
    return z.select("step", "sample_index", "n", "total", "parts", (F.col("same") & (F.col("n") % 8 == 0)).alias("equal"))


@op("R14", folded("[CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]", f"list_transform(r.state, lambda v, p: v + CASE WHEN p = {_LEAST} THEN i.len ELSE 0 END)", f"{_LEAST} - 1", "SELECT step, sample_index, len, CAST(part AS INT) AS part FROM r WHERE k > 0"))
def r14(spark, d):
    return bl.per_group(steps(spark, d), ["step"], "sample_index", "len", lambda v: bl.least_loaded(v, 8))


@op("R16", folded("CAST([] AS BIGINT[])", f"CASE WHEN {_ROOM} > len(r.state) THEN list_append(r.state, 512 - i.len) ELSE list_transform(r.state, lambda v, p: v - CASE WHEN p = {_ROOM} THEN i.len ELSE 0 END) END", f"{_ROOM} - 1", "SELECT step, CAST(max(part) + 1 AS INT) AS bins FROM r WHERE k > 0 GROUP BY step"))
def r16(spark, d):
    return bl.per_group(steps(spark, d), ["step"], "sample_index", "len", lambda v: bl.first_fit(v, 512)).groupBy("step").agg((F.max("part") + 1).alias("bins"))


def _scheduled(spark, d):
    return bl.micro_batches(steps(spark, d).withColumn("rank", F.col("sample_index") % 4), "step", "rank", "sample_index", "len", 512)


@op("R17")
def r17(spark, d):
    return _scheduled(spark, d)


@op("R18", sql("SELECT step, rank, CAST(sum(len) AS BIGINT) AS tokens FROM (SELECT *, sample_index % 4 AS rank FROM x) GROUP BY 1, 2", _STEP))
def r18(spark, d):
    """All micro-batches of a rank, fetched one by one, hold all its tokens."""
    mb = _scheduled(spark, d).groupBy("step", "rank", "mb").agg(F.sum("len").alias("t"))
    return mb.groupBy("step", "rank").agg(F.sum("t").alias("tokens"))


@op("R19", sql("SELECT sample_index, len FROM x ORDER BY sample_index", _STEP))
def r19(spark, d):
    """Results of balanced batches, back in their first order."""
    return _scheduled(spark, d).orderBy("sample_index").select("sample_index", "len")


@op("R24", folded("[CAST(0 AS BIGINT), 0]", "CASE WHEN r.state[2] > 0 AND r.state[2] + i.len >= 1024 THEN [r.state[1] + 1, i.len] ELSE [r.state[1], r.state[2] + i.len] END", "r.state[1] + CASE WHEN r.state[2] > 0 AND r.state[2] + i.len >= 1024 THEN 1 ELSE 0 END", "SELECT step, sample_index, len, CAST(part AS INT) AS part FROM r WHERE k > 0"))
def r24(spark, d):
    return bl.per_group(steps(spark, d), ["step"], "sample_index", "len", lambda v: bl.chunks_by_size(v, 1024))


@op("R26", sql("SELECT step, count(*) AS n, count(*) // 8 AS least, (count(*) + 7) // 8 AS most FROM x GROUP BY 1 HAVING count(*) >= 8", _STEP))
def r26(spark, d):
    """Requests of equal weight, each to the least loaded of eight ranks."""
    x = bl.per_group(steps(spark, d).withColumn("one", F.lit(1)), ["step"], "sample_index", "one", lambda v: bl.least_loaded(v, 8))
    k = x.groupBy("step", "part").agg(F.count(F.lit(1)).alias("k")).groupBy("step").agg(F.sum("k").alias("n"), F.min("k").alias("least"), F.max("k").alias("most"))
    return k.where("n >= 8")


# ---- conversation masks -------------------------------------------------------------------------------------------
M = """m AS (SELECT prompt_id, unnest(messages) AS m, generate_subscripts(messages, 1) - 1 AS turn FROM prompts WHERE messages IS NOT NULL),
 n AS (SELECT prompt_id, turn, m.role AS role, length(coalesce(m.content, '')) AS len, m.content AS content, 13 + length(m.role) AS pre, m.role = 'assistant' AND coalesce(m.step_loss_mask, 1) = 1 AS trained FROM m),
 z AS (SELECT *, CAST(coalesce(sum(pre + len + 11) OVER (PARTITION BY prompt_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + pre AS BIGINT) AS start FROM n)"""


def turns(spark, d):
    return mk.turn_spans(table(spark, d, "prompts"), "prompt_id", "messages")


_FAMILIES = """f AS (SELECT prompt_id, 'per_turn' AS family, turn, start, start + len + 11 AS finish FROM z WHERE trained UNION ALL SELECT prompt_id, 'prefixed', turn, start, start + len + 11 FROM z WHERE trained
 UNION ALL SELECT prompt_id, 'full_text', turn, start + CASE WHEN starts_with(coalesce(content, ''), '<think>' || chr(10)) THEN 8 ELSE 0 END, start + len + 11 FROM z WHERE trained
 UNION ALL SELECT prompt_id, 'last_reply', len(messages) - 1, 13 + length(messages[1].role) + length(coalesce(messages[1].content, '')) + 11 + 22, 13 + length(messages[1].role) + length(coalesce(messages[1].content, '')) + 11 + 22 + length(coalesce(messages[-1].content, '')) FROM prompts WHERE len(messages) > 0 AND coalesce(messages[-1].step_loss_mask, 1) = 1)"""


@op("W29", f"WITH {M}, {_FAMILIES} SELECT prompt_id, family, CAST(turn AS BIGINT) AS turn, CAST(start AS BIGINT) AS start, CAST(finish AS BIGINT) AS finish FROM f")
def w29(spark, d):
    """Character ranges that are trained on, by the four ways to mask a conversation."""
    out, p = None, table(spark, d, "prompts")
    for family in mk.FAMILIES:
        one = mk.trained_ranges(p, "prompt_id", "messages", family).select("prompt_id", F.lit(family).alias("family"), F.col("turn").cast("long").alias("turn"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("finish"))
        out = one if out is None else out.unionByName(one)
    return out


@op("W30", f"WITH {M}, {_FAMILIES}, t AS (SELECT DISTINCT prompt_id, family, unnest(range(start // 4, (finish - 1) // 4 + 1)) AS token FROM f WHERE finish > start), c AS (SELECT prompt_id, family, count(*) AS n FROM t GROUP BY 1, 2) SELECT prompt_id, family, coalesce(n, 0) AS tokens FROM (SELECT prompt_id, unnest(['full_text', 'last_reply']) AS family FROM prompts WHERE messages IS NOT NULL) LEFT JOIN c USING (prompt_id, family)")
def w30(spark, d):
    """Tokens of four characters that overlap a trained range, each counted once."""
    p, out = table(spark, d, "prompts"), None
    for family in ("full_text", "last_reply"):
        one = mk.token_masks(p, "prompt_id", "messages", family, 4).select("prompt_id", F.lit(family).alias("family"), F.aggregate("mask", F.lit(0).cast("long"), lambda a, m: a + m).alias("tokens"))
        out = one if out is None else out.unionByName(one)
    return out


@op("W37", f"WITH {M} SELECT prompt_id, turn, CAST(pre + len + 11 AS BIGINT) AS added, '<|im_start|>' || role || chr(10) || coalesce(content, '') || '<|im_end|>' || chr(10) AS text FROM z")
def w37(spark, d):
    """What each turn adds: the rendering up to it without the rendering up to the turn before."""
    p = table(spark, d, "prompts").where("size(messages) > 0").select("prompt_id", "messages", F.explode(F.sequence(F.lit(1), F.size("messages"))).alias("k"))
    now, before = mk.render(F.slice("messages", F.lit(1), F.col("k"))), mk.render(F.slice("messages", F.lit(1), F.col("k") - 1))
    delta = F.when(now.startswith(before), F.substr(now, F.length(before) + 1)).otherwise(F.raise_error(F.lit("a rendering must begin with the one before")))
    return p.select("prompt_id", (F.col("k") - 1).cast("long").alias("turn"), delta.alias("text")).select("prompt_id", "turn", F.length("text").cast("long").alias("added"), "text")


@op("W38", f"WITH {M}, a AS (SELECT prompt_id, min(start) FILTER (trained) AS first, max(start + len + 11) AS total, sum(CASE WHEN trained THEN len + 11 ELSE 0 END) AS ones FROM z GROUP BY 1) SELECT prompt_id, CAST(coalesce(total - first, 0) AS BIGINT) AS response_length, CAST(CASE WHEN first IS NULL THEN total ELSE total - first END AS BIGINT) AS kept, CAST(ones AS BIGINT) AS ones, CAST(0 AS DOUBLE) AS reward FROM a")
def w38(spark, d):
    """Rows for supervised training: the response runs from the first trained token to the end, and as many entries of the mask are kept, which is all of them for a length of 0; the reward is 0."""
    x = mk.token_masks(table(spark, d, "prompts").where("size(messages) > 0"), "prompt_id", "messages", "per_turn")
    n = tk.response_length(F.col("mask"))
    x = x.select("prompt_id", n.cast("long").alias("response_length"), tk.tail(F.col("mask"), n).alias("own"))
    return x.select("prompt_id", "response_length", F.size("own").cast("long").alias("kept"), F.aggregate("own", F.lit(0).cast("long"), lambda a, m: a + m).alias("ones"), F.lit(0.0).alias("reward"))


@op("W39", f"WITH {M}, b AS (SELECT prompt_id, turn, len, CAST(sum(len) OVER (PARTITION BY prompt_id ORDER BY turn) AS BIGINT) AS used, lead(turn) OVER (PARTITION BY prompt_id ORDER BY turn) IS NULL AS last FROM z) SELECT prompt_id, turn, used, CASE WHEN used >= 200 THEN 'truncated' WHEN last THEN 'completed' ELSE 'pending' END AS status FROM b WHERE used - len < 200")
def w39(spark, d):
    x = turns(spark, d).select("prompt_id", "turn", (F.col("end") - F.col("start")).alias("len"))
    return mk.token_budget(x, "prompt_id", "turn", F.col("len"), 200).select("prompt_id", F.col("turn").cast("long").alias("turn"), F.col("used").cast("long").alias("used"), "status")


# ---- streaming ----------------------------------------------------------------------------------------------------
def _buffered(spark, d, files: int | None = None):
    src = bf.file_stream(spark, f"{d}/samples.parquet", files)
    path = shared(spark, "groups")
    bf.run_to_end(bf.group_buffer(src.select("group_index", "sample_index", "reward", "arrived_at"), 4), path, shared(spark, "state"))
    return spark.read.schema(bf.OUT).parquet(path)


_EMIT = "SELECT group_index, count(*) // 4 AS emissions, count(*) // 4 * 4 AS rows FROM samples GROUP BY 1 HAVING count(*) >= 4"


@op("X1", "SELECT CAST(sum(rows) AS BIGINT) AS rows FROM (" + _EMIT + ")")
def x1(spark, d):
    """Keyed buffer over a stream of deliveries, repeated ones included."""
    return _buffered(spark, d).agg(F.count(F.lit(1)).alias("rows"))


@op("X2", _EMIT)
def x2(spark, d):
    """Groups are emitted when complete; later members begin a new one."""
    return _buffered(spark, d).groupBy("group_index").agg(F.count_distinct("emission").alias("emissions"), F.count(F.lit(1)).alias("rows"))


_ITEMS = "group_index bigint, sample_index bigint, reward double, arrived_at timestamp"


def _store(spark, d, filled: bool = True) -> GroupStore:
    """A store, by default with all that the stream of deliveries has."""
    store = GroupStore(spark, shared(spark, "store"), _ITEMS, 4)
    if filled:
        src = bf.file_stream(spark, f"{d}/samples.parquet").select("group_index", "sample_index", "reward", F.col("arrived_at").cast("timestamp").alias("arrived_at"))
        store.drain(src, shared(spark, "store-offsets"))
    return store


@op("X3", "SELECT group_index, count(*) AS n FROM samples GROUP BY 1 HAVING count(*) < 4 AND max(arrived_at) < (SELECT max(arrived_at) FROM samples) - INTERVAL 1 DAY")
def x3(spark, d):
    """Time-out, an option: groups in the store that are still incomplete a day after their last member, at the time of the last arrival.

    In a stream ``group_buffer(wait_ms=...)`` does the same by processing time.
    """
    return _store(spark, d).expired("arrived_at", "1 DAY")


@op("X4", """WITH c AS (SELECT group_index, sample_index % 2 AS chunk, reward FROM samples), v AS (SELECT group_index, count(*) FILTER (chunk = 0) AS n0, count(*) AS n FROM c GROUP BY 1), e AS (SELECT count(*) FILTER (n0 >= 4) > 0 AS early FROM v)
 SELECT 0 AS read_no, count(*) AS total_samples, count(DISTINCT group_index) AS num_groups, round(avg(reward), 6) AS avg_reward, (SELECT CAST(coalesce(sum(n0) FILTER (n0 >= 4), 0) AS BIGINT) FROM v) AS rows FROM c WHERE chunk = 0
 UNION ALL SELECT 1, count(*), count(DISTINCT group_index), round(avg(reward), 6), (SELECT CAST(coalesce(sum(CASE WHEN n0 >= 4 THEN CASE WHEN n - n0 >= 4 THEN n - n0 ELSE 0 END WHEN n >= 4 THEN n ELSE 0 END), 0) AS BIGINT) FROM v) FROM c, e WHERE chunk = 1 OR NOT early""")
def x4(spark, d):
    """Two reads, each after half of the deliveries: rows given, and meta data since the last read that gave any."""
    store, out = _store(spark, d, False), None
    s = table(spark, d, "samples").select("group_index", "sample_index", "reward", F.col("arrived_at").cast("timestamp").alias("arrived_at"))
    for k in (0, 1):
        store.append(s.where(F.col("sample_index") % 2 == k))
        data, report = store.read()
        one = report.crossJoin(data.agg(F.count(F.lit(1)).alias("rows"))).select(F.lit(k).alias("read_no"), "total_samples", "num_groups", F.round("avg_reward", 6).alias("avg_reward"), "rows")  # one row each
        out = one if out is None else out.unionByName(one)
    return out


@op("X5", "SELECT CAST(sum(n) AS BIGINT) AS queued FROM (SELECT count(*) AS n FROM samples GROUP BY group_index HAVING count(*) >= 4)")
def x5(spark, d):
    """Rows of the valid groups that wait in the store."""
    return spark.createDataFrame([(_store(spark, d).queued(),)], "queued bigint")


@op("X6", """WITH s AS (SELECT DISTINCT sample_index, group_index, response, reward, finished_at FROM samples), e AS (SELECT group_index, max(finished_at) AS done, coalesce(stddev_samp(reward) > 1e-6, false) AS keep FROM s GROUP BY 1), f AS (SELECT *, row_number() OVER (ORDER BY done NULLS FIRST, group_index) AS rn FROM e WHERE keep), l AS (SELECT done, group_index AS g FROM f WHERE rn = 32)
 SELECT 'collected' AS fate, sample_index, CAST(NULL AS INT) AS start_rollout_id FROM s WHERE group_index IN (SELECT group_index FROM f WHERE rn <= 32) AND (SELECT count(*) FROM l) >= 0
 UNION ALL SELECT 'recycled', sample_index, CASE WHEN length(response) > 0 THEN 7 END FROM s JOIN e USING (group_index), l WHERE e.done > l.done OR e.done = l.done AND e.group_index > l.g""")
def x6(spark, d):
    """The first 32 groups with differing rewards; what completes later is aborted and goes back, marked with the rollout that began it."""
    s = samples(spark, d, "sample_index", "group_index", "response", "reward", "finished_at").withColumn("start_rollout_id", F.lit(None).cast("int"))
    kept = reward_filter(s).where("keep").select("group_index")
    got, back = collect_and_recycle(s, kept, 32, "finished_at", 7)
    return got.select(F.lit("collected").alias("fate"), "sample_index", "start_rollout_id").unionByName(back.select(F.lit("recycled").alias("fate"), "sample_index", "start_rollout_id"))


@op("X7", _EMIT)
def x7(spark, d):
    """The same with back-pressure: at most one file in a micro-batch."""
    return _buffered(spark, d, 1).groupBy("group_index").agg(F.count_distinct("emission").alias("emissions"), F.count(F.lit(1)).alias("rows"))


@op("X8", sql("SELECT session_id, sample_index, CAST(substr(weight_version, 2) AS INT) - lag(CAST(substr(weight_version, 2) AS INT)) OVER (PARTITION BY session_id ORDER BY finished_at, sample_index) AS staleness FROM s WHERE session_id IS NOT NULL AND weight_version IS NOT NULL"))
def x8(spark, d):
    """Staleness: how many versions a session's sample is behind the one before; a session of any size is spread by ranges."""
    v = F.substring("weight_version", 2, 9).cast("int")
    s = samples(spark, d, "sample_index", "session_id", "weight_version", "finished_at").where("session_id is not null and weight_version is not null").select("session_id", "sample_index", "finished_at", v.alias("v"))
    return previous(s, "session_id", ["finished_at", "sample_index"], "v", "before").select("session_id", "sample_index", (F.col("v") - F.col("before")).alias("staleness"))


@op("X9", "SELECT prompt_id, epoch, rep FROM prompts, (SELECT unnest([0, 1]) AS epoch), (SELECT unnest([0, 1, 2]) AS rep)")
def x9(spark, d):
    """Files of lines, read for two epochs by a Python data source, each line three times."""
    path = shared(spark, "epochs")
    sinks.write_lines(table(spark, d, "prompts").select("prompt_id"), path)
    spark.dataSource.register(pull.RepeatSource)
    x = spark.read.format("repeated_lines").option("path", path if "://" in path else "file://" + path.removeprefix("file:")).option("epochs", 2).option("repeats", 3).load()
    return x.select(F.get_json_object("value", "$.prompt_id").cast("long").alias("prompt_id"), "epoch", "rep")


@op("X10", "WITH c AS (SELECT count(*) AS n, count(*) FILTER (sample_index % 3 = 0) AS a, count(*) FILTER (sample_index % 3 < 2) AS b FROM samples) SELECT CASE WHEN a * 2 >= n THEN 1 WHEN b * 2 >= n THEN 2 ELSE 3 END AS polls, CASE WHEN a * 2 >= n THEN a WHEN b * 2 >= n THEN b ELSE n END AS rows, false AS gave_up FROM c UNION ALL SELECT 2, b, true FROM c")
def x10(spark, d):
    """Polls a store that grows by a third of the deliveries with each poll, until half of them are there; and for more than there are, but only twice."""
    s = table(spark, d, "samples").select("group_index", "sample_index", "reward", F.col("arrived_at").cast("timestamp").alias("arrived_at"))
    n = s.count()

    def grown(limit: int, retries: int) -> tuple[int, int]:
        store = _store(spark, d, False)

        def step() -> int:
            store.append(s.where(F.col("sample_index") % 3 == store.batches))
            return store.waiting().count()

        return poll(step, limit, retries)

    (rows, calls), (few, tries) = grown(-(-n // 2), -1), grown(n + 1, 1)
    return spark.createDataFrame([(calls, rows, False), (tries, few, few < n + 1)], "polls int, rows bigint, gave_up boolean")


@op("X11", """WITH c AS (SELECT worker AS engine, date_diff('day', (SELECT min(sent_at) FROM replay_results)::DATE, sent_at::DATE) AS round, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) >= 0.9 AS ok FROM replay_results WHERE worker IS NOT NULL GROUP BY 1, 2), t AS (SELECT *, coalesce(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY engine, round // 3 ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bad FROM c)
 SELECT engine, CAST(round AS INT) AS round, CASE WHEN bad > 0 THEN 'skipped' WHEN NOT ok THEN 'killed' ELSE 'passed' END AS event FROM t""")
def x11(spark, d):
    """Workers checked once a day: one with less than nine of ten good results is killed, and recovered before every third round."""
    r = table(spark, d, "replay_results").where("worker is not null").select("worker", F.to_date("sent_at").alias("day"), "ok")
    first = table(spark, d, "replay_results").agg(F.to_date(F.min("sent_at")).alias("first"))
    good = F.avg(F.when(F.col("ok"), 1.0).otherwise(0.0)) >= 0.9
    c = r.crossJoin(F.broadcast(first)).groupBy(F.col("worker").alias("engine"), F.date_diff("day", "first").alias("round")).agg(good.alias("ok"))  # one row
    return health_events(c, recover_every=3)


# ---- hooks --------------------------------------------------------------------------------------------------------
@op("H1", sql("SELECT sample_index FROM s WHERE status = 'completed'"))
def h1(spark, d):
    return Hooks(rollout=lambda df: df.where("status = 'completed'")).table("rollout", samples(spark, d, "sample_index", "status")).select("sample_index")


@op("H2", sql("SELECT sample_index, j FROM s, (SELECT unnest([0, 1]) AS j)"))
def h2(spark, d):
    """A generator may make several rows of one."""
    hook = Hooks(generate=lambda df: df.withColumn("j", F.explode(F.array(F.lit(0), F.lit(1)))))
    return hook.table("generate", samples(spark, d, "sample_index"))


@op("H3", sql("SELECT sample_index, round(coalesce(reward, 0) * 2, 6) AS reward FROM s"))
def h3(spark, d):
    hook = Hooks(reward=lambda scale: F.coalesce("reward", F.lit(0.0)) * scale)
    return samples(spark, d, "sample_index", "reward").select("sample_index", r6(hook.column("reward", F.col("reward"), scale=2, unused=1), "reward"))


@op("H4", sql("SELECT group_index FROM s GROUP BY 1 HAVING count(*) = 4"))
def h4(spark, d):
    hook = Hooks(dynamic_filter=lambda df: df.groupBy("group_index").agg(F.count(F.lit(1)).alias("n")).where("n = 4").select("group_index"))
    return hook.table("dynamic_filter", samples(spark, d, "sample_index", "group_index"))


@op("H5", sql("SELECT group_index FROM s GROUP BY 1 ORDER BY max(finished_at) DESC, 1 LIMIT 16"))
def h5(spark, d):
    hook = Hooks(buffer_filter=lambda df, n: df.groupBy("group_index").agg(F.max("finished_at").alias("t")).orderBy(F.desc("t"), "group_index").limit(n).select("group_index"))
    return hook.table("buffer_filter", samples(spark, d, "group_index", "finished_at"), n=16)


@op("H6", sql("SELECT count(*) AS n FROM s"))
def h6(spark, d):
    """No hook set: all samples pass."""
    return Hooks().table("all_samples", samples(spark, d, "sample_index")).agg(F.count(F.lit(1)).alias("n"))


@op("H7", sql("SELECT s.sample_index, round(reward - mu, 6) AS normalized FROM s JOIN (SELECT group_index, avg(reward) AS mu FROM s GROUP BY 1) g ON s.group_index = g.group_index WHERE reward IS NOT NULL"))
def h7(spark, d):
    hook = Hooks(reward_post_process=lambda df: normalize(df, std=False))
    return hook.table("reward_post_process", samples(spark, d, "sample_index", "group_index", "reward")).where("reward is not null").select("sample_index", r6(F.col("normalized"), "normalized"))


@op("H8", sql("SELECT sample_index, coalesce(response_length, 0) AS response_length FROM s"))
def h8(spark, d):
    hook = Hooks(convert=lambda df: df.select("sample_index", F.coalesce("response_length", F.lit(0)).alias("response_length")))
    return hook.table("convert", samples(spark, d, "sample_index", "response_length"))


@op("H9", sql("SELECT 'rollout/n' AS metric, CAST(count(*) AS DOUBLE) AS value, 1 AS step, 'rollout/step' AS step_key FROM s"))
def h9(spark, d):
    """A log hook that returns nothing leaves the default sink in place."""
    path = shared(spark, "log")
    m = samples(spark, d, "sample_index").agg(F.count(F.lit(1)).alias("value")).withColumn("metric", F.lit("rollout/n"))
    Hooks(log=lambda metrics: None).log(m, lambda x: sinks.append_metrics(x, path, 1, "rollout/step"))
    return spark.read.parquet(path)


@op("H10", sql("SELECT sample_index, 5 AS rollout_id FROM s"))
def h10(spark, d):
    hook = Hooks(data_post_process=lambda df, rollout_id: df.withColumn("rollout_id", F.lit(rollout_id)))
    return hook.table("data_post_process", samples(spark, d, "sample_index"), rollout_id=5)


@op("H11", sql("SELECT round(sum(coalesce(reward, 0) * response_length), 4) AS loss FROM s"))
def h11(spark, d):
    hook = Hooks(loss=lambda: F.coalesce("reward", F.lit(0.0)) * F.col("response_length"))
    return samples(spark, d, "sample_index", "reward", "response_length").agg(F.round(F.sum(hook.column("loss", F.col("reward"))), 4).alias("loss"))


class _Pages(pull.RolloutReader):
    """Pages made from their number; stands in for a server."""

    fetch = staticmethod(lambda url: [{"uid": f"{url}-{i}"} for i in range(3)])


class PageSource(pull.RolloutSource):
    @classmethod
    def name(cls) -> str:
        return "rollout_pages"

    def reader(self, schema):
        return _Pages(self.options)


@op("H12", "SELECT CAST(p AS INT) AS page, '{\"uid\": \"page-' || p || '-' || i || '\"}' AS item FROM (SELECT unnest(range(4)) AS p), (SELECT unnest(range(3)) AS i)")
def h12(spark, d):
    """A registered Python data source."""
    spark.dataSource.register(PageSource)
    return spark.read.format("rollout_pages").option("url", "page-{page}").option("pages", "4").load()


#: Generators by task type, with their own group functions or the defaults.
GENERATORS = {"math": {"valid": lambda g: g.where("n >= 4")}, "default": {}}


@op("H13", sql("SELECT 'math' AS task, count(*) AS groups FROM (SELECT 1 FROM s GROUP BY group_index HAVING count(*) >= 4) UNION ALL SELECT 'default', count(DISTINCT group_index) FROM s"))
def h13(spark, d):
    g = samples(spark, d, "sample_index", "group_index").groupBy("group_index").agg(F.count(F.lit(1)).alias("n"))
    out = [GENERATORS[k].get("valid", lambda x: x)(g).agg(F.lit(k).alias("task"), F.count(F.lit(1)).alias("groups")) for k in ("math", "default")]
    return out[0].unionByName(out[1])


@op("H14", sql("SELECT step, round(sum(lp), 6) AS lp, 'ref' AS prefix FROM (SELECT sample_index // 64 AS step, -coalesce(response_length, 0) * 0.5 + 1 AS lp FROM s) GROUP BY step"))
def h14(spark, d):
    """Model hooks on what a pipeline has of a model, its input columns: at the start, before log-probabilities and before each training step; each gets only the arguments it accepts."""
    hook = Hooks(
        model_init=lambda df: df.withColumn("lp", -F.coalesce("response_length", F.lit(0)) * 0.5),
        before_log_prob=lambda df, store_prefix: df.withColumn("prefix", F.lit(store_prefix)),
        before_train_step=lambda df, step_id, rollout_id=0: df.withColumn("lp", F.col("lp") + 1).withColumn("step", step_id),
    )
    x = hook.table("model_init", samples(spark, d, "sample_index", "response_length"), model="unused")
    x = hook.table("before_log_prob", x, store_prefix="ref")
    x = hook.table("before_train_step", x, rollout_id=3, step_id=F.floor(F.col("sample_index") / 64).cast("long"), optimizer=None)
    return x.groupBy("step", "prefix").agg(r6(F.sum("lp"), "lp"))


@op("H15", sql("SELECT k, round(avg(CASE WHEN c > 0 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM (SELECT count(*) FILTER (reward = 1) AS c FROM s GROUP BY group_index HAVING count(*) = 4), (SELECT 4 AS k) GROUP BY k"))
def h15(spark, d):
    """A hook gets only the arguments it accepts."""
    hook = Hooks(rollout=lambda df: pass_rates(df, 4).where("k = 4"))
    x = hook.table("rollout", samples(spark, d, "sample_index", "group_index", "reward"), evaluation=True)
    return x.select("k", r6(F.col("pass_rate"), "pass_rate"))




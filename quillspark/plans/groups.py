"""Queries of filters, group aggregates, metrics and replication (F*, A*, M*, R*)."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from quillspark.functions import tokens as tk
from quillspark.operators import groups as gp
from quillspark.operators.ordering import round_label, row_index, running_sum
from quillspark.plans.registry import Hooks, op, table
from quillspark.plans.tokens import BASE, long, packed, r6
from quillspark.sources.cursor import PromptSource, State

COLS = ["sample_index", "group_index", "prompt_id", "response_length", "label", "reward", "status", "remove_sample", "session_id", "weight_version", "finished_at"]
S = f"s AS (SELECT DISTINCT {', '.join(COLS)} FROM samples)"
V = "v AS (SELECT group_index, coalesce(stddev_samp(reward) > 1e-6, false) AS keep, arg_min_null(reward, sample_index) AS r0 FROM s GROUP BY group_index)"


def samples(spark, d, *cols):
    """Delivered samples, each once: copies of a delivery differ only in their arrival."""
    return table(spark, d, "samples").select(*(cols or COLS)).distinct()


def sql(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([S, *ctes])} {body}"


@op("F1", r"SELECT prompt_id FROM prompts WHERE messages IS NOT NULL OR len(string_split_regex(trim(prompt), '\s+')) <= 30")
def f1(spark, d):
    """Long text prompts are dropped; conversations are not measured."""
    p = table(spark, d, "prompts")
    return p.where(F.col("messages").isNotNull() | (F.size(F.split(F.trim("prompt"), r"\s+")) <= 30)).select("prompt_id")


@op("F2", sql("SELECT group_index, keep, CASE WHEN NOT keep AND r0 IS NOT NULL THEN 'zero_std_' || printf('%.1f', r0) END AS reason FROM v", V))
def f2(spark, d):
    return gp.reward_filter(samples(spark, d, "sample_index", "group_index", "reward"))


@op("F3", sql("SELECT s.sample_index FROM s JOIN v ON s.group_index = v.group_index WHERE keep", V))
def f3(spark, d):
    hooks = Hooks(dynamic_filter=lambda df: gp.apply_filter(df, gp.reward_filter))
    return hooks.table("dynamic_filter", samples(spark, d, "sample_index", "group_index", "reward")).select("sample_index")


@op("F4", sql("SELECT 'rollout/dynamic_filter/drop_zero_std_' || printf('%.1f', r0) AS metric, count(*) AS value FROM v WHERE NOT keep AND r0 IS NOT NULL GROUP BY 1", V))
def f4(spark, d):
    return gp.drop_counts(f2(spark, d))


@op("F5", sql("SELECT group_index, min(sample_index) AS first_index FROM s WHERE group_index IN (SELECT s.group_index FROM s JOIN v ON s.group_index = v.group_index WHERE keep GROUP BY 1 ORDER BY max(finished_at), 1 LIMIT 100) GROUP BY 1", V))
def f5(spark, d):
    s = samples(spark, d, "sample_index", "group_index", "reward", "finished_at")
    return gp.collect_first(s, gp.reward_filter(s), 100, "finished_at").select("group_index", "first_index")


@op("F6", sql("""SELECT b AS batch, count(*) AS submitted, CAST(sum(k) AS BIGINT) AS accepted, b * 64 < 256 + any_value(rejected) AS needed FROM (SELECT *, (SELECT count(*) FILTER (k = 0) FROM z WHERE p <= coalesce((SELECT min(p) FROM z WHERE a = 256), 1e18)) AS rejected FROM z) GROUP BY b""", V,
 "z AS (SELECT p, p // 64 AS b, k, sum(k) OVER (ORDER BY p) AS a FROM (SELECT row_number() OVER (ORDER BY group_index) - 1 AS p, CASE WHEN keep THEN 1 ELSE 0 END AS k FROM v))"))
def f6(spark, d):
    """Batches of 64 groups for 256 accepted ones."""
    v = gp.reward_filter(samples(spark, d, "sample_index", "group_index", "reward"))
    return gp.over_sampling(v, "group_index", 64, 256)


@op("F7", sql("SELECT sample_index, coalesce(remove_sample, false) OR coalesce(status = 'truncated', false) AS remove_sample FROM s"))
def f7(spark, d):
    hooks = Hooks(sample_filter=lambda df: df.withColumn("remove_sample", F.coalesce("remove_sample", F.lit(False)) | F.coalesce(F.col("status") == "truncated", F.lit(False))))
    return hooks.table("sample_filter", samples(spark, d, "sample_index", "remove_sample", "status")).select("sample_index", "remove_sample")


@op("F8", sql("SELECT s.sample_index, keep AS passed FROM s JOIN v ON s.group_index = v.group_index", V))
def f8(spark, d):
    """All samples, those of rejected groups too."""
    s = samples(spark, d, "sample_index", "group_index", "reward")
    return s.join(gp.reward_filter(s).select("group_index", F.col("keep").alias("passed")), "group_index").select("sample_index", "passed")


@op("F9", sql("SELECT sample_index FROM (SELECT sample_index, row_number() OVER (ORDER BY sample_index) AS rn, count(*) OVER () AS n FROM s) WHERE rn <= n // 128 * 128"))
def f9(spark, d):
    s = samples(spark, d, "sample_index")
    n = s.agg(F.count(F.lit(1)).alias("n"))
    return row_index(s, "sample_index").crossJoin(F.broadcast(n)).where(F.col("row") < F.floor(F.col("n") / 128) * 128).select("sample_index")  # one row


@op("F10", sql("SELECT weight_version, greatest(count(*) // 8 * 8, 8) AS global_batch FROM s GROUP BY 1"))
def f10(spark, d):
    return samples(spark, d, "sample_index", "weight_version").groupBy("weight_version").agg(F.greatest(F.floor(F.count(F.lit(1)) / 8) * 8, F.lit(8)).cast("long").alias("global_batch"))


@op("F11", sql("SELECT group_index FROM s GROUP BY 1 ORDER BY min(finished_at), 1 LIMIT 32"))
def f11(spark, d):
    g = samples(spark, d, "group_index", "finished_at").groupBy("group_index").agg(F.min("finished_at").alias("t"))
    return g.orderBy("t", "group_index").limit(32).select("group_index")


@op("F12", sql("SELECT group_index FROM s GROUP BY 1 HAVING count(*) >= 4"))
def f12(spark, d):
    return samples(spark, d, "sample_index", "group_index").groupBy("group_index").agg(F.count(F.lit(1)).alias("n")).where("n >= 4").select("group_index")


@op("F13", r"WITH t AS (SELECT DISTINCT sample_index, group_index, regexp_matches(response, '\S') AS filled FROM samples) SELECT group_index FROM t GROUP BY 1 HAVING count(*) >= 3 AND count(*) FILTER (filled) >= 3")
def f13(spark, d):
    s = table(spark, d, "samples").select("sample_index", "group_index", F.col("response").rlike(r"\S").alias("filled")).distinct()
    return s.groupBy("group_index").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("filled"), 1)).alias("k")).where("n >= 3 and k >= 3").select("group_index")


@op("F14", sql("SELECT sample_index FROM (SELECT sample_index, prompt_id, row_number() OVER (PARTITION BY prompt_id ORDER BY sample_index) AS nth FROM s) x LEFT JOIN (SELECT prompt_id, count(*) AS k FROM s WHERE status = 'truncated' GROUP BY 1) y ON x.prompt_id = y.prompt_id WHERE k IS NULL OR nth > k"))
def f14(spark, d):
    s = samples(spark, d, "sample_index", "prompt_id", "status")
    return gp.bag_anti_join(s, s.where("status = 'truncated'"), "prompt_id", "sample_index").select("sample_index")


@op("F15", sql("SELECT group_index, coalesce(bool_or(status = 'aborted'), false) AS recycled FROM s GROUP BY 1"))
def f15(spark, d):
    s = samples(spark, d, "sample_index", "group_index", "status")
    return s.groupBy("group_index").agg((F.coalesce(F.max((F.col("status") == "aborted").cast("int")), F.lit(0)) == 1).alias("recycled"))


@op("F16", sql("SELECT sample_index FROM s WHERE group_index IN (SELECT group_index FROM s GROUP BY 1 ORDER BY coalesce(max(epoch_us(finished_at)), 0) DESC, 1 LIMIT 50)"))
def f16(spark, d):
    s = samples(spark, d, "sample_index", "group_index", "finished_at")
    return gp.newest_groups(s, 50, F.unix_micros(F.col("finished_at").cast("timestamp")).cast("double")).select("sample_index")


@op("F17", r"SELECT doc_id, count(*) AS segments FROM (SELECT doc_id, trim(unnest(string_split(text, '...'))) AS seg FROM documents) WHERE len(string_split_regex(seg, ' +')) > 5 GROUP BY 1")
def f17(spark, d):
    seg = F.filter(F.transform(F.split("text", r"\.\.\."), lambda x: F.trim(x)), lambda s: F.size(F.split(s, " +")) > 5)
    return table(spark, d, "documents").select("doc_id", F.size(seg).cast("long").alias("segments")).where("segments > 0")


_LINK = "'https://x.org/' || coalesce(source, '') || '/' || doc_id || CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.html' WHEN 2 THEN '.pdf' ELSE '.shtml' END"


@op("F18", f"SELECT doc_id FROM (SELECT doc_id, doc_kind, regexp_extract({_LINK}, '(\\.[A-Za-z0-9]+)$', 1) AS ext FROM documents) WHERE doc_kind IS NULL AND ext IN ('', '.html', '.htm', '.shtml')")
def f18(spark, d):
    """Links of readable pages; ``doc_kind`` stands for a MIME type."""
    link = F.concat(F.lit("https://x.org/"), F.coalesce("source", F.lit("")), F.lit("/"), F.col("doc_id"), F.element_at(F.array(*map(F.lit, ["", ".html", ".pdf", ".shtml"])), (F.col("doc_id") % 4 + 1).cast("int")))
    return table(spark, d, "documents").where(F.col("doc_kind").isNull() & F.regexp_extract(link, r"(\.[A-Za-z0-9]+)$", 1).isin("", ".html", ".htm", ".shtml")).select("doc_id")


#: Modules that code may import, and text that it may not hold.
SAFE_MODULES = ["math", "random", "datetime", "collections", "itertools", "functools", "operator", "statistics", "decimal", "fractions"]
#: What code must not hold, in any case.
UNSAFE = [
    r"import\s+os",
    r"import\s+sys",
    r"import\s+subprocess",
    r"import\s+shutil",
    r"import\s+glob",
    r"import\s+pathlib",
    r"__import__",
    r"eval\s*\(",
    r"exec\s*\(",
    r"open\s*\(",
    r"file\s*\(",
    r"input\s*\(",
    r"raw_input\s*\(",
    r"compile\s*\(",
    r"execfile\s*\(",
    r"getattr\s*\(",
    r"setattr\s*\(",
    r"delattr\s*\(",
    r"hasattr\s*\(",
    r"globals\s*\(",
    r"locals\s*\(",
    r"vars\s*\(",
    r"dir\s*\(",
    r"type\s*\(",
    r"isinstance\s*\(",
    r"issubclass\s*\(",
    r"super\s*\(",
    r"property\s*\(",
    r"staticmethod\s*\(",
    r"classmethod\s*\(",
    r"__\w+__",
]


@op("F19", f"SELECT doc_id, NOT (regexp_matches(text, '(?i)(?:{'|'.join(UNSAFE)})') OR len(list_filter(list_concat(regexp_extract_all(text, 'import\\s+(\\w+)', 1), regexp_extract_all(text, 'from\\s+(\\w+)', 1)), lambda m: NOT list_contains({SAFE_MODULES}, m))) > 0) AS safe FROM documents WHERE text IS NOT NULL")
def f19(spark, d):
    """Texts as code: denied patterns, and any name after ``import`` or ``from`` that is no allowed module, are unsafe."""
    names = F.array_union(F.regexp_extract_all("text", F.lit(r"import\s+(\w+)"), F.lit(1)), F.regexp_extract_all("text", F.lit(r"from\s+(\w+)"), F.lit(1)))
    other = F.size(F.array_except(names, F.array(*map(F.lit, SAFE_MODULES)))) > 0
    return table(spark, d, "documents").where("text is not null").select("doc_id", (~(F.col("text").rlike(f"(?i)(?:{'|'.join(UNSAFE)})") | other)).alias("safe"))


@op("F20", "SELECT result_id, coalesce(status_code = 429 OR status_code >= 500, false) AS retry FROM replay_results")
def f20(spark, d):
    return table(spark, d, "replay_results").select("result_id", F.coalesce((F.col("status_code") == 429) | (F.col("status_code") >= 500), F.lit(False)).alias("retry"))


@op("F21", "SELECT ds_name, step, CASE WHEN n_samples_per_eval_prompt IS NULL THEN false ELSE step = 99 OR (step + 1) % (n_samples_per_eval_prompt * 5) = 0 OR (step + 1) % 30 = 0 END AS run FROM eval_datasets, (SELECT unnest(range(100)) AS step)")
def f21(spark, d):
    """Periodic action: at the last of 100 steps, at multiples of the interval and at epoch ends (30 steps); no interval, no action."""
    x = table(spark, d, "eval_datasets").select("ds_name", "n_samples_per_eval_prompt", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("step"))
    every = F.col("n_samples_per_eval_prompt") * 5
    due = (F.col("step") == 99) | ((F.col("step") + 1) % every == 0) | ((F.col("step") + 1) % 30 == 0)
    return x.select("ds_name", F.col("step").cast("long").alias("step"), F.when(every.isNull(), F.lit(False)).otherwise(due).alias("run"))


# ---- group aggregates ---------------------------------------------------------------------------------------------
@op("A1", sql("SELECT s.sample_index, round((reward - mu) / (sd + 1e-6), 6) AS normalized FROM s JOIN (SELECT group_index, avg(reward) AS mu, stddev_samp(reward) AS sd FROM s GROUP BY 1) g ON s.group_index = g.group_index WHERE sd > 1e-6 AND reward IS NOT NULL"))
def a1(spark, d):
    """Group-normalized rewards of the groups whose rewards differ."""
    s = samples(spark, d, "sample_index", "group_index", "reward")
    x = gp.normalize(gp.apply_filter(s, gp.reward_filter)).where("reward is not null")
    return x.select("sample_index", r6(F.col("normalized"), "normalized"))


@op("A1_global", sql("SELECT sample_index, round((reward - (SELECT avg(reward) FROM s)) / ((SELECT stddev_samp(reward) FROM s) + 1e-6), 6) AS normalized FROM s WHERE reward IS NOT NULL"))
def a1_global(spark, d):
    """Unequal group sizes: the batch is one group."""
    s = samples(spark, d, "sample_index", "reward").where("reward is not null")
    return gp.normalize(s, None).select("sample_index", r6(F.col("normalized"), "normalized"))


@op("A2", sql("SELECT s.sample_index, reward AS raw_reward, round(CASE WHEN reward IS NULL OR NOT reward BETWEEN 0 AND 1 OR top = 0 THEN reward WHEN sd < 1e-8 THEN 0 ELSE (reward - mu) / (sd + 1e-8) END, 6) AS reward FROM s JOIN (SELECT group_index, avg(reward) FILTER (reward BETWEEN 0 AND 1) AS mu, stddev_pop(reward) FILTER (reward BETWEEN 0 AND 1) AS sd, max(reward) FILTER (reward BETWEEN 0 AND 1) AS top FROM s GROUP BY 1) g ON s.group_index = g.group_index"))
def a2(spark, d):
    x = gp.normalize_valid(samples(spark, d, "sample_index", "group_index", "reward"))
    return x.select("sample_index", "raw_reward", r6(F.col("reward"), "reward"))


@op("A3", sql("SELECT CAST(sum(n) AS BIGINT) AS total_samples, count(*) AS num_groups, round(avg(n), 6) AS avg_group_size, round(sum(r) / sum(k), 6) AS avg_reward FROM (SELECT count(*) AS n, sum(reward) AS r, count(reward) AS k FROM s GROUP BY group_index)"))
def a3(spark, d):
    x = gp.meta(samples(spark, d, "sample_index", "group_index", "reward"))
    return x.select("total_samples", "num_groups", r6(F.col("avg_group_size"), "avg_group_size"), r6(F.col("avg_reward"), "avg_reward"))


@op("A4", sql("SELECT round(sum(a * n) / sum(n), 6) AS avg_reward, CAST(sum(n) AS BIGINT) AS total FROM (SELECT weight_version, avg(reward) AS a, count(*) AS n FROM s WHERE weight_version IS NOT NULL GROUP BY 1)"))
def a4(spark, d):
    m = samples(spark, d, "sample_index", "weight_version", "reward").where("weight_version is not null").groupBy("weight_version").agg(F.avg("reward").alias("a"), F.count(F.lit(1)).alias("n"))
    return m.agg(r6(F.sum(F.col("a") * F.col("n")) / F.sum("n"), "avg_reward"), F.sum("n").alias("total"))


_ROLE = "CASE sample_index % 4 WHEN 0 THEN 'selector' WHEN 1 THEN 'rewriter' ELSE 'solver' END"


@op("A5", sql(f"""SELECT sample_index, role, round(CASE WHEN role = 'selector' THEN sel ELSE reward END * CASE WHEN stage = 3 AND sel = 1 THEN 1.2 ELSE 0.8 END, 6) AS reward FROM y JOIN w USING (group_index) WHERE role = 'solver' OR role = 'rewriter' AND stage >= 2 OR stage = 3""",
 f"y AS (SELECT group_index, sample_index, {_ROLE} AS role, coalesce(reward, 0) AS reward, CASE WHEN status = 'completed' THEN 'solution ' || sample_index END AS solution, sample_index // 4 % 2 AS pick FROM s)",
 "w AS (SELECT *, CASE WHEN sols = 0 THEN 1 WHEN rews = 0 OR sel IS NULL THEN 2 ELSE 3 END AS stage FROM (SELECT group_index, count(solution) FILTER (role = 'solver') AS sols, count(solution) FILTER (role = 'rewriter') AS rews, CASE WHEN count(*) FILTER (role = 'selector') > 0 THEN CASE WHEN min(pick) FILTER (role = 'selector') = 0 AND count(solution) FILTER (role = 'rewriter') > 0 THEN arg_min(reward, sample_index) FILTER (role = 'rewriter' AND solution IS NOT NULL) ELSE 0 END END AS sel FROM y GROUP BY 1))"))
def a5(spark, d):
    """Runs of solvers, a rewriter and a selector: stages that give nothing end them early, the selector's pick decides the factor."""
    role = F.when(F.col("sample_index") % 4 == 0, "selector").when(F.col("sample_index") % 4 == 1, "rewriter").otherwise("solver")
    solution = F.when(F.col("status") == "completed", F.concat(F.lit("solution "), F.col("sample_index").cast("string")))
    s = samples(spark, d, "sample_index", "group_index", "reward", "status")
    x = s.select("group_index", "sample_index", role.alias("role"), F.coalesce("reward", F.lit(0.0)).alias("reward"), F.concat(F.lit("text of "), F.coalesce(solution, F.lit("none"))).alias("text"), solution.alias("solution"), (F.floor(F.col("sample_index") / 4) % 2).cast("int").alias("pick"))
    return gp.agent_rewards(x).select("sample_index", "role", r6(F.col("reward"), "reward"))


@op("A6", f"WITH {BASE} SELECT round(sum(adv * mask) / sum(mask), 6) AS metric FROM b")
def a6(spark, d):
    return long(spark, d).agg(r6(F.sum(F.col("adv") * F.col("mask")) / F.sum("mask"), "metric"))


@op("A7", f"WITH {BASE} SELECT round(avg(m), 6) AS mean_of_means FROM (SELECT avg(adv) AS m FROM b GROUP BY seq % 8)")
def a7(spark, d):
    return long(spark, d).groupBy(F.col("seq") % 8).agg(F.avg("adv").alias("m")).agg(r6(F.avg("m"), "mean_of_means"))


@op("A8", f"WITH {BASE} SELECT max(n) AS most FROM (SELECT count(DISTINCT seq) AS n FROM b GROUP BY seq % 8)")
def a8(spark, d):
    return long(spark, d).groupBy(F.col("seq") % 8).agg(F.count_distinct("seq").alias("n")).agg(F.max("n").alias("most"))


@op("A9", "SELECT event_type AS name, round(sum(value), 4) AS seconds FROM events GROUP BY 1")
def a9(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("name")).agg(F.round(F.sum("value"), 4).alias("seconds"))


@op("A10", f"WITH {BASE} SELECT mask AS key, count(*) AS parts, string_agg(CAST(tok AS VARCHAR), ',' ORDER BY pos, tok) AS merged, seq FROM b GROUP BY mask, seq")
def a10(spark, d):
    """Parts of all turns, joined per key in order."""
    parts = F.sort_array(F.collect_list(F.struct("pos", "tok")))
    return long(spark, d).groupBy(F.col("mask").alias("key"), "seq").agg(F.count(F.lit(1)).alias("parts"), F.array_join(F.transform(parts, lambda s: s["tok"].cast("string")), ",").alias("merged"))


@op("A11", "SELECT run_id, CAST(sum(coalesce(submitted, 0)) AS BIGINT) AS drafted, CAST(sum(coalesce(succeeded, 0)) AS BIGINT) AS accepted FROM (SELECT DISTINCT stats_id, run_id, submitted, succeeded FROM replay_stats) GROUP BY 1")
def a11(spark, d):
    x = table(spark, d, "replay_stats").select("stats_id", "run_id", "submitted", "succeeded").distinct()
    return x.groupBy("run_id").agg(F.sum(F.coalesce("submitted", F.lit(0))).alias("drafted"), F.sum(F.coalesce("succeeded", F.lit(0))).alias("accepted"))


# ---- metrics ------------------------------------------------------------------------------------------------------
@op("M1", sql("SELECT k, round(avg(CASE WHEN n - c < k THEN 1 WHEN c = 0 THEN 0 ELSE 1 - list_product(list_transform(range(n - c + 1, n + 1), lambda i: 1 - k / i)) END), 6) AS pass_rate FROM (SELECT group_index, count(*) AS n, count(*) FILTER (reward = 1) AS c FROM s GROUP BY 1 HAVING count(*) = 4), (VALUES (1), (2), (4)) t(k) GROUP BY k"))
def m1(spark, d):
    return gp.pass_rates(samples(spark, d, "sample_index", "group_index", "reward"), 4).select("k", r6(F.col("pass_rate"), "pass_rate"))


@op("M2", sql("SELECT round(avg(response_length), 6) AS mean, median(response_length) AS median, max(response_length) AS max, min(response_length) AS min FROM s"))
def m2(spark, d):
    c = F.col("response_length")
    return samples(spark, d, "sample_index", "response_length").agg(r6(F.avg(c), "mean"), F.median(c).alias("median"), F.max(c).alias("max"), F.min(c).alias("min"))


@op("M3", sql("SELECT 'zero_std/count_' || printf('%.1f', a) AS metric, count(*) AS value FROM (SELECT min(reward) AS a, max(reward) AS b, count(reward) AS k, count(*) AS n FROM s GROUP BY group_index) WHERE a = b AND k = n GROUP BY 1"))
def m3(spark, d):
    return gp.zero_std(samples(spark, d, "sample_index", "group_index", "reward"))


@F.pandas_udf(BooleanType())
def has_repetition(text: pd.Series) -> pd.Series:
    """More than 10,000 characters of which the last 10,000 compress to less than a tenth."""

    def one(t):
        if t is None or len(t) <= 10000:
            return False
        raw = t[-10000:].encode("utf-8", "replace")
        return len(raw) / len(zlib.compress(raw, 9)) > 10

    return text.map(one).astype(bool)


@op("M4")
def m4(spark, d):
    return table(spark, d, "samples").select("sample_index", "response").where("response is not null").select("sample_index", has_repetition("response").alias("repeats")).distinct()


@op("M5", sql("SELECT round(avg(CASE WHEN status = 'truncated' THEN 1.0 ELSE 0.0 END), 6) AS truncated_ratio, round(avg(response_length), 6) AS mean_length, median(response_length) AS median_length FROM s"))
def m5(spark, d):
    t = F.when(F.col("status") == "truncated", 1.0).otherwise(0.0)
    return samples(spark, d, "sample_index", "status", "response_length").agg(r6(F.avg(t), "truncated_ratio"), r6(F.avg("response_length"), "mean_length"), F.median("response_length").alias("median_length"))


@op("M6", sql("SELECT weight_version, round(sum(response_length) / 100.0 / 8, 6) AS tokens_per_gpu_per_sec, round(any_value(top) / 100.0, 6) AS longest_tokens_per_sec, round(avg(CASE WHEN response_length = top THEN wait END), 6) AS longest_wait, round(any_value(top) / (100.0 - avg(CASE WHEN response_length = top THEN wait END)), 6) AS longest_without_wait FROM (SELECT weight_version, response_length, sample_index % 7 AS wait, max(response_length) OVER (PARTITION BY weight_version) AS top FROM s) GROUP BY weight_version"))
def m6(spark, d):
    """A rollout takes 100 s on 8 devices; ties of the longest sample share their mean waiting time. The longest is one aggregate for each version, joined back."""
    s = samples(spark, d, "sample_index", "weight_version", "response_length").withColumn("wait", F.col("sample_index") % 7)
    g = s.groupBy("weight_version", "response_length").agg(F.sum("response_length").alias("sum"), F.sum("wait").alias("waits"), F.count(F.lit(1)).alias("k"))  # few lengths for each version
    v = g.groupBy("weight_version").agg(F.sum("sum").alias("sum"), F.max("response_length").alias("top"), F.max_by("waits", "response_length").alias("waits"), F.max_by("k", "response_length").alias("k"))
    wait, top = F.when(F.col("top").isNotNull(), F.col("waits") / F.col("k")), F.col("top")
    return v.select("weight_version", r6(F.col("sum") / 100.0 / 8, "tokens_per_gpu_per_sec"), r6(top / 100.0, "longest_tokens_per_sec"), r6(wait, "longest_wait"), r6(top / (100.0 - wait), "longest_without_wait"))


@op("M7", sql("SELECT 'error_cat/' || coalesce(status, 'none') AS metric, round(count(*) / (SELECT count(*) FROM s), 6) AS value FROM s GROUP BY 1"))
def m7(spark, d):
    c = samples(spark, d, "sample_index", "status").groupBy(F.concat(F.lit("error_cat/"), F.coalesce("status", F.lit("none"))).alias("metric")).agg(F.count(F.lit(1)).alias("n"))
    return c.select("metric", r6(F.col("n") / F.sum("n").over(Window.partitionBy()), "value"))  # one row per category


_STATS = "t AS (SELECT DISTINCT stats_id, run_id, submitted, completed, succeeded, stream_requests FROM replay_stats)"


def _stats(spark, d):
    return table(spark, d, "replay_stats").select("stats_id", "run_id", "submitted", "completed", "succeeded", "stream_requests").distinct()


@op("M8", f"WITH {_STATS} SELECT round(avg(coalesce(succeeded / nullif(submitted, 0), 0)), 6) AS accept_rate FROM t")
def m8(spark, d):
    """Mean of the rows' ratios, a denominator of 0 counting as 0."""
    return _stats(spark, d).agg(r6(F.avg(F.coalesce(F.col("succeeded") / F.nullif("submitted", F.lit(0)), F.lit(0.0))), "accept_rate"))


@op("M9", f"WITH {_STATS} SELECT round(coalesce(sum(stream_requests) / nullif(sum(submitted), 0), 0), 6) AS hit_rate, round(sum(stream_requests) / count(*), 6) AS per_row FROM t")
def m9(spark, d):
    """Ratio of sums."""
    return _stats(spark, d).agg(r6(F.coalesce(F.sum("stream_requests") / F.nullif(F.sum("submitted"), F.lit(0)), F.lit(0.0)), "hit_rate"), r6(F.sum("stream_requests") / F.count(F.lit(1)), "per_row"))


@op("M10", """WITH t AS (SELECT DISTINCT sample_index, group_index, element_at(metadata, 'data_source')[1] AS ds, reward, status, response_length FROM samples WHERE metadata IS NOT NULL), g AS (SELECT ds, count(*) AS n, count(*) FILTER (reward = 1) AS c FROM t GROUP BY group_index, ds HAVING count(*) = 4),
 p AS (SELECT ds, avg(CASE WHEN n - c < k THEN 1 WHEN c = 0 THEN 0 ELSE 1 - list_product(list_transform(range(n - c + 1, n + 1), lambda i: 1 - k / i)) END) AS p, k FROM g, (VALUES (1), (2), (4)) t(k) GROUP BY ds, k)
 SELECT ds, round(avg(reward), 6) AS reward, round(avg(CASE WHEN status = 'truncated' THEN 1.0 ELSE 0.0 END), 6) AS truncated_ratio, median(response_length) AS median_length, (SELECT round(p, 6) FROM p WHERE p.ds = t.ds AND k = 1) AS pass_1, (SELECT round(p, 6) FROM p WHERE p.ds = t.ds AND k = 2) AS pass_2, (SELECT round(p, 6) FROM p WHERE p.ds = t.ds AND k = 4) AS pass_4 FROM t GROUP BY ds""")
def m10(spark, d):
    s = table(spark, d, "samples").where("metadata is not null").select("sample_index", "group_index", F.try_element_at("metadata", F.lit("data_source")).alias("ds"), "reward", "status", "response_length").distinct()
    means = s.groupBy("ds").agg(r6(F.avg("reward"), "reward"), r6(F.avg(F.when(F.col("status") == "truncated", 1.0).otherwise(0.0)), "truncated_ratio"), F.median("response_length").alias("median_length"))
    p = gp.pass_rates(s, 4, by="ds").groupBy("ds").pivot("k", [1, 2, 4]).agg(F.first("pass_rate"))
    return means.join(p, means["ds"].eqNullSafe(p["ds"]), "left").select(means["ds"], "reward", "truncated_ratio", "median_length", *[r6(F.col(str(k)), f"pass_{k}") for k in (1, 2, 4)])


@op("M11", f"WITH {BASE}, q AS (SELECT seq, sum(train * mask) / greatest(sum(mask), 1) AS t, sum(adv * mask) / greatest(sum(mask), 1) AS a, any_value(n) AS n FROM b GROUP BY seq) SELECT round(avg(t), 6) AS log_probs, round(avg(a), 6) AS advantages, round(avg(n), 6) AS total_lengths FROM q")
def m11(spark, d):
    """Token columns by their masked mean per sample, others by their plain mean."""
    m = F.col("mask").cast("double")
    q = long(spark, d).groupBy("seq").agg(tk.masked("mean", F.col("train"), m).alias("t"), tk.masked("mean", F.col("adv"), m).alias("a"), F.count(F.lit(1)).alias("n"))
    return q.agg(r6(F.avg("t"), "log_probs"), r6(F.avg("a"), "advantages"), r6(F.avg("n"), "total_lengths"))


@op("M12", sql("SELECT 'p' || (25 * greatest(1, ceil(response_length / 100.0)))::INT AS bin, round(count(*) / (sum(count(*)) OVER () + 1e-9), 6) AS share FROM s WHERE reward = 1 AND response_length <= 400 GROUP BY 1"))
def m12(spark, d):
    """Lengths of correct samples in four bins of 100, closed on the right; longer ones are left out."""
    b = F.greatest(F.lit(1), F.ceil(F.col("response_length") / 100.0)).cast("int") * 25
    x = samples(spark, d, "sample_index", "reward", "response_length").where("reward = 1 and response_length <= 400").groupBy(F.concat(F.lit("p"), b).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return x.select("bin", r6(F.col("n") / (F.sum("n").over(Window.partitionBy()) + 1e-9), "share"))  # four rows


@op("M13", f"WITH {BASE}, q AS (SELECT seq, sum(-train * mask) / greatest(sum(mask), 1) AS e, max(r) AS reward FROM b GROUP BY seq) SELECT round(sum(e), 5) AS correct_entropy FROM q WHERE reward >= 0.1")
def m13(spark, d):
    """Sum of the masked mean entropies of the correct sequences: those that reach the full reward, here the largest discount."""
    q = long(spark, d).groupBy("seq").agg(tk.masked("mean", -F.col("train"), F.col("mask").cast("double")).alias("e"), F.max("r").alias("reward"))
    return q.where("reward >= 0.1").agg(F.round(F.sum("e"), 5).alias("correct_entropy"))


@op("M14", f"WITH {BASE}, q AS (SELECT seq, count(*) AS n, sum(mask) AS k FROM b GROUP BY seq) SELECT round(avg(n), 6) AS raw_mean, max(n) AS raw_max, min(n) AS raw_min, round(avg(CASE WHEN n >= 6 THEN 1.0 ELSE 0.0 END), 6) AS clip_ratio, round(avg(k), 6) AS own_mean, CAST(max(k) AS BIGINT) AS own_max, CAST(min(k) AS BIGINT) AS own_min FROM q")
def m14(spark, d):
    q = long(spark, d).groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.sum("mask").alias("k"))
    return q.agg(r6(F.avg("n"), "raw_mean"), F.max("n").alias("raw_max"), F.min("n").alias("raw_min"), r6(F.avg(F.when(F.col("n") >= 6, 1.0).otherwise(0.0)), "clip_ratio"), r6(F.avg("k"), "own_mean"), F.max("k").alias("own_max"), F.min("k").alias("own_min"))


@op("M15", sql("SELECT weight_version, k, round(avg(CASE WHEN n - c < k THEN 1 WHEN c = 0 THEN 0 ELSE 1 - list_product(list_transform(range(n - c + 1, n + 1), lambda i: 1 - k / i)) END), 6) AS pass_rate FROM (SELECT max(weight_version) AS weight_version, count(*) AS n, count(*) FILTER (reward = 1) AS c FROM s GROUP BY group_index HAVING count(*) = 4), (VALUES (1), (2), (4)) t(k) GROUP BY 1, 2"))
def m15(spark, d):
    return gp.pass_rates(samples(spark, d, "sample_index", "group_index", "reward", "weight_version"), 4, by="weight_version").select("weight_version", "k", r6(F.col("pass_rate"), "pass_rate"))


_TIMERS = "CASE event_type WHEN 'view' THEN 'actor_train' WHEN 'click' THEN 'log_probs' WHEN 'error' THEN 'train_wait' WHEN 'purchase' THEN 'train' ELSE 'ref_log_probs' END"


@op("M16", f"""WITH t AS (SELECT user_id, {_TIMERS} AS key, sum(value) AS s FROM events GROUP BY 1, 2), w AS (SELECT user_id, sum(event_id % 100) AS tokens, sum(2.0 * (event_id % 100)) AS flops FROM events GROUP BY 1), p AS (SELECT user_id, max(s) FILTER (key = 'actor_train') AS a, max(s) FILTER (key = 'log_probs') AS l, max(s) FILTER (key = 'ref_log_probs') AS r, max(s) FILTER (key = 'train_wait') AS wait, max(s) FILTER (key = 'train') AS train FROM t GROUP BY 1),
 m AS (SELECT user_id, 'perf/' || key || '_time' AS metric, s AS value FROM t UNION ALL SELECT user_id, 'perf/log_probs_tflops', CASE WHEN a IS NOT NULL THEN flops / nullif(l, 0) END FROM p JOIN w USING (user_id) UNION ALL SELECT user_id, 'perf/ref_log_probs_tflops', CASE WHEN a IS NOT NULL THEN flops / nullif(r, 0) END FROM p JOIN w USING (user_id)
 UNION ALL SELECT user_id, 'perf/actor_train_tflops', CASE WHEN a > 0 THEN 3 * flops / a END FROM p JOIN w USING (user_id) UNION ALL SELECT user_id, 'perf/actor_train_tok_per_s', CASE WHEN a > 0 THEN tokens / a END FROM p JOIN w USING (user_id) UNION ALL SELECT user_id, 'perf/step_time', CASE WHEN wait + train > 0 THEN wait + train END FROM p UNION ALL SELECT user_id, 'perf/wait_time_ratio', CASE WHEN wait + train > 0 THEN wait / (wait + train) END FROM p)
 SELECT user_id, metric, round(value, 5) AS value FROM m WHERE value IS NOT NULL""")
def m16(spark, d):
    """Timers by step (users are steps, event types timers), and the rates that need them."""
    e = table(spark, d, "events")
    names = {"view": "actor_train", "click": "log_probs", "error": "train_wait", "purchase": "train"}
    key = F.lit("ref_log_probs")
    for k, v in names.items():
        key = F.when(F.col("event_type") == k, v).otherwise(key)
    timers = e.groupBy("user_id", key.alias("key")).agg(F.sum("value").alias("seconds"))
    work = e.groupBy("user_id").agg(F.sum(F.col("event_id") % 100).alias("tokens"), F.sum(2.0 * (F.col("event_id") % 100)).alias("flops"))
    return gp.perf_metrics(timers, work, "user_id").select("user_id", "metric", F.round("value", 5).alias("value"))


@op("M17", sql("SELECT 'rollout/' || coalesce(status, 'none') AS metric, count(*) AS value FROM s GROUP BY 1"))
def m17(spark, d):
    return samples(spark, d, "sample_index", "status").groupBy(F.concat(F.lit("rollout/"), F.coalesce("status", F.lit("none"))).alias("metric")).agg(F.count(F.lit(1)).alias("value"))


@op("M18", "SELECT prompt_id, len(list_filter(messages, lambda m: m.role = 'assistant')) AS rounds FROM prompts WHERE messages IS NOT NULL")
def m18(spark, d):
    return table(spark, d, "prompts").where("messages is not null").select("prompt_id", F.size(F.filter("messages", lambda m: m["role"] == "assistant")).cast("long").alias("rounds"))


# ---- replication and layout ---------------------------------------------------------------------------------------
_PERM = "SELECT prompt_id, row_number() OVER (ORDER BY md5('7-{e}-' || prompt_id), prompt_id) - 1 AS pos FROM prompts"


def epoch(spark, d, e: int):
    """The prompts of an epoch in their seeded order, the same under any partitioning."""
    key = F.md5(F.concat(F.lit(f"7-{e}-"), F.col("prompt_id").cast("string")))
    return row_index(table(spark, d, "prompts").select("prompt_id", key.alias("k")), "k", "prompt_id", name="pos").select("prompt_id", "pos")


@op("R1", f"""WITH a AS ({_PERM.format(e=0)}), b AS ({_PERM.format(e=1)}), c AS ({_PERM.format(e=2)}), n AS (SELECT count(*) AS n FROM prompts) SELECT 0 AS take, 0 AS epoch, prompt_id, pos - (n - 20) AS group_index FROM a, n WHERE pos >= n - 20 UNION ALL SELECT 0, 1, prompt_id, 20 + pos FROM b WHERE pos < 44
 UNION ALL SELECT 1, 1, prompt_id, 20 + least(n, 44) + pos - 44 FROM b, n WHERE pos >= 44 AND pos < 54 UNION ALL SELECT 1, 2, prompt_id, 20 + least(n, 44) + greatest(n - 44, 0) + pos FROM c, n WHERE n < 54 AND pos < 10 - greatest(n - 44, 0)""")
def r1(spark, d):
    """A cursor, saved 20 prompts before the end of an epoch and restored: a take of 64 over the end, then one of 10."""
    p = table(spark, d, "prompts").select("prompt_id")
    saved = PromptSource(p, "prompt_id", state=State(offset=p.count() - 20)).saved()
    source = PromptSource(p, "prompt_id", state=State(**saved))
    a, b = source.take(64), source.take(10)
    cols = ["epoch", "prompt_id", "group_index"]
    return a.select(F.lit(0).alias("take"), *cols).unionByName(b.select(F.lit(1).alias("take"), *cols))


@op("R2", "SELECT prompt_id, g AS group_index, g * 4 + j AS index FROM (SELECT prompt_id, row_number() OVER (ORDER BY prompt_id) - 1 AS g FROM prompts), (SELECT unnest(range(4)) AS j)")
def r2(spark, d):
    x = row_index(table(spark, d, "prompts").select("prompt_id"), "prompt_id", name="group_index")
    return x.select("prompt_id", "group_index", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j")).select("prompt_id", "group_index", (F.col("group_index") * 4 + F.col("j")).alias("index"))


_EVAL = "SELECT ds_name, item_id, coalesce(n_samples_per_eval_prompt, 1) AS n, row_number() OVER (PARTITION BY ds_name ORDER BY row_no, item_id) - 1 AS i FROM eval_items JOIN eval_datasets USING (path)"


@op("R3", f"SELECT ds_name, item_id, i * n + j AS index FROM ({_EVAL}), LATERAL (SELECT unnest(range(n)) AS j)")
def r3(spark, d):
    """Evaluation rows, replicated per dataset; the index starts anew in each."""
    x = table(spark, d, "eval_items").join(table(spark, d, "eval_datasets").select("ds_name", "path", F.coalesce("n_samples_per_eval_prompt", F.lit(1)).alias("n")), "path")
    i = F.row_number().over(Window.partitionBy("ds_name").orderBy("row_no", "item_id")) - 1
    return x.select("ds_name", "item_id", "n", i.alias("i")).select("ds_name", "item_id", "n", "i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j")).select("ds_name", "item_id", (F.col("i") * F.col("n") + F.col("j")).cast("long").alias("index"))


@op("R4", f"SELECT * FROM ({_PERM.format(e=3)})")
def r4(spark, d):
    return epoch(spark, d, 3)


@op("R5", sql("SELECT origin, id FROM (SELECT *, row_number() OVER (ORDER BY rank, id) AS rn FROM (SELECT 0 AS rank, 'buffer' AS origin, group_index AS id FROM s WHERE status = 'aborted' GROUP BY 3 UNION ALL SELECT 1, 'dataset', prompt_id FROM prompts UNION ALL SELECT 2, 'dataset', prompt_id FROM prompts)) WHERE rn <= 64"))
def r5(spark, d):
    """64 groups: what the buffer of recycled groups has, the rest from the dataset."""
    source = PromptSource(table(spark, d, "prompts").select(F.col("prompt_id").alias("id")), "id", seed=None)
    source.add(samples(spark, d, "group_index", "status").where("status = 'aborted'").select(F.col("group_index").alias("id")).distinct())
    return source.take(64).select("origin", "id")


@op("R6", sql("SELECT group_index, count(*) AS n, count(*) = 4 AS accepted FROM s GROUP BY 1"))
def r6_(spark, d):
    """Only groups of the configured size are added."""
    return samples(spark, d, "sample_index", "group_index").groupBy("group_index").agg(F.count(F.lit(1)).alias("n")).withColumn("accepted", F.col("n") == 4)


@op("R7", sql("SELECT group_index, sample_index FROM s"))
def r7(spark, d):
    """Nested groups, flattened."""
    nested = samples(spark, d, "sample_index", "group_index").groupBy("group_index", (F.col("sample_index") % 2).alias("k")).agg(F.collect_list("sample_index").alias("inner")).groupBy("group_index").agg(F.collect_list("inner").alias("outer"))
    return nested.select("group_index", F.explode(F.flatten("outer")).alias("sample_index"))


@op("R8", sql("SELECT sample_index, coalesce(response_length, 0) AS response_length, CASE WHEN status = 'truncated' THEN 1 ELSE 0 END AS truncated, CASE WHEN coalesce(remove_sample, false) THEN 0 ELSE coalesce(response_length, 0) END AS mask_sum FROM s"))
def r8(spark, d):
    n = F.coalesce("response_length", F.lit(0))
    mask = tk.mask_of_removed(F.lit(None).cast("array<int>"), n, F.coalesce("remove_sample", F.lit(False)))
    return samples(spark, d, "sample_index", "response_length", "status", "remove_sample").select("sample_index", n.alias("response_length"), F.when(F.col("status") == "truncated", 1).otherwise(0).alias("truncated"), F.aggregate(mask, F.lit(0), lambda a, m: a + m).alias("mask_sum"))


@op("R9", "SELECT DISTINCT sample_index, coalesce(TRY_CAST(element_at(metadata, 'turns')[1] AS DOUBLE), reward) AS raw_reward FROM samples")
def r9(spark, d):
    """A raw reward in the metadata (here ``turns``) replaces the sample's."""
    s = table(spark, d, "samples")
    return s.select("sample_index", F.coalesce(F.try_element_at("metadata", F.lit("turns")).try_cast("double"), "reward").alias("raw_reward")).distinct()


@op("R10", sql("SELECT sample_index, (row_number() OVER (ORDER BY sample_index) - 1) % 8 AS rank FROM s"))
def r10(spark, d):
    return row_index(samples(spark, d, "sample_index"), "sample_index").select("sample_index", (F.col("row") % 8).alias("rank"))


@op("R15", f"WITH {BASE} SELECT seq, tok, pos FROM b")
def r15(spark, d):
    """The inverse of a permutation: index and value change places."""
    p = packed(spark, d).select("seq", F.posexplode("tok").alias("i", "v"))
    return p.select("seq", F.col("v").alias("tok"), F.col("i").cast("long").alias("pos"))


@op("R20", sql("SELECT sample_index, CAST(coalesce(sum(len) OVER (PARTITION BY weight_version ORDER BY sample_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, CAST(sum(len) OVER (PARTITION BY weight_version) + (128 - sum(len) OVER (PARTITION BY weight_version) % 128) % 128 AS BIGINT) AS padded, max(len) OVER (PARTITION BY weight_version) AS longest FROM (SELECT *, coalesce(response_length, 0) AS len FROM s WHERE weight_version IS NOT NULL)"))
def r20(spark, d):
    """Packed sequences: where each begins, the padded total, the longest. Versions are few and large: running sums over ranges, aggregates joined back."""
    s = samples(spark, d, "sample_index", "weight_version", "response_length").where("weight_version is not null").select("sample_index", "weight_version", F.coalesce("response_length", F.lit(0)).alias("len"))
    v = s.groupBy("weight_version").agg(F.sum("len").alias("total"), F.max("len").alias("longest"))
    x = running_sum(s, "weight_version", ["sample_index"], "len", "start").join(v, "weight_version")
    return x.select("sample_index", "start", (F.col("total") + (128 - F.col("total") % 128) % 128).alias("padded"), "longest")


def _zig(pos: str, ranks: int) -> str:
    chunk = f"least(({pos}) // greatest(CAST(ceil(n / {2.0 * ranks}) AS BIGINT), 1), {2 * ranks - 1})"
    return f"CASE WHEN {chunk} < {ranks} THEN {chunk} ELSE {2 * ranks - 1} - {chunk} END"


_RANKS = (2, 3, 8)


@op("R21", f"WITH {BASE} " + " UNION ALL ".join(f"SELECT {k} AS ranks, seq, pos, CAST({_zig('pos', k)} AS INT) AS rank FROM b" for k in _RANKS))
def r21(spark, d):
    """Zig-zag split over two, three and eight ranks: of 2n chunks, rank r owns chunks r and 2n - 1 - r."""
    x = packed(spark, d).select("seq", "n", F.posexplode("tok").alias("pos", "t"))
    ranks = F.explode(F.array(*[F.struct(F.lit(k).alias("ranks"), tk.zigzag_rank(F.col("pos"), F.col("n"), k).alias("rank")) for k in _RANKS]))
    return x.select("seq", F.col("pos").cast("long").alias("pos"), ranks.alias("z")).select("z.ranks", "seq", "pos", "z.rank")


@op("R25", "SELECT event_type, min(event_id) AS first_seen, count(*) AS n FROM events GROUP BY 1")
def r25(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.min("event_id").alias("first_seen"), F.count(F.lit(1)).alias("n")).orderBy("first_seen")


@op("R27", f"WITH {BASE} SELECT seq, string_agg(CAST(tok AS VARCHAR), ',' ORDER BY pos) AS tokens FROM b GROUP BY seq")
def r27(spark, d):
    """The ranks' chunks of a sequence, put together again in place."""
    x = packed(spark, d).select("seq", "n", F.posexplode("tok").alias("pos", "t"))
    per_rank = x.groupBy("seq", (F.col("pos") % 2).alias("rank")).agg(F.collect_list(F.struct("pos", "t")).alias("part"))
    whole = per_rank.groupBy("seq").agg(F.sort_array(F.flatten(F.collect_list("part"))).alias("all"))
    return whole.select("seq", F.array_join(F.transform("all", lambda s: s["t"].cast("string")), ",").alias("tokens"))


@op("R28", f"WITH {BASE} SELECT ranks, src, dst, count(*) AS tokens FROM (" + " UNION ALL ".join(f"SELECT {k} AS ranks, CAST(pos // greatest(CAST(ceil(n / {float(k)}) AS BIGINT), 1) AS INT) AS src, CAST({_zig('pos', k)} AS INT) AS dst FROM b" for k in _RANKS) + ") GROUP BY 1, 2, 3")
def r28(spark, d):
    """Contiguous to zig-zag: tokens that each rank sends to each other."""
    x = packed(spark, d).select("n", F.posexplode("tok").alias("pos", "t"))
    move = F.explode(F.array(*[F.struct(F.lit(k).alias("ranks"), F.floor(F.col("pos") / F.greatest(F.ceil(F.col("n") / F.lit(float(k))), F.lit(1))).cast("int").alias("src"), tk.zigzag_rank(F.col("pos"), F.col("n"), k).alias("dst")) for k in _RANKS]))
    return x.select(move.alias("z")).groupBy("z.ranks", "z.src", "z.dst").agg(F.count(F.lit(1)).alias("tokens"))


@op("R29", f"WITH {BASE}, c AS (SELECT *, n - (n + 1) // 2 AS m FROM b) " + " UNION ALL ".join(f"SELECT {k} AS ranks, seq, pos - (n - m) AS j, CAST({_zig('pos - 1', k)} AS INT) AS rank, round(train, 6) AS lp FROM c WHERE pos >= n - m" for k in _RANKS))
def r29(spark, d):
    """Every rank's part of the response's log-probabilities (the second half of a sequence): that of the positions that predict them."""
    m = F.col("n") - F.floor((F.col("n") + 1) / 2)
    x = packed(spark, d).select("seq", "n", m.alias("m"), F.posexplode("train").alias("pos", "lp")).where("pos >= n - m").withColumn("j", F.col("pos") - (F.col("n") - F.col("m")))
    ranks = F.explode(F.array(*[F.struct(F.lit(k).alias("ranks"), tk.response_rank(F.col("j"), F.col("n"), F.col("m"), k).alias("rank")) for k in _RANKS]))
    return x.select("seq", "j", "lp", ranks.alias("z")).select("z.ranks", "seq", F.col("j").cast("long").alias("j"), "z.rank", F.round("lp", 6).alias("lp"))


@op("R31", sql("SELECT sample_index, 42 + row_number() OVER (PARTITION BY group_index ORDER BY sample_index) - 1 AS seed FROM s"))
def r31(spark, d):
    w = Window.partitionBy("group_index").orderBy("sample_index")
    return samples(spark, d, "sample_index", "group_index").select("sample_index", (F.row_number().over(w) + 41).cast("long").alias("seed"))


@op("R32", sql("SELECT sample_index, coalesce(session_id, 'sample-' || sample_index) AS session_id FROM s"))
def r32(spark, d):
    """A session id of its own where a sample has none; made from its index, so that retries agree."""
    return samples(spark, d, "sample_index", "session_id").select("sample_index", F.coalesce("session_id", F.concat(F.lit("sample-"), F.col("sample_index"))).alias("session_id"))


@op("R33", sql("SELECT r AS rank, CAST(sum(len) AS BIGINT) AS tokens, count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY sample_index) - 1) % 8 AS r, coalesce(response_length, 0) AS len FROM s) GROUP BY 1"))
def r33(spark, d):
    """Global lengths, projected onto each rank's rows."""
    part = r10(spark, d)
    return samples(spark, d, "sample_index", "response_length").join(part, "sample_index").groupBy("rank").agg(F.sum(F.coalesce("response_length", F.lit(0))).alias("tokens"), F.count(F.lit(1)).alias("n"))


@op("R34", sql("SELECT sample_index, coalesce(status IN ('aborted', 'truncated') AND response_length > 0, false) AS reuse FROM s"))
def r34(spark, d):
    """Token ids of a partial response are reused; others are encoded anew."""
    return samples(spark, d, "sample_index", "status", "response_length").select("sample_index", F.coalesce(F.col("status").isin("aborted", "truncated") & (F.col("response_length") > 0), F.lit(False)).alias("reuse"))


@op("R35", "SELECT count(*) // 32 AS per_epoch, count(*) // 32 * 3 AS rollouts FROM prompts")
def r35(spark, d):
    n = F.floor(F.count(F.lit(1)) / 32)
    return table(spark, d, "prompts").agg(n.cast("long").alias("per_epoch"), (n * 3).cast("long").alias("rollouts"))

"""Filters and aggregates over groups of samples (all responses to one prompt)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import round_label, row_index, running_sum


def reward_filter(df: DataFrame, group: str = "group_index", reward: str = "reward", order: str = "sample_index", least: float = 1e-6) -> DataFrame:
    """Per group whether its rewards differ, and why it is dropped otherwise. A group of one has no deviation and is dropped; null rewards are
    left out."""
    g = df.groupBy(group).agg(F.coalesce(F.stddev_samp(reward) > least, F.lit(False)).alias("keep"), F.min_by(reward, order).alias("_first"))
    return g.select(group, "keep", F.when(~F.col("keep"), F.concat(F.lit("zero_std_"), round_label("_first"))).alias("reason"))


def apply_filter(df: DataFrame, predicate: Callable[[DataFrame], DataFrame] | None, group: str = "group_index") -> DataFrame:
    """Rows of the groups that a predicate (group table with ``keep``) keeps; no predicate keeps all."""
    return df if predicate is None else df.join(predicate(df).where("keep").select(group), group, "left_semi")


def drop_counts(verdicts: DataFrame, prefix: str = "rollout/dynamic_filter/drop_") -> DataFrame:
    """How often each reason dropped a group; empty reasons don't count."""
    return verdicts.where("not keep and reason is not null and reason <> ''").groupBy(F.concat(F.lit(prefix), "reason").alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def collect_first(df: DataFrame, verdicts: DataFrame, n: int, done: str, group: str = "group_index", index: str = "sample_index") -> DataFrame:
    """The first ``n`` passing groups in the order of their completion, sorted by their first sample."""
    g = df.groupBy(group).agg(F.max(done).alias("done"), F.min(index).alias("first_index")).join(verdicts.where("keep").select(group), group, "left_semi")
    return g.orderBy("done", group).limit(n).orderBy("first_index")


def normalize(df: DataFrame, group: str | None = "group_index", reward: str = "reward", std: bool = True) -> DataFrame:
    """Adds ``normalized``: reward less the group's mean, over its sample deviation + 1e-6. ``group=None`` takes the whole table as one group
    (one aggregate row, joined back), as when group sizes differ from the configured one."""
    stats = [F.avg(reward).alias("_mu"), F.stddev_samp(reward).alias("_sd")]
    if group is None:
        x = df.crossJoin(F.broadcast(df.agg(*stats)))  # one row
    else:
        w = Window.partitionBy(group)
        x = df.withColumn("_mu", F.avg(reward).over(w)).withColumn("_sd", F.stddev_samp(reward).over(w))
    out = F.col(reward) - F.col("_mu")
    return x.withColumn("normalized", out / (F.col("_sd") + 1e-6) if std else out).drop("_mu", "_sd")


def normalize_valid(df: DataFrame, group: str = "group_index", reward: str = "reward", eps: float = 1e-8) -> DataFrame:
    """Only rewards in [0, 1] are normalized, by the population deviation of the valid ones; valid rewards that are all 0 stay,
    equal ones become 0, others pass through; ``raw_reward`` keeps the input."""
    w = Window.partitionBy(group)
    ok = F.col(reward).between(0, 1)
    valid = F.when(ok, F.col(reward))
    mu, sd, top = F.avg(valid).over(w), F.stddev_pop(valid).over(w), F.max(valid).over(w)
    out = F.when(~ok | ok.isNull() | (top == 0), F.col(reward)).when(sd < eps, F.lit(0.0)).otherwise((F.col(reward) - mu) / (sd + eps))
    return df.withColumn("raw_reward", F.col(reward)).withColumn(reward, out)


def meta(df: DataFrame, group: str = "group_index", reward: str = "reward") -> DataFrame:
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.sum(reward).alias("_r"), F.count(reward).alias("_k"))
    n = F.coalesce(F.sum("_n"), F.lit(0))
    return g.agg(n.alias("total_samples"), F.count(F.lit(1)).alias("num_groups"), F.coalesce(F.avg("_n"), F.lit(0.0)).alias("avg_group_size"), F.coalesce(F.sum("_r") / F.sum("_k"), F.lit(0.0)).alias("avg_reward"))


def pass_at(n: Column, c: Column, k: int) -> Column:
    """Unbiased estimate of at least one success in k of n tries with c successes."""
    product = F.aggregate(F.sequence((n - c + 1).cast("int"), n.cast("int")), F.lit(1.0), lambda a, i: a * (1 - F.lit(float(k)) / i))
    return F.when(n - c < k, F.lit(1.0)).when(c == 0, F.lit(0.0)).otherwise(1 - product)


def pass_rates(df: DataFrame, size: int, group: str = "group_index", reward: str = "reward", by: str | None = None) -> DataFrame:
    """Mean pass@k over groups of exactly ``size`` samples for k = 1, 2, 4 ..., for each value of ``by`` (a group's largest); a reward of exactly 1 is a success. Size 1 gives no rows."""
    ks = [2**i for i in range(size.bit_length()) if 2**i <= size] if size > 1 else []
    keys = [by] if by else []
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(reward) == 1, 1)).alias("c"), *[F.max(k).alias(k) for k in keys]).where(F.col("n") == size)
    rows = F.array(*[F.struct(F.lit(k).alias("k"), pass_at(F.col("n"), F.col("c"), k).alias("p")) for k in ks]) if ks else F.array().cast("array<struct<k:int,p:double>>")
    return g.select(*keys, F.explode(rows).alias("x")).groupBy(*keys, "x.k").agg(F.avg("x.p").alias("pass_rate"))


def over_sampling(verdicts: DataFrame, order: str, size: int, target: int) -> DataFrame:
    """``batch, submitted, accepted, needed``: batches of ``size`` groups in the order of their completion, and which of them are submitted at all.

    A batch is submitted while fewer than ``target`` groups are in flight or accepted; each rejected group makes room for another. The work ends with the
    ``target``-th accepted group (``verdicts`` has ``keep``).
    """
    x = row_index(verdicts.select(order, F.col("keep").cast("long").alias("_keep"), F.lit(0).alias("_all")), order, name="_row")
    x = running_sum(x, "_all", ["_row"], "_keep", "_before")
    stop = x.where((F.col("_keep") == 1) & (F.col("_before") == target - 1)).agg(F.min("_row").alias("_stop"))
    # rejected groups among those that completed until then
    x = x.crossJoin(F.broadcast(stop)).withColumn("_done", F.col("_stop").isNull() | (F.col("_row") <= F.col("_stop")))  # one row
    rejected = x.where("_done").agg(F.coalesce(F.sum(1 - F.col("_keep")), F.lit(0)).alias("_rejected"))
    b = x.groupBy(F.floor(F.col("_row") / size).alias("batch")).agg(F.count(F.lit(1)).alias("submitted"), F.sum("_keep").alias("accepted"))
    return b.crossJoin(F.broadcast(rejected)).select("batch", "submitted", "accepted", (F.col("batch") * size < target + F.col("_rejected")).alias("needed"))  # one row


def agent_rewards(df: DataFrame, group: str = "group_index", order: str = "sample_index", right: float = 1.2, wrong: float = 0.8) -> DataFrame:
    """``group, order, role, reward`` of the samples that a run of solvers, rewriters and one selector returns.

    ``df`` has ``role, reward, text`` (the whole response) and ``solution`` (null where a stage gave nothing usable), for the selector ``pick``, the 0-based number of
    a usable rewritten solution. Without usable solutions only the solvers come back, without usable rewritings or a selector only solvers and rewriters,
    all times ``wrong``. The selector takes the reward of the first rewriter whose text holds the picked solution, 0 for an unusable pick; all
    rewards are times ``right`` if that is 1, else ``wrong``.
    """
    cols = ["role", "reward", "text", "solution", "pick"]
    g = df.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(order, *cols))).alias("s"))  # the agents of one run

    def of(role: str) -> Column:
        return F.filter("s", lambda e: e["role"] == role)

    usable = F.filter(of("rewriter"), lambda e: e["solution"].isNotNull())
    selector = F.try_element_at(of("selector"), F.lit(1))
    picked = F.when((selector["pick"] >= 0) & (selector["pick"] < F.size(usable)), F.try_element_at(usable, selector["pick"].cast("int") + 1)["solution"])
    holder = F.try_element_at(F.filter(of("rewriter"), lambda e: F.contains(e["text"], picked)), F.lit(1))["reward"]
    stage = F.when(F.size(F.filter(of("solver"), lambda e: e["solution"].isNotNull())) == 0, 1).when((F.size(usable) == 0) | selector.isNull(), 2).otherwise(3)
    own = F.when(picked.isNull(), F.lit(0.0)).otherwise(F.coalesce(holder, selector["reward"]))
    x = g.select(group, stage.alias("_stage"), own.alias("_own"), F.explode("s").alias("e"))
    back = (F.col("e.role") == "solver") | ((F.col("e.role") == "rewriter") & (F.col("_stage") >= 2)) | ((F.col("e.role") == "selector") & (F.col("_stage") == 3))
    factor = F.when((F.col("_stage") == 3) & (F.col("_own") == 1), right).otherwise(wrong)
    return x.where(back).select(group, f"e.{order}", "e.role", (F.when(F.col("e.role") == "selector", F.col("_own")).otherwise(F.col("e.reward")) * factor).alias("reward"))


def perf_metrics(timers: DataFrame, work: DataFrame, step: str) -> DataFrame:
    """``step, metric, value`` from timers (``step, key, seconds``) and work (``step, tokens, flops`` of a forward pass).

    A metric is there if the timers it needs are: throughput with ``actor_train``, its forward rates with ``log_probs`` and ``ref_log_probs``, the waiting share with ``train_wait`` and ``train``.
    """
    t = timers.groupBy(step).agg(F.map_from_entries(F.collect_list(F.struct("key", "seconds"))).alias("t")).join(work, step, "left")

    def at(k: str) -> Column:
        return F.try_element_at("t", F.lit(k))

    train, total = at("actor_train"), at("train_wait") + at("train")
    more = {
        "perf/log_probs_tflops": F.when(train.isNotNull(), F.col("flops") / F.nullif(at("log_probs"), F.lit(0.0))), "perf/ref_log_probs_tflops": F.when(train.isNotNull(), F.col("flops") / F.nullif(at("ref_log_probs"), F.lit(0.0))),
        "perf/actor_train_tflops": F.when(train > 0, 3 * F.col("flops") / train), "perf/actor_train_tok_per_s": F.when(train > 0, F.col("tokens") / train),
        "perf/step_time": F.when(total > 0, total), "perf/wait_time_ratio": F.when(total > 0, at("train_wait") / total),
    }
    times = timers.select(step, F.concat(F.lit("perf/"), "key", F.lit("_time")).alias("metric"), F.col("seconds").alias("value"))
    rest = t.select(step, F.explode(F.map_from_arrays(F.array(*map(F.lit, more)), F.array(*more.values()))).alias("metric", "value")).where("value is not null")
    return times.unionByName(rest)


def zero_std(df: DataFrame, group: str = "group_index", reward: str = "reward", order: str = "sample_index") -> DataFrame:
    """Groups whose rewards are all equal, counted by their reward to one decimal."""
    g = df.groupBy(group).agg(F.min(reward).alias("a"), F.max(reward).alias("b"), F.count(reward).alias("k"), F.count(F.lit(1)).alias("n")).where("a = b and k = n")
    return g.groupBy(F.concat(F.lit("zero_std/count_"), round_label("a")).alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def bag_anti_join(df: DataFrame, skips: DataFrame, key: str, order: str) -> DataFrame:
    """Each entry of ``skips`` removes one row with its key, earliest first."""
    numbered = df.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    count = skips.groupBy(key).agg(F.count(F.lit(1)).alias("_skip"))
    return numbered.join(count, key, "left").where(F.col("_skip").isNull() | (F.col("_nth") > F.col("_skip"))).drop("_nth", "_skip")


def newest_groups(df: DataFrame, n: int, time: Column, group: str = "group_index") -> DataFrame:
    """Rows of the ``n`` groups with the latest time; a group without any time counts as 0."""
    top = df.groupBy(group).agg(F.coalesce(F.max(time), F.lit(0.0)).alias("_t")).orderBy(F.desc("_t"), group).limit(n)
    return df.join(top.select(group), group, "left_semi")

"""Queries of the token-level operators (W*). Sequences are orders, tokens their lines in a fixed order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import tokens as tk
from quillspark.plans.registry import op, table

ORDER = ["l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_linestatus"]
BASE = f"""b AS (SELECT l_orderkey AS seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(ORDER)}) - 1 AS pos,
 -l_discount AS train, -l_tax AS rollout, -(l_discount + l_tax) / 2 AS ref, l_tax AS v, l_discount AS r, l_quantity / 50 - 0.5 AS adv,
 CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS mask, l_partkey AS tok, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)"""


def long(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(*ORDER)
    return li.select(
        F.col("l_orderkey").alias("seq"), (F.row_number().over(w) - 1).alias("pos"), (-F.col("l_discount")).alias("train"), (-F.col("l_tax")).alias("rollout"), (-(F.col("l_discount") + F.col("l_tax")) / 2).alias("ref"), F.col("l_tax").alias("v"), F.col("l_discount").alias("r"),
        (F.col("l_quantity") / 50 - 0.5).alias("adv"), F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("mask"), F.col("l_partkey").alias("tok"),
    )


def packed(spark: SparkSession, d: str) -> DataFrame:
    """One row per sequence with its tokens as arrays; one shuffle, sorted inside the row."""
    li = table(spark, d, "lineitem")
    t = F.sort_array(F.collect_list(F.struct(*ORDER)))
    x = li.groupBy(F.col("l_orderkey").alias("seq")).agg(t.alias("t"))

    def of(fn):
        return F.transform("t", fn)

    return x.select(
        "seq", of(lambda s: -s["l_discount"]).alias("train"), of(lambda s: -s["l_tax"]).alias("rollout"), of(lambda s: -(s["l_discount"] + s["l_tax"]) / 2).alias("ref"), of(lambda s: s["l_tax"]).alias("v"), of(lambda s: s["l_discount"]).alias("r"),
        of(lambda s: s["l_quantity"] / 50 - 0.5).alias("adv"), of(lambda s: F.when(s["l_linestatus"] == "O", 1).otherwise(0)).alias("mask"), of(lambda s: s["l_partkey"]).alias("tok"), F.size("t").alias("n"),
    )


def unpack(df: DataFrame, **cols) -> DataFrame:
    z = df.select("seq", F.posexplode(F.arrays_zip(*[c.alias(k) for k, c in cols.items()])).alias("pos", "z"))
    return z.select("seq", "pos", *[F.round(F.col(f"z.{k}"), 6).alias(k) for k in cols])


def r6(c, name):
    return F.round(c, 6).alias(name)


@op("W1", f"WITH {BASE} SELECT seq, pos, round(train - ref, 6) AS k1, round((train - ref) * (train - ref) / 2, 6) AS k2, round(exp(-(train - ref)) - 1 + (train - ref), 6) AS k3, round(least(greatest(exp(train - rollout) * (exp(-(train - ref)) - 1 + (train - ref)), -10), 10), 6) AS low_var_kl FROM b")
def w1(spark, d):
    x = long(spark, d)
    t, ref = F.col("train"), F.col("ref")
    return x.select("seq", "pos", *[r6(tk.approx_kl(t, ref, k), k) for k in ("k1", "k2", "k3")], r6(tk.approx_kl(t, ref, "low_var_kl", F.exp(t - F.col("rollout"))), "low_var_kl"))


@op("W2", f"WITH {BASE}, f AS (SELECT seq, max(r) AS reward FROM b GROUP BY seq) SELECT b.seq, pos, round(reward, 6) AS ret FROM b JOIN f ON b.seq = f.seq")
def w2(spark, d):
    x = packed(spark, d)
    return unpack(x, ret=tk.broadcast_reward(F.array_max("r"), F.col("train")))


_SEQ_REWARD = "f AS (SELECT seq, max(r) AS reward, max(CASE WHEN mask = 1 THEN pos END) AS last FROM b GROUP BY seq)"


@op("W3", f"WITH {BASE}, {_SEQ_REWARD}, x AS (SELECT b.seq, pos, -0.1 * (train - ref) * mask + CASE WHEN pos = last THEN reward ELSE 0 END AS c FROM b JOIN f ON b.seq = f.seq WHERE last IS NOT NULL) SELECT a.seq, a.pos, round(sum(b.c * pow(exp(-0.1), b.pos - a.pos)), 6) AS ret FROM x a JOIN x b ON a.seq = b.seq AND b.pos >= a.pos GROUP BY a.seq, a.pos")
def w3(spark, d):
    x = packed(spark, d).where(F.exists("mask", lambda m: m > 0))
    kl = F.zip_with("train", "ref", lambda a, b: a - b)
    return unpack(x, ret=tk.reinforce_returns(F.array_max("r"), kl, F.col("mask"), 0.1, math.exp(-0.1)))


@op("W4", f"WITH {BASE}, {_SEQ_REWARD} SELECT b.seq, pos, round(reward - 0.1 * (train - ref), 6) AS a FROM b JOIN f ON b.seq = f.seq")
def w4(spark, d):
    kl = F.zip_with("train", "ref", lambda a, b: a - b)
    return unpack(packed(spark, d), a=tk.baseline_advantages(F.array_max("r"), kl, 0.1))


@op("W5", f"WITH {BASE}, {_SEQ_REWARD} SELECT b.seq, pos, round(-0.1 * (train - ref) + CASE WHEN pos = n - 1 THEN reward ELSE 0 END, 6) AS token_reward FROM b JOIN f ON b.seq = f.seq")
def w5(spark, d):
    kl = F.zip_with("train", "ref", lambda a, b: a - b)
    return unpack(packed(spark, d), token_reward=tk.token_rewards(F.array_max("r"), kl, 0.1))


_GAE_RAW = f"WITH {BASE}, x AS (SELECT seq, pos, v, r + 0.99 * coalesce(lead(v) OVER (PARTITION BY seq ORDER BY pos), 0) - v AS delta FROM b), y AS (SELECT a.seq, a.pos, any_value(a.v) AS v, sum(b.delta * pow(0.99 * 0.95, b.pos - a.pos)) AS adv FROM x a JOIN x b ON a.seq = b.seq AND b.pos >= a.pos GROUP BY a.seq, a.pos) SELECT seq, pos, adv, adv + v AS ret FROM y"
_GAE = f"SELECT seq, pos, round(adv, 6) AS adv, round(ret, 6) AS ret FROM ({_GAE_RAW})"


@op("W6", _GAE)
def w6(spark, d):
    a, r = tk.gae(F.col("r"), F.col("v"), 0.99, 0.95)
    return unpack(packed(spark, d), adv=a, ret=r)


@op("W7", _GAE)
def w7(spark, d):
    """Chunks as small as two tokens, so that the state is handed over inside most sequences."""
    a, r = tk.gae(F.col("r"), F.col("v"), 0.99, 0.95, 2)
    return unpack(packed(spark, d), adv=a, ret=r)


@op("W8", f"WITH x AS ({_GAE_RAW}), m AS (SELECT max(c) AS width FROM (SELECT count(*) AS c FROM x GROUP BY seq)) SELECT seq, width, round(sum(adv), 4) AS total FROM x, m GROUP BY seq, width")
def w8(spark, d):
    """Rows padded with zeros to the longest sequence; padding changes no value."""
    x = packed(spark, d)
    width = x.agg(F.max("n").cast("long").alias("width"))
    x = x.crossJoin(F.broadcast(width))  # one row
    zeros = F.array_repeat(F.lit(0.0), (F.col("width") - F.col("n")).cast("int"))
    y = x.select("seq", "width", "n", tk.gae(F.concat("r", zeros), F.concat("v", zeros), 0.99, 0.95)[0].alias("a"))
    return y.select("seq", F.size("a").cast("long").alias("width"), F.round(F.aggregate(F.slice("a", 1, F.col("n")), F.lit(0.0), lambda a, v: a + v), 4).alias("total"))


@op("W9", f"""WITH {BASE}, {_SEQ_REWARD}, e AS (SELECT b.seq, pos, mask, CASE WHEN b.seq % 2 = 0 THEN reward ELSE reward - 0.1 * (train - ref) END - 0.05 * (train - rollout) AS a FROM b JOIN f ON b.seq = f.seq),
 s AS (SELECT sum(a * mask) / sum(mask) AS mu, (sum(a * a * mask) / sum(mask) - pow(sum(a * mask) / sum(mask), 2)) * sum(mask) / (sum(mask) - 1) AS var FROM e)
 SELECT seq, pos, round((a - mu) / sqrt(var + 1e-8), 5) AS a FROM e, s""")
def w9(spark, d):
    """Estimator by sample (even: broadcast reward, odd: baseline), distillation, then whitening over the whole batch."""
    x = packed(spark, d)
    kl = F.zip_with("train", "ref", lambda a, b: a - b)
    est = F.when(F.col("seq") % 2 == 0, tk.broadcast_reward(F.array_max("r"), kl)).otherwise(tk.baseline_advantages(F.array_max("r"), kl, 0.1))
    x = x.withColumn("a", tk.distill(est, F.col("train"), F.col("rollout"), 0.05))
    flat = x.select("seq", F.posexplode(F.arrays_zip("a", "mask")).alias("pos", "z")).select("seq", "pos", "z.a", "z.mask")
    return tk.whiten(flat, "a", "mask", "w").select("seq", "pos", F.round("w", 5).alias("a"))


@op("W10", f"WITH {BASE} SELECT seq, pos, round(adv - 0.5 * (train - rollout), 6) AS adv, round(train - rollout, 6) AS reverse_kl FROM b")
def w10(spark, d):
    return unpack(packed(spark, d), adv=tk.distill(F.col("adv"), F.col("train"), F.col("rollout"), 0.5), reverse_kl=F.zip_with("train", "rollout", lambda a, b: a - b))


@op("W11", f"WITH {BASE}, k AS (SELECT seq, pos, train, n, sum(mask) OVER (PARTITION BY seq) AS keep FROM b) SELECT seq, CAST(pos - 1 - CASE WHEN keep = 0 THEN 0 ELSE greatest(n - 1 - keep, 0) END AS BIGINT) AS pos, round(train, 6) AS lp FROM k WHERE pos >= 1 AND (keep = 0 OR pos - 1 >= n - 1 - keep)")
def w11(spark, d):
    x = packed(spark, d).withColumn("rows", F.transform("train", lambda t: F.array(t, F.lit(0.0))))
    keep = F.aggregate("mask", F.lit(0), lambda a, m: a + m)
    return unpack(x, lp=tk.teacher_tail(F.col("rows"), keep))


@op("W12", f"WITH {BASE}, s AS (SELECT sum(adv * mask) / sum(mask) AS mu, (sum(adv * adv * mask) / sum(mask) - pow(sum(adv * mask) / sum(mask), 2)) * sum(mask) / (sum(mask) - 1) AS var FROM b) SELECT seq, pos, round((adv - mu) / sqrt(var + 1e-8), 6) AS white FROM b, s")
def w12(spark, d):
    return tk.whiten(long(spark, d), "adv", "mask", "white").select("seq", "pos", F.round("white", 6).alias("white"))


@op("W13", f"WITH {BASE}, s AS (SELECT seq, sum(adv * mask) AS t, greatest(sum(mask), 1) AS m FROM b GROUP BY seq) SELECT round(sum(t / m), 4) AS sample_mean, round(sum(t), 4) AS token_sum FROM s")
def w13(spark, d):
    x = long(spark, d).groupBy("seq").agg(tk.masked("mean", F.col("adv"), F.col("mask").cast("double")).alias("mean"), tk.masked("sum", F.col("adv"), F.col("mask")).alias("total"))
    return x.agg(F.round(F.sum("mean"), 4).alias("sample_mean"), F.round(F.sum("total"), 4).alias("token_sum"))


_RATIO = "exp(train - rollout)"


@op("W14", f"WITH {BASE} SELECT seq, pos, round(greatest(-{_RATIO} * adv, -least(greatest({_RATIO}, 0.98), 1.03) * adv), 6) AS loss, CASE WHEN -least(greatest({_RATIO}, 0.98), 1.03) * adv > -{_RATIO} * adv THEN 1.0 ELSE 0.0 END AS clipped, round(CASE WHEN adv < 0 THEN least(greatest(-{_RATIO} * adv, -least(greatest({_RATIO}, 0.98), 1.03) * adv), -1.02 * adv) ELSE greatest(-{_RATIO} * adv, -least(greatest({_RATIO}, 0.98), 1.03) * adv) END, 6) AS dual FROM b")
def w14(spark, d):
    x, kl = long(spark, d), F.col("rollout") - F.col("train")
    loss, clipped = tk.policy_loss(kl, F.col("adv"), 0.02, 0.03)
    return x.select("seq", "pos", r6(loss, "loss"), clipped.alias("clipped"), r6(tk.policy_loss(kl, F.col("adv"), 0.02, 0.03, 1.02)[0], "dual"))


@op("W15", f"WITH {BASE} SELECT seq, pos, round(sum((rollout - train) * mask) OVER (PARTITION BY seq) / greatest(sum(mask) OVER (PARTITION BY seq), 1), 6) AS seq_kl FROM b")
def w15(spark, d):
    return long(spark, d).select("seq", "pos", r6(tk.masked_over("mean", F.col("rollout") - F.col("train"), F.col("mask").cast("double"), "seq"), "seq_kl"))


@op("W16", f"WITH {BASE}, k AS (SELECT seq, pos, adv, mask, sum((rollout - train) * mask) OVER (PARTITION BY seq) / greatest(sum(mask) OVER (PARTITION BY seq), 1) AS kl FROM b), o AS (SELECT seq, pos, mask, CASE WHEN adv < 0 AND kl > 0.0117 THEN 1 ELSE 0 END AS off FROM k) SELECT seq, CAST(sum(off) AS BIGINT) AS masked, round(sum(off * mask) / greatest(sum(mask), 1), 6) AS frac FROM o GROUP BY seq")
def w16(spark, d):
    """Tokens with a negative advantage in sequences that drifted away are masked."""
    m = F.col("mask").cast("double")
    kl = tk.masked_over("mean", F.col("rollout") - F.col("train"), m, "seq")
    x = long(spark, d).withColumn("kl", kl).withColumn("off", ((F.col("adv") < 0) & (F.col("kl") > 0.0117)).cast("int"))
    return x.groupBy("seq").agg(F.sum("off").alias("masked"), r6(tk.masked("mean", F.col("off"), m), "frac"))


@op("W17", f"""WITH {BASE}, q AS (SELECT *, sum((rollout - train) * mask) OVER (PARTITION BY seq) / greatest(sum(mask) OVER (PARTITION BY seq), 1) AS seq_kl, least(greatest(exp(train - ref), 0.97), 1.02) AS tis FROM b),
 t AS (SELECT seq, mask, CASE WHEN adv < 0 AND seq_kl > 0.0117 THEN 1 ELSE 0 END AS off, greatest(-{_RATIO} * adv, -least(greatest({_RATIO}, 0.98), 1.03) * adv) AS pg, CASE WHEN -least(greatest({_RATIO}, 0.98), 1.03) * adv > -{_RATIO} * adv THEN 1 ELSE 0 END AS clipped,
  exp(ref - train) - 1 + (train - ref) AS kl, rollout - train AS ppo_kl, tis, exp(train - ref) AS raw, abs(rollout - ref) AS diff, -train AS ent FROM q),
 s AS (SELECT seq, greatest(sum(mask), 1) AS m, sum(pg * (1 - off) * tis * mask) AS pg, sum(clipped * mask) AS clipped, sum(off) AS off, sum(kl * mask) AS kl, sum(ppo_kl * mask) AS ppo_kl, sum(raw * mask) AS raw, sum(CASE WHEN tis <> raw THEN mask ELSE 0 END) AS tis_clipped, sum(abs(raw - 1) * mask) AS tis_abs, sum(exp(-ppo_kl) * mask) AS ois, sum(diff * mask) AS diff, sum(ent * mask) AS ent FROM t GROUP BY seq)
 SELECT round(avg(pg / m), 6) AS pg_loss, round(avg(clipped / m), 6) AS pg_clipfrac, round(avg(ppo_kl / m), 6) AS ppo_kl, round(sum(off / m), 6) AS opsm_clipfrac, round(avg(ois / m), 6) AS ois, round(avg(raw / m), 6) AS tis, round(avg(tis_clipped / m), 6) AS tis_clipfrac, round(avg(tis_abs / m), 6) AS tis_abs,
  round(avg(kl / m), 6) AS kl_loss, round(avg(ent / m), 6) AS entropy, round(avg(diff / m), 6) AS logprob_abs_diff, round(avg(pg / m) - 0.01 * avg(ent / m) + 0.1 * avg(kl / m), 6) AS loss FROM s""")
def w17(spark, d):
    """The whole policy loss: clipped surrogate of the new against the old policy, masked sequences, importance weights against a third policy, entropy and KL terms, and what is logged beside them."""
    return tk.policy_loss_report(long(spark, d), eps=(0.02, 0.03), opsm_delta=0.0117, tis=(0.97, 1.02), entropy_coef=0.01, kl_coef=0.1)


@op("W18", f"WITH {BASE} SELECT seq, pos, round(greatest(pow(r + least(greatest(v - r, -0.02), 0.02) - adv, 2), pow(v - adv, 2)), 6) AS loss, CASE WHEN abs(v - r) > 0.02 THEN 1.0 ELSE 0.0 END AS clipped FROM b")
def w18(spark, d):
    loss, clipped = tk.value_loss(F.col("v"), F.col("r"), F.col("adv"), 0.02)
    return long(spark, d).select("seq", "pos", r6(loss, "loss"), clipped.alias("clipped"))


@op("W19", f"WITH {BASE} SELECT seq, pos, round(least(greatest({_RATIO}, 0.97), 1.02), 6) AS weight, CASE WHEN least(greatest({_RATIO}, 0.97), 1.02) <> {_RATIO} THEN 1.0 ELSE 0.0 END AS clipped, round(abs({_RATIO} - 1), 6) AS distance FROM b")
def w19(spark, d):
    w, c, a = tk.truncated_importance(F.col("train"), F.col("rollout"), 0.97, 1.02)
    return long(spark, d).select("seq", "pos", r6(w, "weight"), c.alias("clipped"), r6(a, "distance"))


@op("W20", f"WITH {BASE} SELECT seq, pos, round(CASE WHEN {_RATIO} >= 0.97 AND {_RATIO} <= 1.02 THEN {_RATIO} ELSE 0 END, 6) AS weight FROM b")
def w20(spark, d):
    return long(spark, d).select("seq", "pos", r6(tk.icepop(F.col("train"), F.col("rollout"), 0.97, 1.02), "weight"))


@op("W21", f"WITH {BASE}, s AS (SELECT seq, sum(train * mask) / greatest(sum(mask), 1) AS m FROM b GROUP BY seq) SELECT round(-sum(m), 5) AS sft_loss FROM s")
def w21(spark, d):
    s = long(spark, d).groupBy("seq").agg(tk.masked("mean", F.col("train"), F.col("mask").cast("double")).alias("m"))
    return s.agg(F.round(-F.sum("m"), 5).alias("sft_loss"))


@op("W22", f"WITH {BASE}, s AS (SELECT seq % 4 AS mb, seq, sum(train * mask) AS t, greatest(sum(mask), 1) AS m FROM b GROUP BY seq), g AS (SELECT count(*) AS n FROM s) SELECT mb, round(-sum(t / m) / any_value(n) * 4, 6) AS by_sample, round(-sum(t) / sum(m), 6) AS by_token FROM s, g GROUP BY mb")
def w22(spark, d):
    """Losses of micro-batches, rescaled by samples in the global batch or by tokens."""
    s = long(spark, d).groupBy("seq").agg(F.sum(F.col("train") * F.col("mask")).alias("t"), F.greatest(F.sum("mask"), F.lit(1)).alias("m")).withColumn("mb", F.col("seq") % 4)
    n = s.agg(F.count(F.lit(1)).alias("n"))
    return s.crossJoin(F.broadcast(n)).groupBy("mb").agg(r6(-F.sum(F.col("t") / F.col("m")) / F.max("n") * 4, "by_sample"), r6(-F.sum("t") / F.sum("m"), "by_token"))  # one row


@op("W23", f"WITH {BASE} SELECT seq, round(sum(adv * mask), 6) AS msum, round(sum(adv * mask) / greatest(sum(mask), 1), 6) AS mmean, round(coalesce(min(CASE WHEN mask = 1 THEN adv END), 0), 6) AS mmin, round(coalesce(max(CASE WHEN mask = 1 THEN adv END), 0), 6) AS mmax FROM b GROUP BY seq")
def w23(spark, d):
    m = F.col("mask").cast("double")
    return long(spark, d).groupBy("seq").agg(*[r6(tk.masked(k, F.col("adv"), m), f"m{k}") for k in ("sum", "mean", "min", "max")])


_LEVELS = f"WITH {BASE}, l AS (SELECT seq, pos, train, rollout, mask, train - rollout AS d, sum((train - rollout) * mask) OVER (PARTITION BY seq) AS ds, sum((train - rollout) * mask) OVER (PARTITION BY seq) / greatest(sum(mask) OVER (PARTITION BY seq), 1) AS dg FROM b)"


@op("W24", f"{_LEVELS} SELECT seq, pos, round(exp(least(greatest(d, -20), 20)), 6) AS token, round(exp(least(greatest(ds, -20), 20)), 6) AS sequence, round(exp(least(greatest(dg, -20), 20)), 6) AS geometric FROM l")
def w24(spark, d):
    m = F.col("mask").cast("double")
    return long(spark, d).select("seq", "pos", *[r6(tk.log_ratio(F.col("train"), F.col("rollout"), m, k, "seq"), k) for k in ("token", "sequence", "geometric")])


@op("W25", f"{_LEVELS}, e AS (SELECT seq, pos, mask, exp(d) AS w FROM l) SELECT seq, pos, round(least(greatest(w, 0), 1.02) * mask, 6) AS truncated, round(least(greatest(w, 0.98), 1.02) * mask, 6) AS clipped, round(w * mask, 6) AS weight, CASE WHEN mask = 1 AND w >= 0.98 AND w <= 1.02 THEN 1.0 ELSE 0.0 END AS kept FROM e")
def w25(spark, d):
    m, w = F.col("mask").cast("double"), F.exp(F.col("train") - F.col("rollout"))
    weight, kept = tk.bounded(w, m, "mask", 0.98, 1.02)
    return long(spark, d).select("seq", "pos", r6(tk.bounded(w, m, "truncate", 0.98, 1.02)[0], "truncated"), r6(tk.bounded(w, m, "clip", 0.98, 1.02)[0], "clipped"), r6(weight, "weight"), kept.alias("kept"))


@op("W26", f"{_LEVELS} SELECT seq, bool_or(d < ln(0.92) AND mask = 1) AS vetoed FROM l GROUP BY seq")
def w26(spark, d):
    x = F.max(((F.col("train") - F.col("rollout") < F.log(F.lit(0.92))) & (F.col("mask") == 1)).cast("int"))
    return long(spark, d).groupBy("seq").agg((x == 1).alias("vetoed"))


@op("W27", f"""{_LEVELS}, e AS (SELECT seq, pos, mask, least(greatest(exp(d), 0), 1.02) * mask AS w, CASE WHEN exp(dg) >= 1 / 1.02 AND exp(dg) <= 1.02 THEN mask ELSE 0 END AS k, max(CASE WHEN d < ln(0.92) AND mask = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY seq) AS bad FROM l),
 g AS (SELECT sum(w * mask) / greatest(sum(mask), 1) AS mean FROM e) SELECT seq, pos, round(w / mean, 6) AS weight, CAST(k * (1 - bad) AS DOUBLE) AS kept FROM e, g""")
def w27(spark, d):
    x = tk.mismatch_weights(long(spark, d), "token", "truncate", 1.02, reject_level="geometric", veto=0.92, normalize=True)
    return x.select("seq", "pos", r6(F.col("weight"), "weight"), F.col("kept").cast("double").alias("kept"))


@op("W28", f"""{_LEVELS}, g AS (SELECT seq, -sum(train * mask) / greatest(sum(mask), 1) AS a, -sum(rollout * mask) / greatest(sum(mask), 1) AS b, sum(-d * mask) / greatest(sum(mask), 1) AS kl, sum((exp(d) - d - 1) * mask) / greatest(sum(mask), 1) AS k3, sum(exp(2 * d) * mask) / greatest(sum(mask), 1) - 1 AS c, sum(d * mask) AS s FROM l GROUP BY seq)
 SELECT seq, round(a, 6) AS training_log_ppl, round(b, 6) AS rollout_log_ppl, round(exp(a), 6) AS training_ppl, round(exp(b), 6) AS rollout_ppl, round(kl, 6) AS kl, round(k3, 6) AS k3_kl, round(a - b, 6) AS log_ppl_diff, round(abs(a - b), 6) AS log_ppl_abs_diff, round(exp(a - b), 6) AS ppl_ratio, round(c, 6) AS chi2_token, round(exp(2 * least(greatest(s, -20), 20)) - 1, 6) AS chi2_seq FROM g""")
def w28(spark, d):
    x = tk.mismatch_metrics(long(spark, d))
    return x.select("seq", *[r6(F.col(c), c) for c in x.columns if c != "seq"])


@op("W31", f"WITH {BASE} SELECT seq, coalesce(any_value(n) - min(CASE WHEN mask = 1 THEN pos END), 0) AS response_length FROM b GROUP BY seq")
def w31(spark, d):
    return packed(spark, d).select("seq", tk.response_length(F.col("mask")).cast("long").alias("response_length"))


@op("W32", f"WITH {BASE}, g AS (SELECT seq, pos, tok, pos - row_number() OVER (PARTITION BY seq ORDER BY pos) AS island FROM b WHERE mask = 1) SELECT seq, CAST(min(pos) AS BIGINT) AS start, string_agg(CAST(tok AS VARCHAR), ' ' ORDER BY pos) AS run FROM g GROUP BY seq, island")
def w32(spark, d):
    """Runs of masked-in tokens, as text: gaps and islands."""
    x = long(spark, d).where("mask = 1").withColumn("island", F.col("pos") - F.row_number().over(Window.partitionBy("seq").orderBy("pos")))
    run = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "tok"))), lambda s: s["tok"].cast("string")), " ")
    return x.groupBy("seq", "island").agg(F.min("pos").cast("long").alias("start"), run.alias("run")).drop("island")


@op("W33", f"WITH {BASE} SELECT seq, repeat('0', CAST(3 AS INT)) || string_agg(CAST(mask AS VARCHAR), '' ORDER BY pos) AS mask FROM b GROUP BY seq")
def w33(spark, d):
    return packed(spark, d).select("seq", F.array_join(tk.pad_left(F.col("mask"), F.lit(3)), "").alias("mask"))


@op("W34", f"WITH {BASE} SELECT seq, pos FROM (SELECT seq, pos, mask, lead(mask) OVER (PARTITION BY seq ORDER BY pos) AS nxt FROM b) WHERE mask = 1 AND nxt = 0")
def w34(spark, d):
    x = packed(spark, d).select("seq", F.explode(tk.sublist_positions(F.col("mask"), F.array(F.lit(1), F.lit(0)))).alias("pos"))
    return x.select("seq", F.col("pos").cast("long").alias("pos"))


@op("W35", f"WITH {BASE} SELECT seq, count(*) + 2 AS tokens, CAST(sum(mask) AS BIGINT) AS trained, round(sum(train), 6) AS logprob FROM b GROUP BY seq")
def w35(spark, d):
    """Appends an observation of two tokens: mask 0, log-probability 0."""
    x = packed(spark, d).select("seq", F.concat("tok", F.array(F.lit(-1), F.lit(-2))).alias("tok"), F.concat("mask", F.array_repeat(F.lit(0), 2)).alias("mask"), F.concat("train", F.array_repeat(F.lit(0.0), 2)).alias("lp"))
    return x.select("seq", F.size("tok").cast("long").alias("tokens"), F.aggregate("mask", F.lit(0), lambda a, m: a + m).cast("long").alias("trained"), r6(F.aggregate("lp", F.lit(0.0), lambda a, v: a + v), "logprob"))


@op("W36", f"WITH {BASE} SELECT seq, string_agg(CASE WHEN pos < n // 2 THEN '0' ELSE '1' END, '' ORDER BY pos) AS mask FROM b GROUP BY seq")
def w36(spark, d):
    half = F.floor(F.col("n") / 2).cast("int")
    return packed(spark, d).select("seq", F.array_join(tk.resume_mask(half, F.col("n") - half), "").alias("mask"))


@op("W40", f"WITH {BASE} SELECT CAST(ceil(max(n) / 8.0) * 8 AS BIGINT) AS padded FROM b")
def w40(spark, d):
    return packed(spark, d).agg((F.ceil(F.max("n") / 8.0) * 8).cast("long").alias("padded"))


@op("R22", f"WITH {BASE} SELECT seq, pos, tok, lead(tok) OVER (PARTITION BY seq ORDER BY pos) AS target FROM b")
def r22(spark, d):
    return long(spark, d).select("seq", "pos", "tok", F.lead("tok").over(Window.partitionBy("seq").orderBy("pos")).alias("target"))


@op("R23", f"WITH {BASE}, k AS (SELECT *, sum(mask) OVER (PARTITION BY seq) AS len FROM b) SELECT seq, CAST(pos - (n - len) AS BIGINT) AS pos, round(train, 6) AS lp FROM k WHERE pos >= n - len")
def r23(spark, d):
    """The response's part of a sequence: its last tokens; a response of length 0 has none."""
    x = packed(spark, d).withColumn("len", F.aggregate("mask", F.lit(0), lambda a, m: a + m)).where("len > 0")
    return unpack(x, lp=F.slice("train", -F.col("len"), F.col("len")))


@op("R30", f"WITH {BASE} SELECT seq, pos, pos % 8 AS expert FROM b")
def r30(spark, d):
    x = packed(spark, d).select("seq", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i % 8)).alias("pos", "expert"))
    return x.select("seq", F.col("pos").cast("long").alias("pos"), F.col("expert").cast("long").alias("expert"))

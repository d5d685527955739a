"""Token-level operators on packed arrays and on long tables.

Packed functions take array columns of one sample and stay inside the JVM; long functions take the columns of one token
per row. Scans run over an array in reverse with one ``aggregate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import CHUNK, reverse_scan


def zero() -> Column:
    return F.lit(0.0)


# ---- per token ----------------------------------------------------------------------------------------------------
def approx_kl(lp: Column, base: Column, kind: str, ratio: Column | None = None) -> Column:
    """Estimators of the KL divergence of two policies from log-probabilities; only ``low_var_kl`` is clamped to 10."""
    d = lp - base
    if kind == "k1":
        kl = d
    elif kind == "k2":
        kl = d * d / 2
    elif kind in ("k3", "low_var_kl"):
        kl = F.exp(-d) - 1 + d
    else:
        raise ValueError(f"unknown KL estimator {kind!r}")
    kl = ratio * kl if ratio is not None else kl
    return F.least(F.greatest(kl, F.lit(-10.0)), F.lit(10.0)) if kind == "low_var_kl" else kl


def policy_loss(kl: Column, advantage: Column, low: float, high: float, dual: float | None = None) -> tuple[Column, Column]:
    """Clipped surrogate loss and whether the clip was active; ``kl`` is old minus new log-probability."""
    ratio = F.exp(-kl)
    free, held = -ratio * advantage, -F.least(F.greatest(ratio, F.lit(1 - low)), F.lit(1 + high)) * advantage
    loss = F.greatest(free, held)
    if dual is not None:
        if dual <= 1:
            raise ValueError("the dual clip must be above 1")
        loss = F.when(advantage < 0, F.least(loss, -dual * advantage)).otherwise(loss)
    return loss, (held > free).cast("double")


def value_loss(value: Column, old: Column, target: Column, clip: float) -> tuple[Column, Column]:
    held = old + F.least(F.greatest(value - old, F.lit(-clip)), F.lit(clip))
    return F.greatest((held - target) ** 2, (value - target) ** 2), (F.abs(value - old) > clip).cast("double")


def truncated_importance(train: Column, rollout: Column, low: float, high: float) -> tuple[Column, Column, Column]:
    """Weight clamped to the bounds, whether it was clamped, and the distance of the raw ratio from 1."""
    raw = F.exp(train - rollout)
    weight = F.least(F.greatest(raw, F.lit(low)), F.lit(high))
    return weight, (weight != raw).cast("double"), F.abs(raw - 1)


def icepop(train: Column, rollout: Column, low: float, high: float) -> Column:
    raw = F.exp(train - rollout)
    return F.when((raw >= low) & (raw <= high), raw).otherwise(zero())


def bounded(weight: Column, mask: Column, mode: str, low: float, high: float) -> tuple[Column, Column]:
    """Weight and mask after ``truncate`` (above only), ``clip`` (both sides) or ``mask`` (reject outside the bounds)."""
    if mode == "truncate":
        return F.least(F.greatest(weight, zero()), F.lit(high)) * mask, mask
    if not low < high:
        raise ValueError("the lower bound must be below the upper bound")
    if mode == "clip":
        return F.least(F.greatest(weight, F.lit(low)), F.lit(high)) * mask, mask
    if mode == "mask":
        return weight * mask, mask * ((weight >= low) & (weight <= high)).cast("double")
    raise ValueError(f"unknown mode {mode!r}")


# ---- masked reductions over a window or a group -------------------------------------------------------------------
def masked(kind: str, x: Column, mask: Column) -> Column:
    """``sum``, ``mean``, ``min`` or ``max`` over the tokens with mask 1; 0 where there are none."""
    if kind == "sum":
        return F.sum(x * mask)
    if kind == "mean":
        return F.sum(x * mask) / F.greatest(F.sum(mask), F.lit(1.0))
    inside = F.when(mask > 0, x)
    return F.coalesce(F.min(inside) if kind == "min" else F.max(inside), zero())


def masked_over(kind: str, x: Column, mask: Column, seq: str) -> Column:
    """As :func:`masked`, repeated on every token of the sequence."""
    w = Window.partitionBy(seq)
    if kind == "sum":
        return F.sum(x * mask).over(w)
    if kind == "mean":
        return F.sum(x * mask).over(w) / F.greatest(F.sum(mask).over(w), F.lit(1.0))
    inside = F.when(mask > 0, x)
    return F.coalesce((F.min(inside) if kind == "min" else F.max(inside)).over(w), zero())


def log_ratio(train: Column, rollout: Column, mask: Column, level: str, seq: str, bound: float = 20.0) -> Column:
    """Importance weight at ``token``, ``sequence`` or ``geometric`` level; the log ratio is clamped to +-20."""
    d = train - rollout
    if level == "sequence":
        d = masked_over("sum", d, mask, seq)
    elif level == "geometric":
        d = masked_over("mean", d, mask, seq)
    elif level != "token":
        raise ValueError(f"unknown level {level!r}")
    return F.exp(F.least(F.greatest(d, F.lit(-bound)), F.lit(bound)))


def mismatch_weights(df: DataFrame, level: str = "token", mode: str = "truncate", high: float = 2.0, low: float | None = None, reject_level: str | None = None, reject_low: float | None = None, reject_high: float | None = None, veto: float | None = None, normalize: bool = False) -> DataFrame:
    """Adds ``weight`` and ``kept`` to a long table ``seq, pos, train, rollout, mask``.

    Missing bounds default as follows: ``low`` to 1/high, the rejection bounds to those of the weights. With
    ``normalize`` the weights are divided by their mean over tokens or sequences, which the geometric level does not allow.
    """
    low = 1 / high if low is None else low
    t, r, m = F.col("train"), F.col("rollout"), F.col("mask").cast("double")
    weight, kept = bounded(log_ratio(t, r, m, level, "seq"), m, mode, low, high)
    out = df.withColumn("weight", weight).withColumn("kept", kept)
    if reject_level:
        _, kept = bounded(log_ratio(t, r, m, reject_level, "seq"), F.col("kept"), "mask", low if reject_low is None else reject_low, high if reject_high is None else reject_high)
        out = out.withColumn("kept", kept)
        if veto is not None:
            bad = F.max((((t - r) < F.log(F.lit(veto))) & (m > 0)).cast("int")).over(Window.partitionBy("seq"))
            out = out.withColumn("kept", F.col("kept") * (1 - bad))
    if normalize:
        if level == "token":
            mean = out.agg((F.sum(F.col("weight") * m) / F.greatest(F.sum(m), F.lit(1.0))).alias("mean"))
        elif level == "sequence":
            mean = out.groupBy("seq").agg(masked("mean", F.col("weight"), m).alias("w")).agg(F.avg("w").alias("mean"))
        else:
            raise ValueError("weights of the geometric level can't be normalized")
        out = out.crossJoin(F.broadcast(mean)).withColumn("weight", F.when(F.col("mean") > 1e-8, F.col("weight") / F.col("mean")).otherwise(F.col("weight"))).drop("mean")  # one row
    return out


def mismatch_metrics(df: DataFrame) -> DataFrame:
    """Per sequence: perplexities of both policies, their ratio, KL estimates and chi-squared divergences."""
    t, r, m = F.col("train"), F.col("rollout"), F.col("mask").cast("double")
    d = t - r
    safe = F.least(F.greatest(d, F.lit(-20.0)), F.lit(20.0))
    sums = df.groupBy("seq").agg(
        (-masked("mean", t, m)).alias("training_log_ppl"), (-masked("mean", r, m)).alias("rollout_log_ppl"), masked("mean", -d, m).alias("kl"), masked("mean", F.exp(d) - d - 1, m).alias("k3_kl"),
        (masked("mean", F.exp(safe) ** 2, m) - 1).alias("chi2_token"), masked("sum", d, m).alias("_sum"),
    )
    diff = F.col("training_log_ppl") - F.col("rollout_log_ppl")
    return sums.select(
        "seq", "training_log_ppl", "rollout_log_ppl", F.exp("training_log_ppl").alias("training_ppl"), F.exp("rollout_log_ppl").alias("rollout_ppl"), "kl", "k3_kl", diff.alias("log_ppl_diff"), F.abs(diff).alias("log_ppl_abs_diff"), F.exp(diff).alias("ppl_ratio"), "chi2_token",
        (F.exp(2 * F.least(F.greatest(F.col("_sum"), F.lit(-20.0)), F.lit(20.0))) - 1).alias("chi2_seq"),
    )


def policy_loss_report(df: DataFrame, eps: tuple[float, float], opsm_delta: float | None = None, tis: tuple[float, float] | None = None, entropy_coef: float = 0.0, kl_coef: float = 0.0, kl_kind: str = "k3", unbiased_kl: bool = False) -> DataFrame:
    """One row: the policy loss of a batch and the metrics beside it, each the mean over sequences of its masked mean.

    ``df`` has ``seq, train`` (new policy), ``rollout`` (old policy), ``ref, adv, mask``. With ``opsm_delta`` tokens of negative advantage in sequences that drifted
    further lose their part in the loss; ``opsm_clipfrac`` sums their number over the sequence's mask over all sequences. With ``tis`` the loss is
    weighted by the ratio of new to reference policy, clamped to those bounds.
    """
    t, r, ref, m = F.col("train"), F.col("rollout"), F.col("ref"), F.col("mask").cast("double")
    kl = r - t
    loss, clipped = policy_loss(kl, F.col("adv"), *eps)
    off = ((F.col("adv") < 0) & (masked_over("mean", kl, m, "seq") > opsm_delta)).cast("double") if opsm_delta is not None else zero()
    weight, cut, distance = truncated_importance(t, ref, *tis) if tis else (F.lit(1.0), zero(), zero())
    x = df.withColumn("_off", off)
    terms = {
        "pg_loss": loss * (1 - F.col("_off")) * weight, "pg_clipfrac": clipped, "ppo_kl": kl, "ois": F.exp(-kl), "tis": F.exp(t - ref), "tis_clipfrac": cut, "tis_abs": distance,
        "kl_loss": approx_kl(t, ref, kl_kind, F.exp(-kl) if unbiased_kl else None), "entropy": -t, "logprob_abs_diff": F.abs(r - ref),
    }
    n = F.greatest(F.sum(m), F.lit(1.0))
    s = x.groupBy("seq").agg((F.sum("_off") / n).alias("opsm_clipfrac"), *[masked("mean", c, m).alias(k) for k, c in terms.items()])
    total = F.avg("pg_loss") - entropy_coef * F.avg("entropy") + kl_coef * F.avg("kl_loss")
    return s.agg(*[F.round(F.avg(k), 6).alias(k) for k in terms], F.round(F.sum("opsm_clipfrac"), 6).alias("opsm_clipfrac"), F.round(total, 6).alias("loss"))


def whiten(df: DataFrame, x: str, mask: str, out: str, shift_mean: bool = True) -> DataFrame:
    """Whitens over all masked tokens of the table: one aggregate row, joined back. Unmasked tokens are transformed too."""
    m = F.col(mask).cast("double")
    s = df.agg(F.sum(F.col(x) * m).alias("_s"), F.sum(F.col(x) ** 2 * m).alias("_q"), F.sum(m).alias("_n"))
    mean = F.col("_s") / F.col("_n")
    var = (F.col("_q") / F.col("_n") - mean**2) * F.when(F.col("_n") >= 2, F.col("_n") / (F.col("_n") - 1)).otherwise(F.lit(1.0))
    s = s.select(F.when(F.col("_n") > 0, mean).otherwise(F.raise_error(F.lit("whitening needs a masked token"))).alias("_mean"), var.alias("_var"))
    white = (F.col(x) - F.col("_mean")) / F.sqrt(F.col("_var") + 1e-8)
    return df.crossJoin(F.broadcast(s)).withColumn(out, white if shift_mean else white + F.col("_mean")).drop("_mean", "_var")  # one row


# ---- scans over packed arrays -------------------------------------------------------------------------------------
def next_values(v: Column) -> Column:
    """V_{t+1}, with 0 after the last token."""
    return F.when(F.size(v) > 0, F.array_append(F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0))), F.lit(0.0))).otherwise(v)


def gae(rewards: Column, values: Column, gamma: float, lam: float, chunk: int = CHUNK) -> tuple[Column, Column]:
    """Generalized advantages and returns of one sequence, scanned in chunks; linear in its length."""
    nxt = next_values(values)
    delta = F.zip_with(F.zip_with(rewards, nxt, lambda r, n: r + gamma * n), values, lambda d, v: d - v)
    adv = reverse_scan(delta, gamma * lam, chunk)
    return adv, F.zip_with(adv, values, lambda a, v: a + v)


def reinforce_returns(reward: Column, kl: Column, mask: Column, beta: float, gamma: float) -> Column:
    """Discounted returns of -beta*kl*mask with the reward on the last token of mask 1; a fully masked row is an error."""
    last = F.size(mask) - F.array_position(F.reverse(F.transform(mask, lambda m: m.cast("int"))), F.lit(1))
    last = F.when(F.exists(mask, lambda m: m > 0), last).otherwise(F.raise_error(F.lit("the sequence has no token with mask 1")))
    cost = F.zip_with(kl, mask, lambda k, m: -beta * k * m)
    return reverse_scan(F.transform(cost, lambda c, i: c + F.when(i == last, reward).otherwise(F.lit(0.0))), gamma)


def token_rewards(reward: Column, kl: Column, beta: float) -> Column:
    """-beta*kl per token, plus the reward on the last position whatever its mask."""
    return F.transform(kl, lambda k, i: -beta * k + F.when(i == F.size(kl) - 1, reward).otherwise(F.lit(0.0)))


def broadcast_reward(reward: Column, kl: Column) -> Column:
    return F.array_repeat(reward, F.size(kl))


def baseline_advantages(reward: Column, kl: Column, beta: float) -> Column:
    return F.transform(kl, lambda k: reward - beta * k)


def distill(adv: Column, student: Column, teacher: Column, coef: float) -> Column:
    """Advantages less the reverse KL to a teacher."""
    return F.zip_with(adv, F.zip_with(student, teacher, lambda s, t: s - t), lambda a, k: a - coef * k)


def teacher_tail(rows: Column, length: Column) -> Column:
    """First element of every entry but the first, the last ``length`` of them; length 0 gives everything."""
    own = F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), lambda x: F.element_at(x, 1))
    return tail(own, length)


def tail(a: Column, n: Column) -> Column:
    """The last n entries as a negative slice gives them: n = 0 gives all."""
    n = F.least(n.cast("int"), F.size(a))
    return F.when(n == 0, a).otherwise(F.slice(a, -n, n))


# ---- masks --------------------------------------------------------------------------------------------------------
def response_length(mask: Column) -> Column:
    """From the first 1 to the end; 0 without one."""
    at = F.array_position(mask, F.lit(1).cast("int"))
    return F.when(at > 0, F.size(mask) - at + 1).otherwise(F.lit(0))


def mask_of_removed(mask: Column, length: Column, removed: Column) -> Column:
    """Default mask of ones; zeros where the sample is removed."""
    return F.when(removed, F.array_repeat(F.lit(0), length)).otherwise(F.coalesce(mask, F.array_repeat(F.lit(1), length)))


def pad_left(mask: Column, by: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(0), by), mask)


def resume_mask(before: Column, new: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(0), before), F.array_repeat(F.lit(1), new))


def span_mask(starts: Column, ends: Column, spans: Column) -> Column:
    """1 for every token whose character range overlaps a span."""
    ranges = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    return F.transform(ranges, lambda t: F.exists(spans, lambda s: (t["a"] < s["b"]) & (t["b"] > s["a"])).cast("int"))


def sublist_positions(a: Column, b: Column) -> Column:
    """0-based positions at which ``b`` stands in ``a``; an empty ``b`` stands nowhere."""
    n = F.size(b)
    at = F.when((n > 0) & (F.size(a) >= n), F.sequence(F.lit(0), F.size(a) - n)).otherwise(F.array().cast("array<int>"))
    return F.filter(at, lambda i: F.slice(a, i + 1, n) == b)


# ---- context-parallel layout --------------------------------------------------------------------------------------
def zigzag_rank(pos: Column, n: Column, ranks: int) -> Column:
    """Rank that owns a position of a sequence of n tokens in 2 x ranks equal chunks: rank r owns chunks r and 2 ranks - 1 - r."""
    chunk = F.least(F.floor(pos / F.greatest(F.ceil(n / F.lit(2.0 * ranks)), F.lit(1))), F.lit(2 * ranks - 1)).cast("int")
    return F.when(chunk < ranks, chunk).otherwise(2 * ranks - 1 - chunk)


def response_rank(j: Column, n: Column, m: Column, ranks: int) -> Column:
    """Rank that owns the log-probability of response token j (of m, the last of n tokens): that of the position before it, which predicts it."""
    return zigzag_rank(n - m - 1 + j, n, ranks)

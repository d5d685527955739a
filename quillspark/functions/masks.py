"""Loss masks of conversations. A tokenizer is pluggable; by default every character is a token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Text before and after a turn, by template family ({role} is the speaker).
TEMPLATES = {"chatml": ("<|im_start|>{role}\n", "<|im_end|>\n"), "plain": ("{role}: ", "\n"), "angle": ("<{role}>", "</{role}>"), "bracket": ("[{role}] ", "\n")}


def render(messages: Column, family: str = "chatml") -> Column:
    """A conversation as text under a fixed template."""
    before, after = TEMPLATES[family]

    def part(text: str, role: Column) -> Column:
        bits = text.split("{role}")
        out = F.lit(bits[0])
        for b in bits[1:]:
            out = F.concat(out, role, F.lit(b))
        return out

    return F.array_join(F.transform(messages, lambda m: F.concat(part(before, m["role"]), F.coalesce(m["content"], F.lit("")), part(after, m["role"]))), "")


def turn_spans(df: DataFrame, key: str, messages: str, family: str = "chatml") -> DataFrame:
    """``key, turn, role, start, end, trained``: character range of each turn's content in the rendered text.

    Assistant turns are trained on, unless their ``step_loss_mask`` is set to anything but 1.
    """
    before, after = TEMPLATES[family]
    n_before = F.length("role") * before.count("{role}") + len(before.replace("{role}", ""))
    n_after = F.length("role") * after.count("{role}") + len(after.replace("{role}", ""))
    x = df.where(F.col(messages).isNotNull()).select(key, F.posexplode(messages).alias("turn", "m")).select(key, "turn", "m.role", F.coalesce("m.content", F.lit("")).alias("content"), F.coalesce("m.step_loss_mask", F.lit(1)).alias("step"))
    w = Window.partitionBy(key).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    size = n_before + F.length("content") + n_after
    start = F.coalesce(F.sum(size).over(w), F.lit(0)) + n_before
    return x.withColumn("start", start).select(key, "turn", "role", "start", (F.col("start") + F.length("content")).alias("end"), ((F.col("role") == "assistant") & (F.col("step") == 1)).alias("trained"))


#: How a conversation is masked: turn by turn, turn by turn behind a fixed first turn, over the whole rendered text, or only the last reply after the first prompt.
FAMILIES = ("per_turn", "prefixed", "full_text", "last_reply")
THINK, HEADER, CLOSE = "<think>\n", "<|im_start|>assistant\n", "<|im_end|>\n"


def trained_ranges(df: DataFrame, key: str, messages: str, family: str = "per_turn") -> DataFrame:
    """``key, turn, start, end``: character ranges that are trained on, in the text that the family renders.

    A reply is trained with the mark that closes it, unless its ``step_loss_mask`` is set to anything but 1. Over the whole text an opening ``<think>`` line belongs
    to the prompt; turn by turn it doesn't. ``last_reply`` renders the first turn and the header of a reply and then the last turn's bare content, whoever speaks.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}")
    x = turn_spans(df, key, messages)
    if family == "last_reply":
        m = F.col(messages)
        first, last = F.try_element_at(m, F.lit(1)), F.try_element_at(m, F.lit(-1))
        start = F.length("role") + F.length(F.lit("<|im_start|>\n")) + F.length("content") + len(CLOSE) + len(HEADER)
        y = df.where(F.size(messages) > 0).select(key, (F.size(m) - 1).alias("turn"), first["role"].alias("role"), F.coalesce(first["content"], F.lit("")).alias("content"), F.length(F.coalesce(last["content"], F.lit(""))).alias("n"), F.coalesce(last["step_loss_mask"], F.lit(1)).alias("step"))
        return y.where("step = 1").select(key, "turn", start.alias("start"), (start + F.col("n")).alias("end"))
    x = x.where("trained")
    skip = F.lit(0)
    if family == "full_text":
        opening = df.where(F.col(messages).isNotNull()).select(key, F.posexplode(messages).alias("turn", "m")).select(key, "turn", F.coalesce(F.col("m.content"), F.lit("")).startswith(THINK).alias("thinks"))
        x = x.join(opening, [key, "turn"])
        skip = F.when(F.col("thinks"), len(THINK)).otherwise(0)
    return x.select(key, "turn", (F.col("start") + skip).alias("start"), (F.col("end") + len(CLOSE)).alias("end"))


def token_masks(df: DataFrame, key: str, messages: str, family: str, token: int = 1) -> DataFrame:
    """``key, mask``: 1 for every token (``token`` characters each) that overlaps a trained range; a conversation without turns has an empty mask."""
    ranges = trained_ranges(df, key, messages, family).groupBy(key).agg(F.collect_list(F.struct(F.col("start").cast("long").alias("a"), F.col("end").cast("long").alias("b"))).alias("spans"))
    if family == "last_reply":
        first, last = F.try_element_at(messages, F.lit(1)), F.try_element_at(messages, F.lit(-1))
        size = F.when(F.size(messages) > 0, F.length(F.concat(render(F.array(first)), F.lit(HEADER), F.coalesce(last["content"], F.lit(""))))).otherwise(0)
    else:
        size = F.length(render(F.col(messages)))
    x = df.where(F.col(messages).isNotNull()).select(key, F.ceil(size / token).cast("int").alias("n")).join(ranges, key, "left")
    starts = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i.cast("long") * token)).otherwise(F.array().cast("array<bigint>"))
    spans = F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>"))
    renamed = F.transform(spans, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))
    return x.select(key, F.transform(starts, lambda t: F.exists(renamed, lambda s: (t < s["b"]) & (t + token > s["a"])).cast("int")).alias("mask"))


def token_budget(df: DataFrame, by: str, order: str, size: Column, budget: int) -> DataFrame:
    """Turns of a conversation while the budget lasts; ``status`` is truncated on the turn that exhausts it, completed on the last."""
    w = Window.partitionBy(by).orderBy(order)
    used = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    x = df.withColumn("used", used).withColumn("before", used - size).withColumn("last", F.lead(order).over(w).isNull())
    return x.where(F.col("before") < budget).withColumn("status", F.when(F.col("used") >= budget, "truncated").when(F.col("last"), "completed").otherwise("pending")).drop("before", "last")

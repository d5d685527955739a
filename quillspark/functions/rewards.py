"""Rewards by the scorer's name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import grading as gr
from . import scoring as sc

#: Names of scorers.
TYPES = ("remote_rm", "deepscaler", "dapo", "math", "f1", "gpqa", "ifbench", "random")


def reward(kind: Column, response: Column, label: Column, metadata: Column | None = None, default: str | None = None, seed: Column | None = None, scorers: dict[str, Callable[[Column, Column], Column]] | None = None) -> Column:
    """The reward of a response by the scorer that ``kind``, else the metadata's ``rm_type``, else ``default`` names.

    ``boxed_`` before a name scores the last box's content, '' without a box. ``scorers`` has further or other scorers by name, as a remote one or one of
    instructions, which the engine has none of. A missing or unknown name is an error. ``random`` is 0 or 1 by the hash of ``seed``, the response by default.
    """
    own = [kind] + ([F.try_element_at(metadata, F.lit("rm_type"))] if metadata is not None else []) + [F.lit(default)]
    name = F.trim(F.coalesce(*[F.nullif(c, F.lit("")) for c in own], F.lit("")))
    boxed = name.startswith("boxed_")
    bare = F.when(boxed, F.substring(name, 7, 1000)).otherwise(name)
    given = F.when(boxed, F.coalesce(gr.unbox_udf(F.when(boxed, response)), F.lit(""))).otherwise(response)

    def of(k: str) -> Column:  # other rows are null for a scorer in Python, which costs nothing
        return F.when(bare == k, given)

    known = {
        "deepscaler": lambda r, t: gr.reasoned_reward_udf(r, t), "dapo": lambda r, t: gr.score_udf(r, t)["score"], "math": lambda r, t: gr.grade_udf(r, t).cast("double"), "f1": lambda r, t: sc.token_f1(r, t)["f1"],
        "gpqa": lambda r, t: sc.choice_reward(r, t), "random": lambda r, t: F.pmod(F.xxhash64(seed if seed is not None else r), F.lit(2)).cast("double"),
    } | (scorers or {})
    out = F.when(bare == "", F.raise_error(F.lit("no scorer is named")).cast("double"))
    for k, fn in known.items():
        out = out.when(bare == k, fn(of(k), label).cast("double"))
    return out.otherwise(F.raise_error(F.concat(F.lit("no scorer for "), bare)).cast("double"))

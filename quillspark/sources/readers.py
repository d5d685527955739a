"""Readers: JSON lines, Parquet, row slices, traces and message columns."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.operators.ordering import row_index


def split_path(path: str) -> tuple[str, int | None, int | None]:
    """``file@[start:end]`` as path and bounds; open bounds are None, negative ones an error."""
    m = re.fullmatch(r"(.*)@\[(-?\d*):(-?\d*)\]", path, re.S)
    if not m:
        return path, None, None
    bounds = [int(x) if x else None for x in m.groups()[1:]]
    if any(b is not None and b < 0 for b in bounds):
        raise ValueError("negative bounds are not supported in a row slice")
    return m.group(1), bounds[0], bounds[1]


def parse_lines(lines: DataFrame, schema: StructType | str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON lines as rows, and the lines that are no JSON of the schema. Blank lines are skipped."""
    x = lines.where(F.trim(column) != "").select(F.trim(column).alias("_line"))
    x = x.withColumn("_ok", F.try_parse_json("_line").isNotNull() & F.col("_line").startswith("{")).withColumn("_row", F.from_json("_line", schema))
    return x.where("_ok").select("_row.*"), x.where("not _ok").select(F.col("_line").alias("line"))


def read_rows(spark: SparkSession, path: str, schema: StructType | str | None = None, order: list[str] | None = None) -> DataFrame:
    """Reads ``.jsonl``/``.json`` or ``.parquet`` by suffix, with an optional row slice.

    A file has no row order of its own in a distributed scan, so a slice needs the columns that define it. Bad JSON lines are skipped.
    """
    file, start, end = split_path(path)
    if file.endswith((".jsonl", ".json")):
        if schema is None:
            raise ValueError("JSON lines need a schema")
        df = parse_lines(spark.read.text(file), schema)[0]
    elif file.endswith(".parquet"):
        df = spark.read.parquet(file)
    else:
        raise ValueError(f"unknown format: {file}")
    if start is None and end is None:
        return df
    if not order:
        raise ValueError("a row slice needs an order")
    x = row_index(df, *order, name="_row")
    keep = F.col("_row") >= (start or 0)
    return x.where(keep & (F.col("_row") < end) if end is not None else keep).drop("_row")


def as_messages(text: Column, messages: Column) -> Column:
    """A conversation: as it is, or one user turn of the text."""
    one = F.array(F.struct(F.lit("user").alias("role"), text.alias("content"), F.lit(None).cast("int").alias("step_loss_mask")))
    return F.coalesce(messages, F.when(text.isNotNull(), one))


def tool_list(text: Column) -> Column:
    """Tools given as JSON text; anything but a list is an error."""
    parsed = F.from_json(text, "array<string>")
    return F.when(text.isNull(), F.lit(None)).when(F.trim(text).startswith("["), parsed).otherwise(F.raise_error(F.lit("tools must be a list")))


def interleave(df: DataFrame, key: str, text: str, media: str, marks: tuple[str, ...] = ("<image>", "<video>", "<audio>")) -> DataFrame:
    """``key, pos, kind, value``: the text's pieces with media in place of its marks, in order. Too few or too many media are an error."""
    mark = "|".join(re.escape(m) for m in marks)
    pieces = F.split(F.regexp_replace(F.col(text), f"({mark})", "\u0001$1\u0001"), "\u0001")
    x = df.select(key, media, F.posexplode(pieces).alias("pos", "piece")).withColumn("is_mark", F.col("piece").isin(*marks).cast("int"))
    w = Window.partitionBy(key)
    nth = F.sum("is_mark").over(w.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("nth", nth).withColumn("marks", F.sum("is_mark").over(w))
    item = F.when(F.col("marks") == F.size(media), F.try_element_at(media, F.col("nth").cast("int"))).otherwise(F.raise_error(F.lit("marks and media differ in number")))
    x = x.where((F.col("is_mark") == 1) | (F.col("piece") != ""))
    return x.select(key, "pos", F.when(F.col("is_mark") == 1, F.regexp_replace("piece", "[<>]", "")).otherwise("text").alias("kind"), F.when(F.col("is_mark") == 1, item).otherwise(F.col("piece")).alias("value"))


def head_and_tail(df: DataFrame, ratio: float, *order: str) -> DataFrame:
    """The first half and the last half of ``int(n * ratio)`` rows; an odd number leaves the larger half at the end."""
    x = row_index(df, *order, name="_row").crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("_n"))))  # one row
    want = F.floor(F.col("_n") * ratio)
    return x.where((F.col("_row") < F.floor(want / 2)) | (F.col("_row") >= F.col("_n") - F.ceil(want / 2))).drop("_row", "_n")


TRACE = "traceEvents array<struct<cat:string,ph:string,name:string,ts:double,dur:double,tid:string>>, deviceProperties array<struct<name:string,totalGlobalMem:bigint,numSms:int>>"


def trace_events(text: DataFrame, column: str = "value") -> DataFrame:
    """Events of Chrome traces, one whole JSON document per row (``spark.read.text(..., wholetext=True)`` reads .gz too)."""
    return text.select(F.explode(F.from_json(column, TRACE)["traceEvents"]).alias("e")).select("e.*")


def image_kind(ref: Column) -> Column:
    """``data`` for a data URI, ``base64`` for bare base64, else ``file``."""
    return F.when(ref.startswith("data:"), "data").when(ref.rlike(r"^[A-Za-z0-9+/]{16,}={0,2}$"), "base64").otherwise("file")


def image_bytes(ref: Column) -> Column:
    return F.when(image_kind(ref) == "data", F.try_to_binary(F.substring_index(ref, ",", -1), F.lit("base64"))).when(image_kind(ref) == "base64", F.try_to_binary(ref, F.lit("base64")))


def message_images(df: DataFrame, key: str, messages: str) -> DataFrame:
    """``key, pos, image`` of the parts of type image that have one, over all messages in order."""
    parts = F.flatten(F.transform(messages, lambda m: m["content"]))
    images = F.transform(F.filter(parts, lambda p: (p["type"] == "image") & p["image"].isNotNull()), lambda p: p["image"])
    return df.select(key, F.posexplode(images).alias("pos", "image"))


def build_dataset(df: DataFrame, prompt: str, messages: str, template: Callable[[Column], Column], tools: str | None = None, max_length: int | None = None) -> DataFrame:
    """``df`` with ``text`` (the prompt, or the conversation under the template), ``metadata`` by default ``{}``, and ``tools`` as a list.

    Rows with neither prompt nor conversation are dropped, and text prompts longer than ``max_length``; conversations are not measured.
    """
    x = df.where(F.col(prompt).isNotNull() | F.col(messages).isNotNull())
    if max_length is not None:
        x = x.where(F.col(prompt).isNull() | (F.length(prompt) <= max_length))
    x = x.withColumn("text", F.coalesce(F.col(prompt), template(F.col(messages)))).withColumn("metadata", F.coalesce("metadata", F.lit("{}")))
    return x.withColumn("tools", tool_list(F.col(tools))) if tools else x


def read_requests(lines: DataFrame, number: str, line: str, rounds: int = 1, cap: int | None = None) -> DataFrame:
    """``replay_round, line_number, payload, error``: every line that isn't blank, ``rounds`` times in order and at most ``cap`` in all.

    A line that is no JSON, or no object, has an error and no payload, and counts against the cap.
    """
    x = row_index(lines.where(F.trim(line) != "").select(F.col(number).alias("line_number"), F.trim(line).alias("_line")), "line_number", name="_place")
    x = x.select("line_number", "_line", "_place", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("replay_round"))
    if cap is not None:
        n = lines.where(F.trim(line) != "").agg(F.count(F.lit(1)).alias("_n"))
        x = x.crossJoin(F.broadcast(n)).where((F.col("replay_round") - 1) * F.col("_n") + F.col("_place") < cap)  # one row
    error = F.when(F.try_parse_json("_line").isNull(), "Invalid JSON").when(~F.col("_line").startswith("{"), "JSON line must be an object")
    return x.select("replay_round", "line_number", F.when(error.isNull(), F.col("_line")).alias("payload"), error.alias("error"))

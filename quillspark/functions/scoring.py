"""Scoring and text functions as Columns; they stay inside the JVM."""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TAGS = "think|search|information|answer"


def strip(s: Column) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def normalize_answer(s: Column) -> Column:
    """Lower case, without ASCII punctuation and articles, single blanks."""
    low = F.regexp_replace(F.translate(F.lower(s), PUNCTUATION, ""), r"\b(a|an|the)\b", " ")
    return F.trim(F.regexp_replace(low, r"[\s\p{Z}]+", " "))


def answer_tokens(s: Column) -> Column:
    return F.filter(F.split(normalize_answer(s), " "), lambda x: x != "")


def token_f1(prediction: Column, truth: Column) -> Column:
    """Struct of f1, precision and recall over the multiset of common tokens; yes, no and noanswer must match exactly.

    Each token is numbered among its equals, so that the common tokens are those of two sets; linear in both texts.
    """
    p, g = answer_tokens(prediction), answer_tokens(truth)
    same = F.size(F.array_intersect(_numbered(p), _numbered(g)))
    np_, ng = normalize_answer(prediction), normalize_answer(truth)
    special = ["yes", "no", "noanswer"]
    none = prediction.isNull() | truth.isNull() | ((np_.isin(*special) | ng.isin(*special)) & (np_ != ng)) | (same == 0)
    precision, recall = same / F.size(p), same / F.size(g)
    zero = F.struct(F.lit(0.0).alias("f1"), F.lit(0.0).alias("precision"), F.lit(0.0).alias("recall"))
    return F.when(none, zero).otherwise(F.struct((2 * precision * recall / (precision + recall)).alias("f1"), precision.alias("precision"), recall.alias("recall")))


@F.arrow_udf(ArrayType(StringType()))
def _numbered(tokens: pa.Array) -> pa.Array:
    """Each token with its number among its equals."""
    out = []
    for row in tokens.to_pylist():
        seen: Counter = Counter()
        numbered = []
        for w in row or ():
            seen[w] += 1
            numbered.append(f"{w} {seen[w]}")
        out.append(numbered)
    return pa.array(out, pa.list_(pa.string()))


def exact_match(prediction: Column, golds: Column) -> Column:
    own = normalize_answer(prediction)
    return F.coalesce(F.exists(golds, lambda g: normalize_answer(g) == own), F.lit(False))


def tag_sequence(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(text, F.lit(rf"(</?(?:{TAGS})>)"), F.lit(1)), "")


def valid_sequence(text: Column, marker: str | None = None) -> Column:
    """think, then search - information - think any number of times, then answer; only blanks between the blocks.

    With a marker only what follows it counts, and a text without it is invalid.
    """
    body = F.substring_index(text, marker, -1) if marker else text
    order = tag_sequence(body).rlike(r"^<think></think>(<search></search><information></information><think></think>)*<answer></answer>$")
    outside = F.regexp_replace(body, r"(?s)<(think|search|information|answer)>.*?</\1>", "")
    ok = order & ~outside.rlike(r"\S")
    return F.coalesce(ok & (text.contains(marker) if marker else F.lit(True)), F.lit(False))


def tag_blocks(text: Column, tag: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1)), lambda x: strip(x))


def answer_of(text: Column, least: int = 2) -> Column:
    """The last answer block, if there are at least two (one of them stands in the prompt)."""
    b = tag_blocks(text, "answer")
    return F.when(F.size(b) >= least, F.element_at(b, -1))


def retrieval_correct(text: Column, golds: Column) -> Column:
    """A golden answer stands in an information block."""
    return F.coalesce(F.exists(tag_blocks(text, "information"), lambda b: F.exists(golds, lambda g: F.contains(normalize_answer(b), normalize_answer(g)))), F.lit(False))


def em_score(text: Column, golds: Column, score: float = 1.0, structure: float = 0.0, retrieval: float = 0.0, final: float = 0.0, least: int = 2) -> Column:
    """Score table of answer, format and retrieval."""
    valid, answer = valid_sequence(text), answer_of(text, least)
    partly = F.when(valid, F.when(retrieval_correct(text, golds), structure + retrieval).otherwise(structure))
    right = answer.isNotNull() & exact_match(answer, golds)
    return F.when(right & valid, score).when(right, score - structure).when(valid, partly).when(answer.isNull(), 0.0).otherwise(F.lit(final))


def after_reasoning(text: Column) -> Column:
    return F.substring_index(text, "</think>", -1)


def choice_letter(text: Column, letters: str = "ABCDEFGHIJ") -> Column:
    """Option letter of a response: three phrasings, then the last capital that stands alone."""
    own = after_reasoning(text)
    found = []
    for p in (r"(?i)(?:answer|option|choice)\s*(?:is|:)?\s*([A-Z])", r"(?i)([A-Z])\s*(?:is\s*(?:the)?\s*correct)", r"(?i)final\s*(?:answer|option)\s*(?:is|:)?\s*([A-Z])"):
        c = F.upper(F.regexp_extract(own, p, 1))
        found.append(F.when((c != "") & F.contains(F.lit(letters), c), c))
    alone = F.filter(F.regexp_extract_all(own, F.lit(r"\b([A-Z])\b"), F.lit(1)), lambda c: F.contains(F.lit(letters), c))
    return F.coalesce(*found, F.try_element_at(alone, F.lit(-1)))


def simple_text(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(s), r"[^a-z0-9]+", " "))


def choice_reward(text: Column, label: Column, letters: str = "ABCDEFGHIJ") -> Column:
    """1 if the chosen letter is the label's; a label that is no letter counts if its words stand in the response."""
    want = F.upper(F.trim(label))
    letter = F.when((F.length(want) == 1) & F.contains(F.lit(letters), want), want)
    got = choice_letter(text, letters)
    said = F.contains(simple_text(after_reasoning(text)), simple_text(label)) & (simple_text(label) != "")
    return F.when(text.isNull(), 0.0).when(got.isNotNull() & letter.isNotNull(), (got == letter).cast("double")).otherwise(F.coalesce(said.cast("double"), F.lit(0.0)))


def action(text: Column) -> Column:
    """First search or answer block: struct of action and content; no block gives null and ''."""
    p = r"(?s)<(search|answer)>(.*?)</\1>"
    kind = F.regexp_extract(text, p, 1)
    return F.struct(F.nullif(kind, F.lit("")).alias("action"), F.trim(F.regexp_extract(text, p, 2)).alias("content"))


def tool_action(text: Column) -> Column:
    """Boxed answer, else code of a tool call, else a code element, else a fenced block."""
    box = F.regexp_extract(text, r"(?s)Answer:\s*\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}", 1)
    call = F.regexp_extract(text, r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>", 1)
    own = F.when(F.get_json_object(call, "$.name") == "code_interpreter", F.nullif(F.get_json_object(call, "$.arguments.code"), F.lit("")))
    code = F.nullif(F.trim(F.regexp_extract(text, r"(?s)<code>(.*?)</code>", 1)), F.lit(""))
    fenced = F.nullif(F.trim(F.regexp_extract(text, r"(?s)```python\s*(.*?)\s*```", 1)), F.lit(""))
    body = F.coalesce(own, code, fenced)
    return F.when(box != "", F.struct(F.lit("answer").alias("action"), F.trim(box).alias("content"))).otherwise(F.struct(F.when(body.isNotNull(), "code").alias("action"), F.coalesce(body, F.lit("")).alias("content")))


def cut_after_tag(text: Column) -> Column:
    """Up to the end of the first search block, else of the first answer block."""
    def upto(tag: str) -> Column:
        return F.concat(F.substring_index(text, tag, 1), F.lit(tag))

    return F.when(text.contains("</search>"), upto("</search>")).when(text.contains("</answer>"), upto("</answer>")).otherwise(text)


def last_tool_call(text: Column) -> Column:
    """Struct of name and arguments (JSON text) of the last tool call; arguments given as a string must be JSON."""
    raw = F.try_element_at(F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"), F.lit(1)), F.lit(-1))
    name = F.coalesce(F.get_json_object(raw, "$.name"), F.get_json_object(raw, "$.function.name"))
    args = F.coalesce(F.get_json_object(raw, "$.arguments"), F.get_json_object(raw, "$.function.arguments"), F.lit("{}"))
    good = (F.coalesce(name, F.lit("")) != "") & F.try_parse_json(args).isNotNull()
    return F.when(good, F.struct(name.alias("name"), args.alias("arguments")))


def last_line(text: Column, cap: int = 512) -> Column:
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: strip(x)), lambda x: x != "")
    return F.substring(F.try_element_at(lines, F.lit(-1)), 1, cap)


def selected_index(text: Column, n: Column) -> Column:
    """0-based index after ``Judgment:``, if it is in range."""
    i = F.regexp_extract(text, r"Judgment:\s*(\d+)", 1).try_cast("int") - 1
    return F.when((i >= 0) & (i < n), i)


def sanitize_query(q: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(q, r"[^\w\s]", " "), r"\s+", " "))


def passages(docs: Column) -> Column:
    """Numbered passages; the first line of each is its title."""
    return F.array_join(F.transform(docs, lambda d, i: F.concat(F.lit("Doc "), (i + 1).cast("string"), F.lit("(Title: "), F.substring_index(d, "\n", 1), F.lit(") "), F.when(F.contains(d, F.lit("\n")), F.substr(d, F.instr(d, "\n") + 1)).otherwise(""), F.lit("\n"))), "")


def compact(text: Column, limit: int = 256) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("...<truncated:"), F.length(text).cast("string"), F.lit(">"))).otherwise(text)


def status_of(finish: Column, status: Column) -> Column:
    return F.when(finish == "length", "truncated").when(finish == "abort", "aborted").when(finish == "stop", "completed").otherwise(status)


def first_source(source: Column, meta: Column) -> Column:
    """Explicit source, then the metadata's ``source``, ``source_name`` and any key that holds the word."""
    def entry(k: str) -> Column:
        return F.nullif(F.try_element_at(meta, F.lit(k)), F.lit(""))

    other = F.try_element_at(F.map_values(F.map_filter(meta, lambda k, v: F.contains(F.lower(k), F.lit("source")) & v.isNotNull() & (v != ""))), F.lit(1))
    return F.coalesce(F.nullif(source, F.lit("")), entry("source"), entry("source_name"), other)


def flops(n: Column, hidden: int, heads: int, kv_heads: int, head: int, ffn: int, layers: int, vocab: int, q_rank: int | None = None, kv_rank: int | None = None, qk_head: int = 0, rope_head: int = 0, v_head: int = 0, experts: int | None = None, expert_ffn: int = 0, top_k: int = 1, shared_ffn: int = 0, moe_every: int | list[int] | None = None) -> Column:
    """Forward cost of one sequence of a decoder, quadratic in its length.

    Low-rank projections (``q_rank``, ``kv_rank``) and split heads change projections and attention; with ``experts`` the layers that ``moe_every`` names (all
    without it; every k-th with a number; those above 0 with a list) have ``top_k`` experts and the shared one instead of the dense block.
    """
    n = n.cast("double")
    q = 2 * hidden * heads * head if q_rank is None else 2 * q_rank * (hidden + heads * (qk_head + rope_head))
    kv = 4 * hidden * kv_heads * head if kv_rank is None else 2 * (kv_rank * (hidden + heads * (qk_head + v_head)) + hidden * rope_head)
    attention = heads * ((qk_head + rope_head if rope_head else head) + (v_head or head))
    if experts is None:
        dense = layers
    elif isinstance(moe_every, list):
        dense = sum(f == 0 for f in moe_every)
    else:
        dense = 0 if moe_every is None else layers - -(-layers // moe_every)
    moe = 0 if experts is None else sum(f > 0 for f in moe_every) if isinstance(moe_every, list) else layers - dense
    blocks = dense * ffn + moe * (expert_ffn * top_k + shared_ffn)
    linear = (dense + moe) * (q + kv + 2 * hidden * hidden) + 6 * hidden * blocks + 2 * hidden * vocab
    return n * F.lit(float(linear)) + n * n * F.lit(float((dense + moe) * attention))


@F.arrow_udf(ArrayType(IntegerType()))
def _decode(raw: pa.Array) -> pa.Array:
    return pa.array([None if b is None else np.frombuffer(b[: len(b) // 4 * 4], dtype="<i4") for b in raw.to_pylist()], pa.list_(pa.int32()))


def decode_int32(code: Column) -> Column:
    """Little-endian 32-bit integers from base64; a rest of less than four bytes is left out."""
    return _decode(F.unbase64(code))


def reshape(values: Column, layers: int, top_k: int) -> Column:
    """Flat values as tokens x layers x top_k; a number that doesn't divide is an error."""

    @F.arrow_udf("array<array<array<int>>>")
    def shape(flat: pa.Array) -> pa.Array:
        if any(v is not None and len(v) % (layers * top_k) for v in flat.to_pylist()):
            raise ValueError("the values don't fill the shape")
        inner = pa.list_(pa.list_(pa.list_(pa.int32())))
        return pa.array([None if v is None else np.reshape(v, (-1, layers, top_k)).tolist() for v in flat.to_pylist()], inner)

    return shape(values)


def paragraphs(text: Column, snippets: Column) -> Column:
    """The lines around each snippet that stands in the text (line breaks read as blanks), each once, in the order of the snippets."""
    flat = F.replace(text, F.lit("\n"), F.lit(" "))

    def around(s: Column) -> Column:
        pos = F.position(s, flat)
        before = F.length(F.regexp_extract(F.substr(text, F.lit(1), pos - 1), r"[^\n]*\z", 0))
        after = F.length(F.regexp_extract(F.substr(text, pos + F.length(s)), r"^[^\n]*", 0))
        return F.when((F.length(s) > 0) & (pos > 0), strip(F.substr(text, pos - before, before + F.length(s) + after)))

    return F.array_join(F.array_distinct(F.filter(F.transform(snippets, around), lambda p: p.isNotNull())), "\n")


def first_call(text: Column) -> tuple[Column, Column]:
    """Name and arguments (JSON text) of the first tool call; without one, or if its arguments are no JSON object, ``respond`` with the whole text."""
    raw = F.try_element_at(F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"), F.lit(1)), F.lit(1))
    args = F.get_json_object(raw, "$.arguments")
    good = F.try_parse_json(raw).isNotNull() & F.try_parse_json(args).isNotNull() & F.trim(args).startswith("{")
    return F.when(good, F.coalesce(F.get_json_object(raw, "$.name"), F.lit(""))).otherwise("respond"), F.when(good, args).otherwise(F.to_json(F.struct(text.alias("content"))))


def kwargs_list(raw: Column, n: Column) -> Column:
    """Arguments of ``n`` instructions from JSON text, as JSON objects without nulls: a list is cut or filled up with its last, an object repeated, anything else gives empty ones."""
    return _kwargs(raw, n)


@F.arrow_udf(ArrayType(StringType()))
def _kwargs(raw: pa.Array, n: pa.Array) -> pa.Array:
    out = []
    for text, k in zip(raw.to_pylist(), n.to_pylist(), strict=True):
        try:
            value = json.loads(text) if text else None
        except ValueError:
            value = None
        own = [v if isinstance(v, dict) else {} for v in value] if isinstance(value, list) else [value] * k if isinstance(value, dict) else []
        own = (own + [own[-1] if own else {}] * max(0, k - len(own)))[:k]
        out.append([json.dumps({a: b for a, b in v.items() if b is not None}, sort_keys=True) for v in own])
    return pa.array(out, pa.list_(pa.string()))


def instruction_ids(ids: Column) -> Column:
    """Identifiers without blanks around them; null and blank ones are left out."""
    return F.filter(F.transform(ids, strip), lambda x: x.isNotNull() & (x != ""))


def result_length(attribute: Column, mask: Column, tokens: Column) -> Column:
    """Length of a result: its own attribute, else the number of its mask's entries, else of its tokens, else 0."""
    return F.coalesce(attribute, F.when(mask.isNotNull(), F.size(mask)), F.when(tokens.isNotNull(), F.size(tokens)), F.lit(0))

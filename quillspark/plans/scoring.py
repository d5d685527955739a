"""Queries of the scoring functions (U*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.functions import grading as gr
from quillspark.functions import rewards
from quillspark.functions import scoring as sc
from quillspark.functions.remote import remote_reward
from quillspark.plans.registry import op, table
from quillspark.plans.tokens import r6

T = "t AS (SELECT DISTINCT sample_index, prompt, response, label, reward, status, response_length FROM samples WHERE response IS NOT NULL)"


def texts(spark, d, *cols):
    return table(spark, d, "samples").where("response is not null").select("sample_index", *cols).distinct()


def q(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([T, *ctes])} {body}"


def norm(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '[!-/:-@\[-`{{-~]', '', 'g'), '\b(a|an|the)\b', ' ', 'g'), '[\s\p{{Z}}]+', ' ', 'g'))"


_N = f"n AS (SELECT sample_index, response, label, {norm('response')} AS np, {norm('label')} AS ng FROM t)"
_K = "k AS (SELECT *, list_filter(string_split(np, ' '), lambda x: x <> '') AS p, list_filter(string_split(ng, ' '), lambda x: x <> '') AS g FROM n)"
_C = "c AS (SELECT *, list_sum(list_transform(list_distinct(g), lambda w: least(len(list_filter(p, lambda x: x = w)), len(list_filter(g, lambda x: x = w))))) AS same FROM k)"
_F1 = "CASE WHEN label IS NULL OR coalesce(same, 0) = 0 OR ((np IN ('yes', 'no', 'noanswer') OR ng IN ('yes', 'no', 'noanswer')) AND np <> ng) THEN 0 ELSE 2 * (same / len(p)) * (same / len(g)) / (same / len(p) + same / len(g)) END"


def flaky_client():
    """Stands in for a service: every third call fails once; the score is the label's length."""
    calls = {"n": 0}

    def call(payload: dict) -> float:
        calls["n"] += 1
        if calls["n"] % 3 == 0:
            raise ConnectionError
        return float(len(payload["label"] or ""))

    return call


@op("U3", q("SELECT sample_index, CAST(coalesce(length(label), 0) AS DOUBLE) AS reward FROM t"))
def u3(spark, d):
    """A remote scorer with retries."""
    return remote_reward(texts(spark, d, "prompt", "response", "label"), "sample_index", flaky_client, sleep=lambda s: None)


@op("U4", q("SELECT sample_index, np AS normalized FROM n", _N))
def u4(spark, d):
    return texts(spark, d, "response").select("sample_index", sc.normalize_answer(F.col("response")).alias("normalized"))


@op("U5", q(f"SELECT sample_index, round({_F1}, 6) AS f1 FROM c", _N, _K, _C))
def u5(spark, d):
    return texts(spark, d, "response", "label").select("sample_index", r6(sc.token_f1(F.col("response"), F.col("label"))["f1"], "f1"))


@op("U6", q("SELECT sample_index, coalesce(np = ng, false) AS em FROM n", _N))
def u6(spark, d):
    return texts(spark, d, "response", "label").select("sample_index", sc.exact_match(F.col("response"), F.array("label")).alias("em"))


_VALID = r"regexp_matches(array_to_string(regexp_extract_all(response, '</?(?:think|search|information|answer)>'), ''), '^<think></think>(<search></search><information></information><think></think>)*<answer></answer>$') AND NOT regexp_matches(regexp_replace(response, '(?s)<think>.*?</think>|<search>.*?</search>|<information>.*?</information>|<answer>.*?</answer>', '', 'g'), '\S')"


@op("U7", q(f"SELECT sample_index, {_VALID} AS valid FROM t"))
def u7(spark, d):
    return texts(spark, d, "response").select("sample_index", sc.valid_sequence(F.col("response")).alias("valid"))


_ANS = "list_transform(regexp_extract_all({c}, '(?s)<answer>(.*?)</answer>', 1), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))"


@op("U8", q(f"SELECT sample_index, CASE WHEN len(a) >= 2 THEN a[-1] END AS answer FROM (SELECT sample_index, {_ANS.format(c=chr(39) + '<answer> and </answer>' + chr(39) + ' || response')} AS a FROM t)"))
def u8(spark, d):
    """The prompt holds one answer block, so the response's counts from the second on."""
    return texts(spark, d, "response").select("sample_index", sc.answer_of(F.concat(F.lit("<answer> and </answer>"), "response")).alias("answer"))


_INFO = f"len(list_filter(regexp_extract_all(response, '(?s)<information>(.*?)</information>', 1), lambda x: contains({norm('x')}, ng))) > 0"


@op("U9", q(f"SELECT sample_index, coalesce({_INFO}, false) AS hit FROM n", _N))
def u9(spark, d):
    return texts(spark, d, "response", "label").select("sample_index", sc.retrieval_correct(F.col("response"), F.array("label")).alias("hit"))


@op("U10", q(f"""SELECT sample_index, CAST(CASE WHEN a IS NOT NULL AND {norm('a')} = ng AND v THEN 1 WHEN a IS NOT NULL AND {norm('a')} = ng THEN 0.8 WHEN v AND hit THEN 0.5 WHEN v THEN 0.2 WHEN a IS NULL THEN 0 ELSE 0.1 END AS DOUBLE) AS score
 FROM (SELECT sample_index, ng, {_VALID} AS v, {_ANS.format(c='response')}[-1] AS a, coalesce({_INFO}, false) AS hit FROM n)""", _N))
def u10(spark, d):
    return texts(spark, d, "response", "label").select("sample_index", sc.em_score(F.col("response"), F.array("label"), 1.0, 0.2, 0.3, 0.1, least=1).cast("double").alias("score"))


_LETTER = r"""coalesce(
 CASE WHEN regexp_matches(nullif(upper(regexp_extract(own, '(?i)(?:answer|option|choice)\s*(?:is|:)?\s*([A-Z])', 1)), ''), '^[A-J]$') THEN upper(regexp_extract(own, '(?i)(?:answer|option|choice)\s*(?:is|:)?\s*([A-Z])', 1)) END,
 CASE WHEN regexp_matches(nullif(upper(regexp_extract(own, '(?i)([A-Z])\s*(?:is\s*(?:the)?\s*correct)', 1)), ''), '^[A-J]$') THEN upper(regexp_extract(own, '(?i)([A-Z])\s*(?:is\s*(?:the)?\s*correct)', 1)) END,
 CASE WHEN regexp_matches(nullif(upper(regexp_extract(own, '(?i)final\s*(?:answer|option)\s*(?:is|:)?\s*([A-Z])', 1)), ''), '^[A-J]$') THEN upper(regexp_extract(own, '(?i)final\s*(?:answer|option)\s*(?:is|:)?\s*([A-Z])', 1)) END,
 list_filter(regexp_extract_all(own, '\b([A-Z])\b', 1), lambda c: c BETWEEN 'A' AND 'J')[-1])"""
_OWN = "o AS (SELECT sample_index, label, string_split(response, '</think>')[-1] AS own FROM t)"
_SIMPLE = "trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"


@op("U11", q(f"SELECT sample_index, CAST(CASE WHEN got IS NOT NULL AND regexp_matches(upper(trim(label)), '^[A-J]$') THEN CASE WHEN got = upper(trim(label)) THEN 1 ELSE 0 END WHEN label IS NOT NULL AND {_SIMPLE.format(c='label')} <> '' AND contains({_SIMPLE.format(c='own')}, {_SIMPLE.format(c='label')}) THEN 1 ELSE 0 END AS DOUBLE) AS reward FROM (SELECT *, {_LETTER} AS got FROM o)", _OWN))
def u11(spark, d):
    return texts(spark, d, "response", "label").select("sample_index", sc.choice_reward(F.col("response"), F.col("label")).cast("double").alias("reward"))


@op("U12", "SELECT prompt_id, 1 + prompt_id % 3 AS n, CASE WHEN json_type(TRY_CAST(metadata AS JSON)) = 'OBJECT' THEN len(list_filter(json_keys(TRY_CAST(metadata AS JSON)), lambda k: json_type(TRY_CAST(metadata AS JSON), '$.' || k) <> 'NULL')) ELSE 0 END AS keys, (1 + prompt_id % 3 > 1) AS filled FROM prompts")
def u12(spark, d):
    """Arguments of one to three instructions from JSON meta data: an object is repeated, broken JSON gives empty ones; nulls are dropped."""
    n = (1 + F.col("prompt_id") % 3).cast("int")
    x = table(spark, d, "prompts").select("prompt_id", sc.kwargs_list(F.col("metadata"), n).alias("k"))
    first, last = F.element_at("k", 1), F.element_at("k", -1)
    same = F.when(first == last, F.size("k") > 1).otherwise(F.raise_error(F.lit("copies differ")))
    return x.select("prompt_id", F.size("k").cast("long").alias("n"), F.coalesce(F.size(F.json_object_keys(first)), F.lit(0)).cast("long").alias("keys"), same.alias("filled"))


_BOX = r"regexp_extract_all(response, '\\boxed\{{((?:[^{{}}]|\{{[^{{}}]*\}})*)\}}', 1)[-1]".replace("{{", "{").replace("}}", "}")


@op("U13", q(f"SELECT sample_index, '\\boxed{{' || {_BOX} || '}}' AS box FROM t WHERE {_BOX} IS NOT NULL"))
def u13(spark, d):
    return texts(spark, d, "response").select("sample_index", gr.last_box_udf("response").alias("box")).where("box is not null")


@op("U14", q(f"SELECT sample_index, {_BOX} AS content FROM t WHERE {_BOX} IS NOT NULL"))
def u14(spark, d):
    return texts(spark, d, "response").select("sample_index", gr.unbox_udf("response").alias("content")).where("content is not null")


def text_sql(s: str) -> str:
    """A text as an SQL literal."""
    return "chr(10)".join(f"'{p}'" for p in s.replace("'", "''").split("\n")).replace("'chr(10)'", "' || chr(10) || '")


def final_sql(c: str) -> str:
    """The final answer's canonical form in SQL."""
    out = f"string_split({c}, '=')[-1]"
    for a, b in [*gr.REPLACED, *((r, "") for r in gr.REMOVED)]:
        out = f"replace({out}, {text_sql(a)}, {text_sql(b)})"
    out = f"regexp_replace({out}, '[^\\n$]*\\$([^\\n$]*)\\$[^\\n]*', '$\\1$', 'g')"
    for command in ("text", "textbf", "overline"):
        out = f"regexp_replace({out}, '\\\\{command}\\{{([^\\n]*?)\\}}', '\\1', 'g')"
    out = f"regexp_replace({out}, '\\\\boxed\\{{([^\\n]*)\\}}', '\\1', 'g')"
    out = f"replace(regexp_replace(regexp_replace({out}, 'frac([^{{])([^\\n])', 'frac{{\\1}}{{\\2}}', 'g'), 'sqrt([^{{])', 'sqrt{{\\1}}', 'g'), '$', '')"
    return f"(SELECT regexp_replace(CASE WHEN regexp_matches(replace(o, ',', ''), '^[0-9]+$') THEN replace(o, ',', '') ELSE o END, '^\\s+|\\s+$', '', 'g') FROM (SELECT {out} AS o))"


#: Answers and their normal forms: final, plain and by value.
CASES = [
    ("x = 5", "5", "5", "x=5"), ("\\frac12", "\\frac{1}{2}", "\\frac{1}{2}", "12"), ("\\sqrt3", "\\sqrt{3}", "\\sqrt{3}", "3"), ("1,234", "1234", "1,234", "1234"), ("$5$ dollars", "5", "$5$dollars", "5dollars"),
    ("12 cm", "12", "12cm", "12"), ("\\boxed{7}", "7", "\\boxed{7}", "7"), ("\\textbf{A}", "A", "\\textbf{A}", "a"), ("the value $x+1$ holds\nand $y$", "x+1\ny", "thevalue$x+1$holdsand$y$", "thevaluex+1holds\nandy"),
    ("0.5", "0.5", "\\frac{1}{2}", "0.5"), ("3/4", "3/4", "\\frac{3}{4}", "3/4"), ("2 million", "2million", "2million", "2*10^6"), ("7 1/2", "71/2", "\\frac{71}{2}", "7+1/2"), ("\\text{yes}", "yes", "yes", "yes"), ("40\\%", "40\\%", "40", "40"), ("\\frac{3}{4}", "\\frac{3}{4}", "\\frac{3}{4}", "3/4"),
]


def _normal(kind: int, label: str) -> str:
    """SQL of the labels' normal forms (they hold no TeX), and of the cases."""
    cases = ", ".join(f"({-i - 1}, {text_sql(c[kind])})" for i, c in enumerate(CASES))
    return q(f"SELECT sample_index, {label} AS normal FROM t WHERE label IS NOT NULL UNION ALL SELECT * FROM (VALUES {cases}) AS v(a, b)")


def _with_cases(spark, d, fn):
    cases = spark.createDataFrame([(-i - 1, c[0]) for i, c in enumerate(CASES)], "sample_index bigint, label string")
    return texts(spark, d, "label").where("label is not null").unionByName(cases).select("sample_index", fn("label").alias("normal"))


@op("U15", _normal(1, final_sql("label")))
def u15(spark, d):
    """Canonical final answers of all labels, and of cases with TeX."""
    return _with_cases(spark, d, gr.final_answer_udf)


# what SQL can tell about a grade: of two whole numbers, of equal texts, and without any answer
_KIND = "CASE WHEN own IS NULL OR label IS NULL THEN 'none' WHEN regexp_matches(own, '^[0-9]{1,15}$') AND regexp_matches(label, '^[0-9]{1,15}$') THEN 'integers' WHEN own = label AND regexp_matches(own, '^[A-Za-z]+$') THEN 'equal' ELSE 'graded' END"
_TOLD = "CASE {k} WHEN 'none' THEN false WHEN 'integers' THEN CAST(own AS BIGINT) = CAST(label AS BIGINT) WHEN 'equal' THEN true END".format(k=_KIND)


def told(own, label):
    """The kind of a pair of answer and label, as the SQL sees it."""
    number = r"^[0-9]{1,15}$"
    return F.when(own.isNull() | label.isNull(), "none").when(own.rlike(number) & label.rlike(number), "integers").when((own == label) & own.rlike("^[A-Za-z]+$"), "equal").otherwise("graded")


@op("U16", q(rf"SELECT sample_index, {_KIND} AS kind, {_TOLD} AS correct FROM (SELECT sample_index, label, trim(regexp_extract_all(right(response, 300), '(?i)answer\s*:\s*([^\n]+)', 1)[-1]) AS own FROM t)"))
def u16(spark, d):
    """The last ``Answer:`` of every response against its label; where SQL can't tell the grade (other than whole numbers, equal words, no answer) it is left out of the result after grading."""
    x = texts(spark, d, "response", "label")
    own = F.trim(F.try_element_at(F.regexp_extract_all(F.substring("response", -300, 300), F.lit(r"(?i)answer\s*:\s*([^\n]+)"), F.lit(1)), F.lit(-1)))
    graded = F.coalesce(gr.score_udf("response", "label")["acc"], F.lit(False))
    return x.select("sample_index", told(own, F.col("label")).alias("kind"), graded.alias("g")).select("sample_index", "kind", F.when(F.col("kind") != "graded", F.col("g")).alias("correct"))


@op("U17", q(rf"SELECT sample_index, CASE WHEN coalesce({_BOX.replace('response', 'right(response, 100)')} = label, false) THEN 1.0 ELSE -1.0 END AS score FROM t WHERE label IS NOT NULL"))
def u17(spark, d):
    return texts(spark, d, "response", "label").where("label is not null").select("sample_index", gr.strict_score_udf("response", "label")["score"].alias("score"))


@op("U18", q(f"SELECT sample_index, CASE WHEN ok THEN 1.0 ELSE -1.0 END AS score, ok AS acc, pred FROM (SELECT sample_index, pred, coalesce(CAST(CAST(trunc(TRY_CAST(want AS DOUBLE)) AS BIGINT) AS VARCHAR) = pred, false) AS ok FROM (SELECT sample_index, {final_sql('own')} AS pred, {final_sql('lab')} AS want FROM (SELECT sample_index, coalesce(label, '') AS lab, coalesce(regexp_extract_all(right(response, 300), '(?i)answer\\s*:\\s*([^\\n]+)', 1)[-1], '[INVALID]') AS own FROM t)))"))
def u18(spark, d):
    return texts(spark, d, "response", "label").select("sample_index", gr.score_udf("response", "label").alias("s")).select("sample_index", "s.*")


@op("U19", q("SELECT sample_index, round(CASE WHEN coalesce(reward, 0) = 1 THEN 1.0 ELSE least(-0.6, -1 + (sample_index % 5 - 2) / 2.0 * 0.1) END, 6) AS score FROM t"))
def u19(spark, d):
    """Wrong answers gain a little for each tool turn beyond two, up to -0.6."""
    turns = F.col("sample_index") % 5
    return texts(spark, d, "reward").select("sample_index", r6(F.when(F.coalesce("reward", F.lit(0.0)) == 1, 1.0).otherwise(F.least(F.lit(-0.6), -1 + (turns - 2) / 2.0 * 0.1)), "score"))


@op("U20", _normal(2, "replace(trim(label), ' ', '')"))
def u20(spark, d):
    return _with_cases(spark, d, gr.plain_form_udf)


@op("U21", _normal(3, f"lower(replace(regexp_replace(label, '({'|'.join(gr.UNITS)})(es)?s? *(\\^[0-9]+)?', '', 'g'), ' ', ''))"))
def u21(spark, d):
    return _with_cases(spark, d, gr.value_form_udf)


_PAIRS = "SELECT response_length AS n, unnest(['product', 'sum', 'off', 'power', 'word']) AS kind FROM (SELECT DISTINCT response_length FROM samples WHERE response_length IS NOT NULL)"


@op("U22", f"SELECT n, kind, kind IN ('product', 'sum') OR (kind = 'power' AND n IN (0, 1)) AS same FROM ({_PAIRS})")
def u22(spark, d):
    """Equality of value of pairs of expressions: identities in one letter and in numbers, unequal ones, ones that are equal for some numbers only, and what can't be read."""
    n = F.col("n").cast("string")
    x = table(spark, d, "samples").where("response_length is not null").select(F.col("response_length").alias("n")).distinct()
    pairs = [("product", F.concat(n, F.lit("*x^2-"), n), F.concat(n, F.lit("(x-1)(x+1)"))), ("sum", F.concat(n, F.lit("/4+"), n, F.lit("/4")), F.concat(n, F.lit("/2"))), ("off", n, F.concat(n, F.lit("+1"))), ("power", F.concat(n, F.lit("^2")), n), ("word", n, F.concat(n, F.lit(" or more things")))]
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("a"), b.alias("b")) for k, a, b in pairs]))
    return x.select("n", rows.alias("p")).select("n", "p.kind", gr.same_value_udf("p.a", "p.b").alias("same"))


_TUPLES = "SELECT doc_id, unnest(['pair', 'open', 'nested', 'thousands', 'bare', 'empty']) AS kind, n_chars AS n FROM documents"


@op("U23", f"SELECT doc_id, kind, CASE kind WHEN 'pair' THEN n || '|' || doc_id WHEN 'open' THEN n || '|x' WHEN 'nested' THEN '((' || n || '), 1)' WHEN 'thousands' THEN '1234567' WHEN 'bare' THEN n || ', 2' ELSE '' END AS parts FROM ({_TUPLES})")
def u23(spark, d):
    """Members of tuples and intervals; nested brackets, bare lists and thousands are one member."""
    n = F.col("n_chars").cast("string")
    forms = [("pair", F.concat(F.lit("("), n, F.lit(", "), F.col("doc_id").cast("string"), F.lit(")"))), ("open", F.concat(F.lit("["), n, F.lit(",x)"))), ("nested", F.concat(F.lit("(("), n, F.lit("), 1)"))), ("thousands", F.lit("1,234,567")), ("bare", F.concat(n, F.lit(", 2"))), ("empty", F.lit(""))]
    x = table(spark, d, "documents").select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), s.alias("s")) for k, s in forms])).alias("f"))
    return x.select("doc_id", "f.kind", gr.tuple_parts_udf("f.s").alias("parts"))


@op("U24", q(f"SELECT sample_index, {_KIND} AS kind, {_TOLD} AS correct FROM (SELECT sample_index, label, {_BOX} AS own FROM t)"))
def u24(spark, d):
    """The last box's content against the label, as U16."""
    x = texts(spark, d, "response", "label").select("sample_index", told(_box(F.col("response")), F.col("label")).alias("kind"), gr.grade_udf(gr.unbox_udf("response"), "label").alias("g"))
    return x.select("sample_index", "kind", F.when(F.col("kind") != "graded", F.col("g")).alias("correct"))


def _box(text):
    return F.try_element_at(F.regexp_extract_all(text, F.lit(r"\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}"), F.lit(1)), F.lit(-1))


@op("U25", q(f"SELECT sample_index, {_KIND} AS kind, {_TOLD} AS correct FROM (SELECT sample_index, label, {_BOX} AS own FROM t)"))
def u25(spark, d):
    """The last box of every response against its label, as U16."""
    x = texts(spark, d, "response", "label").select("sample_index", told(_box(F.col("response")), F.col("label")).alias("kind"), gr.math_reward_udf("response", "label").alias("g"))
    return x.select("sample_index", "kind", F.when(F.col("kind") != "graded", F.col("g")).alias("correct"))


@op("U26", q(f"SELECT sample_index, {_KIND} AS kind, CASE WHEN thought THEN CASE WHEN {_TOLD} THEN 1.0 WHEN {_KIND} <> 'graded' THEN 0.0 END ELSE 0.0 END AS reward FROM (SELECT sample_index, label, contains(response, '</think>') AS thought, {_BOX.replace('response', chr(39).join(['string_split(response, ', '</think>', ')[-1]']))} AS own FROM t)"))
def u26(spark, d):
    """The same after finished reasoning; without it the reward is 0."""
    x = texts(spark, d, "response", "label").select("sample_index", F.col("response").contains("</think>").alias("thought"), told(_box(sc.after_reasoning(F.col("response"))), F.col("label")).alias("kind"), gr.reasoned_reward_udf("response", "label").alias("g"))
    return x.select("sample_index", "kind", F.when((F.col("kind") != "graded") | ~F.col("thought"), F.col("g")).alias("reward"))


@op("U27", q("SELECT sample_index, nullif(CASE WHEN s <> '' THEN 'search' WHEN a <> '' THEN 'answer' ELSE '' END, '') AS action, CASE WHEN s <> '' THEN trim(regexp_extract(s, '(?s)<search>(.*?)</search>', 1)) WHEN a <> '' THEN trim(regexp_extract(a, '(?s)<answer>(.*?)</answer>', 1)) ELSE '' END AS content FROM (SELECT sample_index, regexp_extract(m, '(?s)^<search>.*') AS s, regexp_extract(m, '(?s)^<answer>.*') AS a FROM (SELECT sample_index, regexp_extract(response, '(?s)<search>.*?</search>|<answer>.*?</answer>') AS m FROM t))"))
def u27(spark, d):
    return texts(spark, d, "response").select("sample_index", sc.action(F.col("response")).alias("a")).select("sample_index", "a.*")


@op("U28", q(r"SELECT sample_index, CASE WHEN box <> '' THEN 'answer' WHEN code <> '' THEN 'code' END AS action, CASE WHEN box <> '' THEN trim(box) ELSE code END AS content FROM (SELECT sample_index, regexp_extract(response, '(?s)Answer:\s*\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}', 1) AS box, trim(regexp_extract(response, '(?s)```python\s*(.*?)\s*```', 1)) AS code FROM t)"))
def u28(spark, d):
    return texts(spark, d, "response").select("sample_index", sc.tool_action(F.col("response")).alias("a")).select("sample_index", "a.*")


@op("U29", q("SELECT sample_index, CASE WHEN contains(response, '</search>') THEN string_split(response, '</search>')[1] || '</search>' WHEN contains(response, '</answer>') THEN string_split(response, '</answer>')[1] || '</answer>' ELSE response END AS cut FROM t"))
def u29(spark, d):
    return texts(spark, d, "response").select("sample_index", sc.cut_after_tag(F.col("response")).alias("cut"))


_CALL = "'<tool_call>{\"name\": \"calc\", \"arguments\": {\"answer\": \"' || sample_index || '\"}}</tool_call>'"


@op("U30", q("SELECT sample_index, 'calc' AS name, CAST(sample_index AS VARCHAR) AS answer FROM t"))
def u30(spark, d):
    call = F.concat("response", F.lit('<tool_call>{"name": "calc", "arguments": {"answer": "'), F.col("sample_index").cast("string"), F.lit('"}}</tool_call>'))
    c = sc.last_tool_call(call)
    return texts(spark, d, "response").select("sample_index", c["name"].alias("name"), F.get_json_object(c["arguments"], "$.answer").alias("answer"))


@op("U31", "SELECT prompt_id, metadata AS object FROM prompts WHERE json_valid(metadata)")
def u31(spark, d):
    x = table(spark, d, "prompts").where(F.try_parse_json("metadata").isNotNull())
    return x.select("prompt_id", gr.balanced_json_udf(F.concat(F.lit("see "), "metadata", F.lit(" end }"))).alias("object"))


@op("U32", q(r"SELECT sample_index, left(list_filter(list_transform(string_split_regex(response, '\r\n|\r|\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')[-1], 512) AS line FROM t"))
def u32(spark, d):
    return texts(spark, d, "response").select("sample_index", sc.last_line(F.col("response")).alias("line"))


@op("U33", q("SELECT sample_index, CASE WHEN sample_index % 7 BETWEEN 1 AND 4 THEN CAST(sample_index % 7 - 1 AS INT) END AS selected FROM t"))
def u33(spark, d):
    judged = F.concat(F.lit("Judgment: "), (F.col("sample_index") % 7).cast("string"))
    return texts(spark, d).select("sample_index", sc.selected_index(judged, F.lit(4)).alias("selected"))


@op("U34", q(r"SELECT sample_index, trim(regexp_replace(regexp_replace(prompt, '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) AS query FROM t WHERE prompt IS NOT NULL"))
def u34(spark, d):
    return texts(spark, d, "prompt").where("prompt is not null").select("sample_index", sc.sanitize_query(F.col("prompt")).alias("query"))


_SNIPPETS = "[replace(substr(text, 11, 20), chr(10), ' '), replace(substr(text, 16, 40), chr(10), ' '), 'rollout worker', '']"


@op("U35", rf"""WITH s AS (SELECT doc_id, text, unnest({_SNIPPETS}) AS s, unnest([1, 2, 3, 4]) AS k FROM documents WHERE text IS NOT NULL), p AS (SELECT *, instr(replace(text, chr(10), ' '), s) AS pos FROM s WHERE s <> ''),
 c AS (SELECT doc_id, k, regexp_replace(regexp_extract(substr(text, 1, pos - 1), '[^\n]*\z') || substr(text, pos, length(s)) || regexp_extract(substr(text, pos + length(s)), '^[^\n]*'), '^\s+|\s+$', '', 'g') AS para FROM p WHERE pos > 0),
 u AS (SELECT doc_id, para, min(k) AS k FROM c GROUP BY 1, 2), j AS (SELECT doc_id, string_agg(para, chr(10) ORDER BY k) AS context FROM u GROUP BY 1) SELECT d.doc_id, coalesce(context, '') AS context FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id WHERE text IS NOT NULL""")
def u35(spark, d):
    """The lines around each of several snippets, each once."""
    flat = [F.replace(F.substring("text", a, n), F.lit("\n"), F.lit(" ")) for a, n in ((11, 20), (16, 40))]
    return table(spark, d, "documents").where("text is not null").select("doc_id", sc.paragraphs(F.col("text"), F.array(*flat, F.lit("rollout worker"), F.lit(""))).alias("context"))


@op("U36", "SELECT item_id, 'Doc 1(Title: ' || string_split(prompt, chr(10))[1] || ') ' || CASE WHEN contains(prompt, chr(10)) THEN substr(prompt, instr(prompt, chr(10)) + 1) ELSE '' END || chr(10) AS passage FROM eval_items")
def u36(spark, d):
    return table(spark, d, "eval_items").select("item_id", sc.passages(F.array("prompt")).alias("passage"))


@op("U37", "SELECT DISTINCT sample_index, nullif(element_at(metadata, 'data_source')[1], '') AS source FROM samples")
def u37(spark, d):
    return table(spark, d, "samples").select("sample_index", sc.first_source(F.lit(None).cast("string"), F.col("metadata")).alias("source")).distinct()


@op("U38", q("SELECT sample_index, CASE WHEN length(response) > 256 THEN left(response, 256) || '...<truncated:' || length(response) || '>' ELSE response END AS compact FROM t"))
def u38(spark, d):
    return texts(spark, d, "response").select("sample_index", sc.compact(F.col("response")).alias("compact"))


@op("U39", q("SELECT sample_index, CASE sample_index % 4 WHEN 0 THEN 'truncated' WHEN 1 THEN 'aborted' WHEN 2 THEN 'completed' ELSE status END AS status FROM t"))
def u39(spark, d):
    finish = F.element_at(F.array(*map(F.lit, ["length", "abort", "stop", "other"])), (F.col("sample_index") % 4 + 1).cast("int"))
    return texts(spark, d, "status").select("sample_index", sc.status_of(finish, F.col("status")).alias("status"))


@op("U40", q("SELECT sample_index, reward, CASE WHEN status = 'truncated' THEN 0 ELSE coalesce(response_length, 0) END AS effective FROM t"))
def u40(spark, d):
    """Reward by key, and the mask's sum as the effective length."""
    detail = F.create_map(F.lit("score"), F.col("reward"))
    n = F.coalesce("response_length", F.lit(0))
    mask = F.when(F.col("status") == "truncated", F.array_repeat(F.lit(0), n)).otherwise(F.array_repeat(F.lit(1), n))
    return texts(spark, d, "reward", "status", "response_length").select("sample_index", F.element_at(detail, "score").alias("reward"), F.aggregate(mask, F.lit(0), lambda a, m: a + m).alias("effective"))


@op("U41", "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 5) AS first, len(embedding) AS n FROM embeddings")
def u41(spark, d):
    """Pairs of value and id, taken apart again."""
    pairs = F.transform("embedding", lambda x, i: F.struct(x.cast("double").alias("lp"), i.alias("id")))
    return table(spark, d, "embeddings").select("vec_id", F.round(F.element_at(F.transform(pairs, lambda p: p["lp"]), 1), 5).alias("first"), F.size(F.transform(pairs, lambda p: p["id"])).cast("long").alias("n"))


@op("U42", "SELECT event_id, 2 AS tokens, '-' || event_id || ',' || user_id || ';7,8|' || event_id % 256 || ',0;' || user_id || ',' || CAST(2147483647 AS BIGINT) AS experts FROM events WHERE event_id > 0")
def u42(spark, d):
    """Routed experts: base64 of little-endian 32-bit integers, as tokens x layers x experts."""
    def word(x):
        h = F.lpad(F.hex(F.when(x < 0, x + 2**32).otherwise(x)), 8, "0")
        return F.concat(h.substr(7, 2), h.substr(5, 2), h.substr(3, 2), h.substr(1, 2))

    e = F.col("event_id").cast("long")
    numbers = [-e, F.col("user_id").cast("long"), F.lit(7).cast("long"), F.lit(8).cast("long"), e % 256, F.lit(0).cast("long"), F.col("user_id").cast("long"), F.lit(2**31 - 1).cast("long")]
    code = F.base64(F.unhex(F.concat(*map(word, numbers))))
    x = table(spark, d, "events").where("event_id > 0").select("event_id", sc.reshape(sc.decode_int32(code), 2, 2).alias("r"))
    flat = F.flatten(F.flatten("r"))
    text = F.concat_ws("|", *[F.concat_ws(";", *[F.concat_ws(",", *[F.element_at(F.element_at(F.element_at("r", t), k), e).cast("string") for e in (1, 2)]) for k in (1, 2)]) for t in (1, 2)])
    return x.where(F.size(flat) == 8).select("event_id", F.size("r").alias("tokens"), text.alias("experts"))


@op("U43", q("SELECT round(sum(4 * (2 * n * 64 * 4 * 16 + 4 * n * 64 * 2 * 16 + 2 * 4 * n * n * 16 + 2 * n * 64 * 64 + 6 * n * 64 * 256) + 2 * n * 64 * 1000) / 1e9, 4) AS dense, round(sum(4 * (2 * n * 24 * (64 + 4 * (12 + 8)) + 2 * n * (16 * (64 + 4 * (12 + 10)) + 64 * 8) + 4 * n * n * (12 + 8) + 4 * n * n * 10 + 2 * n * 64 * 64) + 2 * 6 * n * 64 * 256 + 2 * 6 * n * 64 * (32 * 3 + 48) + 2 * n * 64 * 1000) / 1e9, 4) AS experts FROM (SELECT CAST(coalesce(response_length, 0) AS DOUBLE) AS n FROM t)"))
def u43(spark, d):
    """A dense decoder, and one with low-rank attention whose every second layer has experts."""
    n = F.coalesce("response_length", F.lit(0))
    dense = sc.flops(n, 64, 4, 2, 16, 256, 4, 1000)
    experts = sc.flops(n, 64, 4, 2, 16, 256, 4, 1000, q_rank=24, kv_rank=16, qk_head=12, rope_head=8, v_head=10, experts=8, expert_ffn=32, top_k=3, shared_ffn=48, moe_every=2)
    return texts(spark, d, "response_length").agg(F.round(F.sum(dense) / 1e9, 4).alias("dense"), F.round(F.sum(experts) / 1e9, 4).alias("experts"))


@op("U44", "SELECT prompt_id, prompt_id * 32 * 4 // 128 AS step FROM prompts")
def u44(spark, d):
    return table(spark, d, "prompts").select("prompt_id", F.expr("prompt_id * 32 * 4 div 128").alias("step"))


@op("U45", "SELECT result_id, coalesce(nullif(trim(model), ''), 'default-model') AS model, false AS stream FROM replay_results")
def u45(spark, d):
    return table(spark, d, "replay_results").select("result_id", F.coalesce(F.nullif(F.trim("model"), F.lit("")), F.lit("default-model")).alias("model"), F.lit(False).alias("stream"))


@op("U46", "SELECT prompt_id, CASE WHEN json_type(TRY_CAST(metadata AS JSON)) = 'OBJECT' THEN 'lookup' ELSE 'respond' END AS action, CASE WHEN json_type(TRY_CAST(metadata AS JSON)) = 'OBJECT' THEN json_extract_string(TRY_CAST(metadata AS JSON), '$.rm_type') END AS rm_type FROM prompts")
def u46(spark, d):
    """The first of two tool calls in a reply; without a call, or with arguments that can't be read, the reply itself is the action."""
    call = F.concat(F.lit('Let me see. <tool_call>{"name": "lookup", "arguments": '), F.col("metadata"), F.lit('}</tool_call> <tool_call>{"name": "second", "arguments": {}}</tool_call>'))
    name, args = sc.first_call(F.coalesce(call, F.lit("no call")))
    return table(spark, d, "prompts").select("prompt_id", name.alias("action"), args.alias("a")).select("prompt_id", "action", F.when(F.col("action") == "lookup", F.get_json_object("a", "$.rm_type")).alias("rm_type"))


@op("U47", "SELECT DISTINCT sample_index, CAST(CASE sample_index % 4 WHEN 0 THEN response_length WHEN 1 THEN coalesce(response_length, 0) + 1 WHEN 2 THEN len(string_split(response, ' ')) ELSE 0 END AS BIGINT) AS n, coalesce(status, 'completed') AS status FROM samples WHERE response IS NOT NULL AND (sample_index % 4 > 0 OR response_length IS NOT NULL)")
def u47(spark, d):
    """A result as a sample: its length from the attribute, else the mask, else the tokens, else 0."""
    s, k = table(spark, d, "samples").where("response is not null and (sample_index % 4 > 0 or response_length is not null)"), F.col("sample_index") % 4
    attribute = F.when(k == 0, F.col("response_length"))
    mask = F.when(k == 1, F.array_repeat(F.lit(1), F.coalesce("response_length", F.lit(0)) + 1))
    tokens = F.when(k == 2, F.split("response", " "))
    return s.select("sample_index", sc.result_length(attribute, mask, tokens).cast("long").alias("n"), F.coalesce("status", F.lit("completed")).alias("status")).distinct()


@op("U48", q("SELECT sample_index, CASE sample_index % 4 WHEN 0 THEN 'no_call' WHEN 1 THEN 'unsupported' WHEN 2 THEN 'missing' ELSE 'scored' END AS step, sample_index % 4 = 0 OR sample_index % 3 = 2 AS done FROM t"))
def u48(spark, d):
    """Decision after a turn: no call ends the episode, other cases at the last of three turns."""
    k = F.col("sample_index") % 4
    call = F.when(k == 1, '<tool_call>{"name": "other", "arguments": {}}</tool_call>').when(k == 2, '<tool_call>{"name": "calc_score", "arguments": {"answer": " "}}</tool_call>').when(k == 3, '<tool_call>{"name": "calc_score", "arguments": {"answer": "7"}}</tool_call>').otherwise("")
    c = sc.last_tool_call(call)
    answer = F.get_json_object(c["arguments"], "$.answer")
    step = F.when(c.isNull(), "no_call").when(c["name"] != "calc_score", "unsupported").when(F.coalesce(F.trim(answer), F.lit("")) == "", "missing").otherwise("scored")
    return texts(spark, d).select("sample_index", step.alias("step"), (c.isNull() | (F.col("sample_index") % 3 == 2)).alias("done"))


@op("U49", q("SELECT any_value(prompt) || chr(10) || string_agg('#### Solution ' || rn || chr(10) || response, chr(10) ORDER BY rn) AS prompt_text, g FROM (SELECT sample_index // 1000 AS g, 'Solve.' AS prompt, response, row_number() OVER (PARTITION BY sample_index // 1000 ORDER BY sample_index) AS rn FROM t) GROUP BY g"))
def u49(spark, d):
    """A prompt with all candidate solutions, numbered; a group holds at most 1,000 of them."""
    rn = F.row_number().over(Window.partitionBy("g").orderBy("sample_index"))
    x = texts(spark, d, "response").withColumn("g", F.floor(F.col("sample_index") / 1000)).withColumn("rn", rn)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("rn", "response"))), lambda s: F.concat(F.lit("#### Solution "), s["rn"].cast("string"), F.lit("\n"), s["response"]))
    return x.groupBy("g").agg(F.concat(F.lit("Solve.\n"), F.array_join(parts, "\n")).alias("prompt_text"))


@op("U50", q("SELECT sample_index, CASE WHEN len(p) = 2 AND p[2] <> '' THEN trim(p[1]) END AS reasoning, CASE WHEN len(p) = 2 AND p[2] <> '' THEN trim(p[2]) END AS answer FROM (SELECT sample_index, string_split(response, '</think>') AS p FROM t)"))
def u50(spark, d):
    p = F.split("response", "</think>")
    ok = (F.size(p) == 2) & (F.element_at(p, -1) != "")
    return texts(spark, d, "response").select("sample_index", F.when(ok, F.trim(p[0])).alias("reasoning"), F.when(ok, F.trim(F.element_at(p, -1))).alias("answer"))


@op("U51", "SELECT doc_id, coalesce(nullif(trim(source), ''), 'No title.') AS title, coalesce(nullif(trim(text), ''), 'No snippet available.') AS context FROM documents WHERE coalesce(source, '') <> '' OR coalesce(text, '') <> ''")
def u51(spark, d):
    x = table(spark, d, "documents").where((F.coalesce("source", F.lit("")) != "") | (F.coalesce("text", F.lit("")) != ""))
    return x.select("doc_id", F.coalesce(F.nullif(F.trim("source"), F.lit("")), F.lit("No title.")).alias("title"), F.coalesce(F.nullif(F.trim("text"), F.lit("")), F.lit("No snippet available.")).alias("context"))


@op("U52", q("SELECT sample_index, least(64, 256 - length(prompt)) AS max_new FROM t WHERE 256 - length(prompt) > 0"))
def u52(spark, d):
    room = 256 - F.length("prompt")
    return texts(spark, d, "prompt").where(room > 0).select("sample_index", F.least(F.lit(64), room).cast("long").alias("max_new"))


@op("U1", q(f"SELECT sample_index, round({_F1}, 6) AS reward FROM c", f"n AS (SELECT sample_index, response, label, {norm('own')} AS np, {norm('label')} AS ng FROM (SELECT sample_index, label, response, CASE WHEN sample_index % 3 = 1 THEN coalesce({_BOX}, '') ELSE response END AS own FROM t))", _K, _C))
def u1(spark, d):
    """Scorer by the row's type, its meta data or a default; ``boxed_`` scores the last box's content."""
    kind = F.when(F.col("sample_index") % 3 == 1, "boxed_f1").when(F.col("sample_index") % 3 == 2, " f1 ")
    x = texts(spark, d, "response", "label")
    return x.select("sample_index", r6(rewards.reward(kind, F.col("response"), F.col("label"), default="f1"), "reward"))


@op("U2", q(f"SELECT sample_index // 4 AS batch, round(sum({_F1}), 6) AS reward FROM c GROUP BY 1", _N, _K, _C))
def u2(spark, d):
    """Scores of whole groups."""
    x = texts(spark, d, "response", "label").select((F.floor(F.col("sample_index") / 4)).alias("batch"), sc.token_f1(F.col("response"), F.col("label"))["f1"].alias("f"))
    return x.groupBy("batch").agg(r6(F.sum("f"), "reward"))

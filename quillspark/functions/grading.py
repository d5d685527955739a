"""Rule-based grading of mathematical answers; plain Python, called in Arrow batches."""

from __future__ import annotations

import ast
import math
import operator
from fractions import Fraction

import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

# ---- fixed values: what a final answer loses before it is compared, in this order
REPLACED = [("an ", ""), ("a ", ""), (".$", "$"), ("\\$", ""), ("\\ ", ""), (" ", ""), ("mbox", "text"), (",\\text{and}", ","), ("\\text{and}", ","), ("\\text{m}", "\\text{}")]
REMOVED = ["square", "ways", "integers", "dollars", "mph", "inches", "hours", "km", "units", "\\ldots", "sue", "points", "feet", "minutes", "digits", "cents", "degrees", "cm", "gm", "pounds", "meters", "meals", "edges", "students", "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}", "\\text{}^2", "\\text{}^3", "\\text{\n}", "\\text{}", "\\mathrm{th}", "^\\circ", "^{\\circ}", "\\;", ",\\!", "{,}", '"', "\\dots", "<|im_end|>", "<|endoftext|>"]
# ---- fixed values: units that an answer may carry
UNITS = ["degree", "cm", "centimeter", "meter", "mile", "second", "minute", "hour", "day", "week", "month", "year", "foot", "feet", "inch", "yard"]
_BRACES = regex.compile(r"(\{(?:[^{}]|(?1))*\})")


def last_box(text: str | None, commands: tuple[str, ...] = ("\\boxed",), brace: bool = True) -> str | None:
    """The last boxed expression with its command, or None if there is none or its braces don't close."""
    for command in commands:
        at = (text or "").rfind(command + "{" if brace else command)
        if at >= 0:
            m = _BRACES.search(text, at + len(command))
            return text[at : m.end()] if m and (not brace or m.start() == at + len(command)) else None
    return None


def unbox(boxed: str | None) -> str | None:
    if boxed is None or not (boxed.startswith("\\boxed{") and boxed.endswith("}")):
        return None
    return boxed[7:-1]


def boxed_answer(text: str | None) -> str | None:
    """Content of the last box of a passage; ``\\fbox`` is found but has no readable content."""
    return unbox(last_box(text, ("\\boxed", "\\fbox"), brace=False)) if text and "\\boxed" in text else None


def final_answer(text: str) -> str:
    """Canonical form of a final answer: after the last equals sign, without units, fillers and TeX wrappers."""
    out = str(text).rpartition("=")[2]
    for a, b in REPLACED + [(r, "") for r in REMOVED]:
        out = out.replace(a, b)
    # of a line with a formula only the first formula is left
    out = "\n".join(f"${line.split('$')[1]}$" if line.count("$") > 1 else line for line in out.split("\n"))
    for command in ("text", "textbf", "overline"):
        out = regex.sub(rf"\\{command}\{{(.*?)\}}", r"\1", out)
    out = regex.sub(r"\\boxed\{(.*)\}", r"\1", out)
    out = regex.sub(r"frac([^{])(.)", r"frac{\1}{\2}", out)
    out = regex.sub(r"sqrt([^{])", r"sqrt{\1}", out).replace("$", "")
    bare = out.replace(",", "")
    return (bare if bare.isdigit() else out).strip()


def minerva(text: str, truth: str) -> tuple[bool, str]:
    """The last ``Answer:`` line against an integer truth; a truth that is no number is never right."""
    found = regex.findall(r"(?i)answer\s*:\s*([^\n]+)", text)
    guess = final_answer(found[-1]) if found else final_answer("[INVALID]")
    try:
        want = str(int(float(final_answer(truth))))
    except (ValueError, OverflowError):
        return False, guess
    return guess == want, guess


def strict_box(text: str, truth: str) -> tuple[bool, str | None]:
    """The box among the last 100 characters, compared as it stands."""
    guess = unbox(last_box(text[-100:]))
    return guess == truth, guess


def score(text: str | None, truth: str | None, strict: bool = False) -> tuple[float, bool, str | None]:
    """+1 or -1, whether it is right, and the prediction, from the last 300 characters."""
    ok, guess = (strict_box if strict else minerva)((text or "")[-300:], truth or "")
    return (1.0 if ok else -1.0), ok, guess


def plain_form(answer: str | None) -> str | None:
    """Normal form for textual equality: spacing, fractions, roots, units and percent signs are unified."""
    if answer is None:
        return None
    s = answer.strip()
    whole = regex.fullmatch(r"\\text\{(.+?)\}", s, flags=regex.S)
    s = (whole.group(1).strip() if whole else s).replace("\n", "").replace("\\!", "").replace("\\\\", "\\")
    s = regex.sub(r"[td]frac", "frac", s)
    s = regex.sub(r"\\left|\\right|\^\{?\\circ\}?|\\\$", "", s)
    if s.count("\\text{ ") == 1:
        s = s.split("\\text{ ")[0]
    s = regex.sub(r"(^|[ {])\.", r"\g<1>0.", s.replace("\\%", ""))
    name, eq, rest = s.partition("=")
    if eq and "=" not in rest and len(name) <= 2:
        s = rest
    s = regex.sub(r"\\sqrt(?!\{)(.)", r"\\sqrt{\1}", s).replace(" ", "")
    s = regex.sub(r"\\frac(?!\{)(.)(?!\{)(.)", r"\\frac{\1}{\2}", s)
    s = regex.sub(r"\\frac(?!\{)(.)(?=\{)", r"\\frac{\1}", s)
    if s == "0.5":
        return "\\frac{1}{2}"
    m = regex.fullmatch(r"(-?\d+)/(-?\d+)", s)
    return f"\\frac{{{int(m[1])}}}{{{int(m[2])}}}" if m and f"{int(m[1])}/{int(m[2])}" == s else s


def _drop_commas(s: str) -> str:
    while True:
        new = regex.sub(r"(\d),(\d\d\d)(?!\d)", r"\1\2", s)
        if new == s:
            return s
        s = new


def _whole(s: str) -> bool:
    try:
        x = float(_drop_commas(s))
        return math.isfinite(x) and abs(x - round(x)) <= 1e-7
    except ValueError:
        return False


def value_form(expr: str | None) -> str | None:
    """Normal form for equality of value: units, large-number words, mixed numbers and braces are resolved."""
    if expr is None:
        return None
    m = regex.fullmatch(r"\\text\{(.+?)\}", expr, flags=regex.S)
    s = m.group(1) if m else expr
    s = s.replace("\\%", "%").replace("\\$", "$").replace("$", "").replace("%", "").replace(" or ", " , ").replace(" and ", " , ")
    for word, power in (("million", 6), ("billion", 9), ("trillion", 12)):
        s = s.replace(word, f"*10^{power}")
    for unit in UNITS:
        s = regex.sub(rf"{unit}(es)?s? *(\^\d+)?", "", s)
    s = regex.sub(r"\^ *\\circ", "", s)
    if s.startswith("{") and s.endswith("}"):
        s = s[1:-1]
    s = regex.sub(r",\\! *", "", s)
    if "," not in s and _whole(s):
        s = str(round(float(s)))
    if "\\" in s:
        s = regex.sub(r"\\[td]?frac *\{([^{}]*)\} *\{([^{}]*)\}", r" (\1)/(\2)", s)
        s = regex.sub(r"\\[td]?frac", " ", s)
        s = regex.sub(r"\\sqrt *\{([^{}]*)\}", r"sqrt(\1)", s)
        for tex, sign in (("\\cdot", "*"), ("\\times", "*"), ("\\pi", "pi"), ("\\infty", "inf"), ("\\cup", "U")):
            s = s.replace(tex, sign)
        s = regex.sub(r"\(([\w.]+)\)/\(([\w.]+)\)", r"\1/\2", s)
        s = regex.sub(r"\\[a-zA-Z]+|\\.", "", s).strip()
    s = regex.sub(r"- *", "-", s)
    s = regex.sub(r"(\d) +(\d)", r"\1+\2", s)
    s = regex.sub(r"[ {}]", "", s).lower()
    return str(int(float(s.replace(",", "")))) if _whole(s) else s


_OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}


def _value(node: ast.AST, letters: dict[str, Fraction]) -> Fraction | float:
    if isinstance(node, ast.Expression):
        return _value(node.body, letters)
    if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
        return Fraction(str(node.value))
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
        x = _value(node.operand, letters)
        return -x if isinstance(node.op, ast.USub) else x
    if isinstance(node, ast.BinOp) and type(node.op) in _OPS:
        return _OPS[type(node.op)](_value(node.left, letters), _value(node.right, letters))
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Pow):
        a, b = _value(node.left, letters), _value(node.right, letters)
        if abs(b) > 64:
            raise ValueError("power too large")
        return a ** int(b) if b == int(b) else float(a) ** float(b)
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id == "sqrt" and len(node.args) == 1:
        x = _value(node.args[0], letters)
        if isinstance(x, Fraction) and x >= 0:
            n, d = math.isqrt(x.numerator), math.isqrt(x.denominator)
            if n * n == x.numerator and d * d == x.denominator:
                return Fraction(n, d)
        return math.sqrt(x)
    if isinstance(node, ast.Name):
        return math.pi if node.id == "pi" else letters[node.id]
    raise ValueError("not an arithmetic expression")


def same_value(a: str, b: str) -> bool:
    """Equality of two arithmetic expressions of at most two unknown letters, by exact evaluation (letters at three points).

    Anything that cannot be read as arithmetic is unequal.
    """
    both = f"({a})-({b})"
    if len({c for c in both.replace("sqrt", "").replace("frac", "") if c.isalpha()}) > 2 or regex.search(r"\^[{(]|\^\d+\^|\^\d\d+", both):
        return False
    try:
        text = regex.sub(r"(\d|\))(?=[a-zA-Z(])", r"\1*", both.replace("^", "**"))
        tree = ast.parse(text, mode="eval")
        names = sorted({n.id for n in ast.walk(tree) if isinstance(n, ast.Name)} - {"sqrt", "pi"})
        for k in (3, 7, 11):
            if abs(_value(tree, {x: Fraction(k + 2 * i, 5) for i, x in enumerate(names)})) > 1e-9:
                return False
        return True
    except (ValueError, SyntaxError, ZeroDivisionError, OverflowError, KeyError, TypeError, RecursionError):
        return False


def tuple_parts(s: str) -> list[str]:
    """Members of a bracketed tuple or interval; anything else is one member."""
    s = _drop_commas(s)
    if not s:
        return []
    if len(s) > 2 and s[0] in "()[]" and s[-1] in "()[]" and not set(s[1:-1]) & set("()[]"):
        return [x.strip() for x in s[1:-1].split(",")]
    return [s]


def same_member(truth: str, given: str) -> bool:
    fraction = r"-?[0-9]+.?/0*[1-9][0-9]*.?"
    if regex.fullmatch(fraction, truth) and regex.fullmatch(fraction, given):
        return truth == given  # an unreduced fraction is not right
    if _whole(truth) != _whole(given):
        return False
    return same_value(truth, given)


def grade(given: str | None, truth: str | None) -> bool:
    """Equal in plain form, or in value form member by member with equal brackets."""
    if given is None or truth is None:
        return False
    if plain_form(truth) == plain_form(given):
        return True
    a, b = value_form(truth), value_form(given)
    if a == b:
        return True
    if not b:
        return False
    x, y = tuple_parts(a), tuple_parts(b)
    if len(x) != len(y) or len(x) > 1 and (a[0], a[-1]) != (b[0], b[-1]):
        return False
    return all(same_member(p, q) for p, q in zip(x, y, strict=True))


def math_reward(text: str | None, truth: str | None) -> bool:
    """The last box of the response against the truth, which may be boxed itself; without a box it is wrong."""
    if not truth:
        return False
    want = boxed_answer(truth) if "\\boxed" in truth else truth
    return grade(boxed_answer(text), want)


def reasoned_reward(text: str | None, truth: str | None) -> float:
    """As :func:`math_reward`, on what follows the last ``</think>`` (or the first ``###Response``); without either 0."""
    text = text or ""
    if "</think>" in text:
        own = text.rsplit("</think>", 1)[1]
    elif "###Response" in text:
        own = text.split("###Response")[1]
    else:
        return 0.0
    return float(bool(truth) and math_reward(own, truth))


def balanced_json(text: str, start: int) -> str | None:
    """The object that begins at ``start``, braces in strings aside; None if it doesn't end."""
    m = regex.compile(r'(\{(?:[^{}"]|"(?:[^"\\]|\\.)*"|(?1))*\})', regex.S).match(text, start)
    return m.group() if m else None


# ---- Arrow functions ----------------------------------------------------------------------------------------------
SCORE = StructType([StructField("score", DoubleType()), StructField("acc", BooleanType()), StructField("pred", StringType())])


def _text(fn):
    @F.pandas_udf(StringType())
    def run(x: pd.Series) -> pd.Series:
        return x.map(fn)

    return run


def _pair(fn, kind):
    @F.pandas_udf(kind)
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([fn(a, b) for a, b in zip(x, y, strict=True)], dtype=object)

    return run


def _score(strict: bool):
    @F.pandas_udf(SCORE)
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([score(a, b, strict) for a, b in zip(x, y, strict=True)], columns=["score", "acc", "pred"])

    return run


last_box_udf = _text(last_box)
unbox_udf = _text(lambda t: unbox(last_box(t)))
final_answer_udf = _text(lambda t: None if t is None else final_answer(t))
plain_form_udf = _text(plain_form)
value_form_udf = _text(value_form)
balanced_json_udf = _text(lambda t: balanced_json(t, t.index("{")) if t and "{" in t else None)
same_value_udf = _pair(lambda a, b: a is not None and b is not None and same_value(a, b), BooleanType())
grade_udf = _pair(grade, BooleanType())
math_reward_udf = _pair(math_reward, BooleanType())
reasoned_reward_udf = _pair(reasoned_reward, DoubleType())
score_udf, strict_score_udf = _score(False), _score(True)


@F.pandas_udf(StringType())
def tuple_parts_udf(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else "|".join(tuple_parts(t)))

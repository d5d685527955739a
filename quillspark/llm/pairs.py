"""Problem 3: broken prompt and response pairs.

Each pair gets at most one defect, tested in this order: ``empty``, ``refusal``, ``copy``, ``other_language``, ``truncated``.
Copies are found by aligning the response's words with the prompt's (five-word shingle containment, else the longest
common subsequence, else the share of words in stretches of the prompt, in any order and number); refusals by aligning the concepts of every sentence with refusal templates (``refusals``). Answer-format instructions are
the sentences that stand before and after many prompts.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import refusals
from .common import NO_INSTRUCTIONS, instruction_pattern, map_batches, spread, standing_instructions
from .lexicon import FUNCTION_WORDS

#: Letters that mark a language, where they occur.
MARKED_LETTERS = {"de": "äöüß", "fr": "èêëçàùœîïôû", "es": "ñ¿¡áíóú", "pt": "ãõ"}
# ---- fixed values: how a prompt asks for a language
LANGUAGE_NAMES = {
    "en": "english|englisch|anglais|inglés|英文|英语", "de": "german|deutsch|allemand|alemán|德文|德语", "fr": "french|französisch|français|francés|法文|法语",
    "es": "spanish|spanisch|espagnol|español|西班牙文|西班牙语", "zh": "chinese|mandarin|chinesisch|chinois|chino|中文|汉语|普通话", "ru": "russian|russisch|russe|ruso|俄文|俄语",
    "it": "italian|italienisch|italien|italiano", "pt": "portuguese|portugiesisch|portugais|portugués", "ja": "japanese|japanisch|japonais|japonés|日文|日语", "ko": "korean|koreanisch|coréen|coreano|韩文|韩语",
}
# ---- fixed values: stand-ins for no value, and frames around an answer
NO_VALUE = {"none", "null", "nil", "nan", "n/a", "na", "undefined", "empty", "no output", "no answer", "no response", "no content", "blank", "无", "空", "keine", "aucun", "aucune", "ninguno", "nichts", "void", "missing", "tbd", "not available", "keine ausgabe", "sin respuesta", "pas de réponse", "keine antwort", "无输出", "没有回答"}
FRAME = regex.compile(r"(?i)(?:final |short |my )?(?:answer|result|response|output|antwort|réponse|respuesta|答案|回答)(?: is)?|assistant|boxed|text|the answer is")
SPECIAL = regex.compile(r"</?s>|<\|[^|>]{1,40}\|>|\[/?(?:INST|PAD|EOS|BOS)\]|<(?:eos|bos|pad|unk)>")
MARKED = re.compile(r"[<&\\`\[]")
THINK = regex.compile(r"(?is)<(think|thinking|reasoning|scratchpad)>.*?</\1>")
INVISIBLE = regex.compile(r"[\p{Cf}\p{Cc}\p{Zs}\p{Zl}\p{Zp}\uFFFD]+")
TOKEN = regex.compile(r"[\p{Han}]|[\p{L}\p{M}&&[^\p{Han}]]+|\p{N}+", regex.V1)
CONTROLS = re.compile(r"[\x00-\x09\x0b-\x1f\x7f]|  ")
ASCII_TOKEN = re.compile(r"[a-z]+|[0-9]+")
SENTENCE = regex.compile(r"(?<=[.!?。！？…])[\s\"'”’*_)]*|\n+|(?<=[:：])\s+")
#: What a remark beside a refusal must not hold: options, code or an answer frame; and digits and names that the prompt does not have.
OPTION = regex.compile(r"[`\\\\$<>{}|:：(=]|(?i:\banswer is\b|\bit (?:is|was)\b)")
NAMED = regex.compile(r"\p{N}+|(?<=\p{L}\s)\p{Lu}\p{Ll}+")
#: Words that only introduce a repeated question.
WRAPPERS = set("user role content assistant system message messages prompt question q you asked ask here is the your request input task query text repeat repeating quote said says i see understood frage question pregunta 问题 提问 用户".split())


@lru_cache(maxsize=256)
def rx(pattern: str) -> regex.Pattern:
    """Compiled once; the library's own cache costs more than most searches here."""
    return regex.compile(pattern)


@lru_cache(maxsize=8)
def tokens(text: str) -> list[str]:
    if text.isascii():  # nothing to normalise, and what is no letter or digit separates
        return ASCII_TOKEN.findall(text.lower().replace("'", ""))
    return TOKEN.findall(unicodedata.normalize("NFKC", INVISIBLE.sub(" ", text)).lower().replace("’", "'").replace("'", ""))


def plain(text: str) -> str:
    """Without the marks of a chat format."""
    return SPECIAL.sub(" ", text) if "<" in text or "[" in text else text


def lcs(a: list[str], b: list[str]) -> tuple[int, int]:
    """Length of the longest common subsequence (bit-parallel) and the end, in ``b``, of its earliest full alignment."""
    place: dict[str, int] = {}
    for i, w in enumerate(a):
        place[w] = place.get(w, 0) | (1 << i)
    row, full, end, best = (1 << len(a)) - 1, (1 << len(a)) - 1, 0, 0
    for j, w in enumerate(b):
        m = place.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
            n = len(a) - row.bit_count()
            if n > best:
                best, end = n, j + 1
    return best, end


def is_refusal(answer: str, prompt: str = "") -> bool:
    """At least one sentence declines, and the others are courtesies or remarks that give no number, name, option, code or answer frame but the prompt's.

    Remarks may be as long as what is declined and the courtesies (twelve words at least), however long the answer is.
    """
    if not refusals.may_refuse(tokens(answer), answer):
        return False
    declined, polite, remarks, left = False, 0, 0, len(answer)
    known = None
    for s in SENTENCE.split(answer):
        left -= len(s or "")
        kind, size = refusals.judge(s or "")
        declined |= kind == "refusal"
        if kind in ("refusal", "courtesy"):
            polite += size
        elif kind == "remark":
            if any(True for _ in OPTION.finditer(s)):
                return False
            known = set(tokens(prompt)) if known is None else known
            if any(m.group().lower() not in known for m in NAMED.finditer(s)):
                return False
            remarks += size
            if remarks > max(12, polite + left):
                return False  # what follows can't make up for it
    return declined and remarks <= max(12, polite)


def split_reasoning(text: str) -> tuple[str, bool, bool]:
    """The part after finished reasoning; whether there was reasoning; whether it is unfinished."""
    if "<" not in text:
        return text, False, False
    rest, n = THINK.subn("\n", text)
    if n == 0 and (m := rx(r"(?i)</(?:think|thinking|reasoning|scratchpad)>").search(rest)):
        rest, n = rest[m.end() :], 1
    open_ = rx(r"(?i)<(?:think|thinking|reasoning|scratchpad)>").search(rest)
    return rest, n > 0, bool(open_)


def is_empty(answer: str) -> bool:
    """Nothing but blanks, invisible characters, punctuation, markup, an answer frame or a stand-in for no value."""
    if not MARKED.search(answer) and len(ASCII_TOKEN.findall(answer[:400].lower())) > 20:
        return False  # without markup, neither frames nor stand-ins have so many words
    t = SPECIAL.sub(" ", answer)
    t = rx(r"</?[A-Za-z][^<>]{0,60}>|```[a-zA-Z]*|&nbsp;|\\boxed|\\text|\\n|\\(?=[\[\]()])").sub(" ", t)
    t = INVISIBLE.sub(" ", t).strip().lower()
    bare = rx(r"^[\p{P}\p{S}\s]+|[\p{P}\p{S}\s]+$").sub("", t)
    if not rx(r"[\p{L}\p{N}]").search(bare) or bare in NO_VALUE:
        return True
    inner = rx(r"^[\p{P}\p{S}\s]+").sub("", rx(rf"^(?:{FRAME.pattern[4:]})(?=[^\p{{L}}\p{{N}}]|$)").sub("", bare))
    return inner != bare and (not rx(r"[\p{L}\p{N}]").search(inner) or inner.strip(" .*_") in NO_VALUE)


@lru_cache(maxsize=1024)
def _prompt_tokens(prompt: str, instructions: regex.Pattern) -> tuple[list[str], int]:
    """A prompt's words and the number of its question's; prompts recur for every sample of a group."""
    return tokens(prompt), len(question_tokens(prompt, instructions))


@lru_cache(maxsize=1024)
def wanted_language(prompt: str, instructions: regex.Pattern) -> str | None:
    """The language a prompt asks for, else its own."""
    return asked_language(prompt) or language(instructions.sub(" ", prompt))[0]


def _given_back(p: list[str], r: list[str], question: int, share: float) -> bool:
    """The response consists of stretches of the prompt, in any order and any number of times, without words that could be an answer."""
    n = max(3, min(5, question, len(p)))
    at: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(p) - n + 1):
        at.setdefault(tuple(p[i : i + n]), []).append(i)
    place, before = [-1] * len(r), -2
    for i in range(len(r) - n + 1):
        found = at.get(tuple(r[i : i + n]))
        if found:
            before = before + 1 if before + 1 in found else found[0]
            place[i : i + n] = range(before, before + n)
        else:
            before = before + 1 if before >= 0 else before
    inside = [k for k, j in enumerate(place) if j >= 0]
    if len(inside) < share * len(r) or len({place[k] for k in inside}) < 0.7 * question:
        return False
    most = max(1, 0.04 * len(p))
    ends = [(-1, -1), *((k, place[k]) for k in inside), (len(r), len(p))]
    for (k, j), (k2, j2) in zip(ends, ends[1:], strict=False):
        gap = r[k + 1 : k2]
        if not gap or 0 <= k and k2 < len(r) and j < j2 and len(gap) <= j2 - j:
            continue  # altered words inside a stretch
        free = [w for w in gap if w not in WRAPPERS]
        missing = j2 - j - 1 if j2 > j else len(p) - 1 - j + j2
        if free and (len(free) > min(missing, most) or any(w.isnumeric() or len(w) == 1 and w.isascii() for w in free)):
            return False
    return True


def is_copy(prompt: str, answer: str, instructions: regex.Pattern = NO_INSTRUCTIONS, share: float = 0.8) -> bool:
    """The response is the prompt's question, wholly or nearly, once or more often, and holds no answer beside it."""
    p, question = _prompt_tokens(prompt, instructions)
    r = tokens(plain(answer))
    if len(r) < 3 or not p:
        return False
    while r and r[0] in WRAPPERS and (r[0] not in p[:3]):
        r = r[1:]
    if len(r) < 3:
        return False
    have = set(p) | WRAPPERS
    if len([w for w in r if w in have]) < share * len(r):
        return False  # too many words that the prompt does not have
    shingles = {tuple(p[i : i + 5]) for i in range(len(p) - 4)}
    own = [tuple(r[i : i + 5]) for i in range(len(r) - 4)]
    if own and len(own) - len(set(own)) <= 0.3 * len(own) and all(s in shingles for s in own):
        inside = end = len(r)  # one stretch of the prompt, not the same one again and again
    elif share * len(r) <= len(p):
        inside, end = lcs(p, r)
    else:
        inside = end = 0  # a subsequence can't be as long
    if inside >= share * len(r) and len(r) - end <= max(1, 0.04 * len(r)) and inside >= 0.7 * question:
        return True
    return _given_back(p, r, question, share)


def question_tokens(prompt: str, instructions: regex.Pattern = NO_INSTRUCTIONS) -> list[str]:
    own = tokens(instructions.sub(" ", prompt))
    return own[1:] if own[:1] == ["question"] else own


NOT_PROSE = re.compile(r"```.*?(?:```|$)|`[^`]*`|\\boxed\{[^}]*\}|\$[^$]*\$|</?[a-zA-Z|][^<>]*>|(?<![\w.-])[\w.-]*[_\d][\w.-]*|--?\w[\w-]*", re.S)
ELISION = regex.compile(r"\b(?:l|d|qu|n|s|c|j|m)['’]\p{Latin}")
MIXED = regex.compile(r"[\p{Latin}](?=[\p{Cyrillic}\p{Greek}])|[\p{Cyrillic}\p{Greek}](?=\p{Latin})")
#: Cyrillic and Greek letters that look like Latin ones, and those.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһԛԝАВЕКМНОРСТХІЅЈαοενικρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhqwABEKMHOPCTXISJaoevikptuxABEZHIKMNOPTYX")
LATIN = regex.compile(r"\p{Latin}+")
ASCII_WORD = re.compile(r"[a-z]+")
SCRIPTS = {k: regex.compile(rf"\p{{{v}}}+") for k, v in (("ru", "Cyrillic"), ("ar", "Arabic"), ("el", "Greek"), ("hi", "Devanagari"), ("he", "Hebrew"), ("th", "Thai"))}
HAN, KANA, HANGUL = regex.compile(r"\p{Han}"), regex.compile(r"[\p{Hiragana}\p{Katakana}]"), regex.compile(r"\p{Hangul}")


def language(text: str) -> tuple[str | None, float]:
    """Language of the prose and the evidence for it; None where there is too little of it."""
    t = NOT_PROSE.sub(" ", text.lower())
    if not t.isascii() and len(MIXED.findall(t)) >= 3:  # look-alike letters inside words
        t = t.translate(LOOKALIKES)
    latin = ASCII_WORD.findall(t) if t.isascii() else LATIN.findall(t)
    weight: dict[str, float] = {"en": 0.0}
    if not t.isascii():
        han, kana, hangul = len(HAN.findall(t)), len(KANA.findall(t)), len(HANGUL.findall(t))
        weight |= {"zh": han / 1.7 if kana < 0.1 * han else 0, "ja": (han + kana) / 1.7 if kana and kana >= 0.1 * han else 0, "ko": hangul / 2}
        weight |= {k: len(v.findall(t)) for k, v in SCRIPTS.items()}
    hits, spoken = dict.fromkeys(FUNCTION_WORDS, 0.0), _speakers()
    distinct: dict[str, set[str]] = {k: set() for k in FUNCTION_WORDS}
    for w in latin:
        for k in spoken.get(w, ()):
            hits[k] += 1
            distinct[k].add(w)
    hits["fr"] += len(ELISION.findall(t)) if "'" in t or "’" in t else 0
    if not t.isascii():
        for k, letters in MARKED_LETTERS.items():
            hits[k] += 0.7 * min(4, sum(t.count(x) for x in letters))
    for k in hits:  # close relatives of the others: only where they explain clearly more, by several words
        if k not in ("en", "de", "fr", "es"):
            hits[k] = 0.6 * hits[k] if len(distinct[k]) >= 3 else 0
    order = sorted(hits, key=hits.get, reverse=True)
    if hits[order[0]] > hits[order[1]]:
        weight[order[0]] = weight.get(order[0], 0) + len(latin)
    top = max(weight, key=weight.get)
    return (top, weight[top]) if weight[top] >= 3 else (None, weight[top])


@lru_cache(maxsize=1)
def _speakers() -> dict[str, list[str]]:
    """The languages of each function word."""
    out: dict[str, list[str]] = {}
    for k, v in FUNCTION_WORDS.items():
        for w in set(v):
            out.setdefault(w, []).append(k)
    return out


ASKED = {k: regex.compile(rf"\b(?:in|auf|en|into)\s+(?:{v})\b|(?:only|nur|seulement|solo)\s+(?:{v})\b|[用请以](?:{v})") for k, v in LANGUAGE_NAMES.items()}


def asked_language(prompt: str) -> str | None:
    """The language that the prompt asks for, else None."""
    low = prompt.lower()
    return next((k for k, v in ASKED.items() if v.search(low)), None)


LAST_WORDS_COMPLETE = regex.compile(r"(?i)(?:^|[.!?\s])(?:final answer|answer|so|result|the result is|antwort|réponse|respuesta|答案)\s*[:：]\s*\S.{0,40}$")


def is_truncated(prompt: str, text: str) -> bool:
    """Breaks off inside a word, sentence, list, code, table, tag or formula; a bare short answer is complete."""
    whole = SPECIAL.sub("", text) if "<" in text or "[" in text else text
    answer, _, unfinished = split_reasoning(whole)
    if unfinished:
        return True
    # plain text has nothing to clean but runs of blanks
    t = (answer if answer.isascii() and not CONTROLS.search(answer) else rx(r"(?V1)[[\p{Cf}\p{Cc}\p{Zs}\p{Zl}\p{Zp}\uFFFD]--[\n]]+").sub(" ", answer)).strip()
    if not t:
        return False
    if t.count("```") % 2 or "<" in t[-14:] and rx(r"</?[A-Za-z]{0,12}$").search(t):
        return True
    if "<" in t and any(t.count(f"<{tag}>") > t.count(f"</{tag}>") for tag in ("answer", "search", "information", "tool_call", "code")):
        return True
    box = t.rfind("\\boxed")
    if box >= 0 and t[box:].count("{") > t[box:].count("}") or t.endswith("\\boxed"):
        return True
    if t.count("$") % 2 and rx(r"\$[^$\s\d][^$]*$|\$\s*$").search(t):
        return True
    lines = t.split("\n")
    last = lines[-1].strip()
    if t.endswith("```"):
        return False
    if "\\" in last and rx(r"\\[a-zA-Z]*$").search(t):
        return True
    if last.startswith("|"):
        first = next((x.strip() for x in lines if x.strip().startswith("|")), last)
        return last.count("|") < first.count("|") or not last.endswith("|")
    if rx(r"(?:\d+[.)]|[-*+•]|#+)").fullmatch(last):
        return True
    if any(last.count(a) > last.count(b) for a, b in (("(", ")"), ("[", "]"), ("{", "}"), ("（", "）"))) or last.count('"') % 2:
        return True
    if rx(r"[:：,，、;；(\[{=\-–—/&+]$").search(last):
        return True
    bare = rx(r"[\"'”’»)\]}*_`>$\s]+$").sub("", last)
    if not bare or rx(r"[.!?。！？…]$").search(bare) or bare != last and rx(r"[)}\]`*_>$]$").search(last):
        return False
    words = last.split()
    if LAST_WORDS_COMPLETE.search(last):
        return False
    item = rx(r"(?:\d+[.)]|[-*+•])\s+").match(last)
    if item:
        marked = [x.strip() for x in lines[:-1] if rx(r"\s*(?:\d+[.)]|[-*+•])\s+").match(x)]
        if marked and all(rx(r"[.!?。！？]$").search(x) for x in marked):
            return True
        if item.group()[0].isdigit():
            return not (marked and rx(r"\d$").search(last))
        return not (len(words) <= 3 and rx(r"\b[\w-]*[_.\d-][\w-]*$").search(last))
    if len(lines) == 1 or len(words) <= 4:
        if len(words) == 1 and len(HAN.findall(last)) <= 8 or len(words) <= 8 and rx(r"\([A-Za-z0-9]\)|[A-Za-z]$|[-\d.,/% ]+$").match(last):
            return False
        if len(words) <= 6 and all(rx(r"[\p{Lu}\d(]").match(w) for w in words):
            return False
        if len(words) <= 6 and len(lines) == 1 and " ".join(words).lower() in prompt.lower():
            return False
    return True


def defect(prompt: str | None, response: str | None, instructions: regex.Pattern = NO_INSTRUCTIONS) -> str | None:
    """The pair's defect, or None. A null response is empty; a null prompt has no question, so only the response is judged."""
    text, ask = response or "", prompt or ""
    answer, reasoned, unfinished = split_reasoning(plain(text))
    copied = bool(ask) and is_copy(ask, text, instructions)
    if not copied and not unfinished and is_empty(answer):
        return "empty"
    if not unfinished and is_refusal(answer, ask):
        return "refusal"
    if copied or ask and not unfinished and answer != text and is_copy(ask, answer, instructions):
        return "copy"
    want = wanted_language(ask, instructions)
    got = language(answer)[0] or answer != text and language(text)[0]
    if want and got and want != got:
        return "other_language"
    return "truncated" if is_truncated(ask, text) else None


def broken_pairs(samples: DataFrame, skip: tuple[str, ...] = ("pending", "aborted")) -> DataFrame:
    """``sample_index, defect`` of every distinct defective sample.

    Samples with a status in ``skip`` are left out; a null status counts. Copies of a row give one row. Extra columns
    are ignored; an empty table gives an empty result.
    """

    fixed = standing_instructions(samples.select("prompt"))

    def judge(batch: pa.RecordBatch):
        pattern = instruction_pattern(fixed)
        found = [defect(p, r, pattern) for p, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        out = pa.table({"sample_index": batch.column(0), "defect": pa.array(found, pa.string())})
        yield out.filter(pa.compute.is_valid(out["defect"]))

    kept = samples.where(F.col("status").isNull() | ~F.col("status").isin(*skip)).select("sample_index", "prompt", "response")
    return map_batches(spread(kept), judge, "sample_index bigint, defect string").distinct()

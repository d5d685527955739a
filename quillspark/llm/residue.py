"""Problem 7: template residue and error-page text.

All documents are cut into short messages, and the templates of all messages are mined with a fixed-depth prefix tree (length, then
leading tokens, then token similarity inside a leaf). Each template is classified once, by the concepts it is made of and by what the corpus says about it, and
its verdict is propagated to all its messages. A document is residue if such messages make up at least half of its words, titles, menus and footers aside.
Unfilled slots are found separately, in the running text of any document.

What the corpus says: (1) a template without a verdict of its own takes that of the pages it stands on if nearly all of its documents are
residue without it; (2) words that stand beside the usual pseudo-Latin, in messages without any function word, are pseudo-Latin too;
(3) letters of a message that a trigram model of the corpus explains worse than a random draw of the same letters are typed at random.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.ordering import materialize

from . import lexicon as lx
from .common import map_batches, spread
from .pairs import LOOKALIKES

#: Verdicts that make a document residue.
RESIDUE = ("error", "script", "filler")
#: Share of a message's words, function words aside, that the concepts of its class must cover.
COVER = 0.75
#: The share for messages of more than four such words, which cover it more easily by chance.
COVER_LONG = 0.8
_TAGS = regex.compile(r"</?[A-Za-z!][^<>{}]*>")
_FOOTER = regex.compile(r"(?i)^(?:ref(?:erence)?|code|id|request(?: id)?)\s*[:#]\s*[\w-]+\W*$|^(?:\(c\)|©|copyright\b).*$|^loading\W*$|^[\W\d]*$|^[0-9a-f]{8,}$")
_WORD = regex.compile(r"\p{Han}|[\p{L}\p{M}\p{N}&&[^\p{Han}]]+(?:['’-][\p{L}\p{M}\p{N}]+)*", regex.V1)
_JSON_ERROR = regex.compile(r"(?i)^\s*\{?\s*\"?error\"?\s*:|\"error\"\s*:\s*[{\"]")
_TRACE = regex.compile(r"(?i)^\s*(?:Traceback \(most recent call last\):|File \"[^\"]*\", line \d+.*|\w*(?:Error|Exception)(?:: .*)?|at [\w.$<>]+\(.*\))\s*$")
_STATUS = regex.compile(r"(?i)\b(?:http|error|status|code|fehler|erreur|错误)?[ /]*[1-5]\d\d\b")
_CODES = regex.compile(r"(?i)\b(?:ref|code|http|id)\b\W*[0-9a-f]{6,}\b|\bref\b|\bhttp\b")
_CALLED = regex.compile(r"(?i)http|error|fehler|erreur|错误")
#: What a line of a trace or of a JSON error must hold.
_FAINT = re.compile(r"error|exception|traceback \(most|file \"")
_ASCII_WORD = re.compile(r"[a-z0-9]+(?:['-][a-z0-9]+)*")
_SENTENCE = re.compile(r"(?<=[.!?。！？…])\s+|(?<=[。！？])")
_DIGIT, _HAN = re.compile(r"\d"), re.compile("[\u3400-\u9fff]")
_CODE_WORD = re.compile(r"[0-9a-f]*\d[0-9a-f]*")
_ITEMS, _LIST = re.compile(r"\s*[|·•»]\s*|\s+[/>]\s+"), re.compile(r"\s*[,，、;；]\s*")
_HEADING, _STOP = re.compile(r"#{1,6}\s"), re.compile(r"[.!?。！？…,，;；:：]$")


def _items(line: str) -> list[str] | None:
    """Items of a list in one line: three or more, none of more than four words."""
    signs = any(c in line for c in "|·•»") or " / " in line or " > " in line
    for cut, found in ((_ITEMS, signs), (_LIST, any(line.count(c) > 1 for c in ",，、;；"))):
        if not found:
            continue
        parts = [p for p in cut.split(line) if p.strip()]
        if len(parts) >= 3 and all(len(p.split()) <= 4 and len(p) <= 40 for p in parts):
            return parts
    return None


def messages(text: str) -> list[str]:
    """The text as short messages: lines, sentences, and the items of lists in a line; markup only separates."""
    return [m for m, _ in cut(text)]


def cut(text: str) -> list[tuple[str, bool]]:
    """Messages, and whether each is an item of a menu: of a list in a line, or of three or more short lines in a row."""
    out: list[tuple[str, bool]] = []
    short: list[int] = []  # a run of short lines

    def close() -> None:
        if len(short) >= 3:
            for k in short:
                out[k] = (out[k][0], True)
        short.clear()

    low = text.lower()
    faint = bool(_FAINT.search(low))
    for line in (_TAGS.sub("\n", text) if "<" in text else text).splitlines():
        line = line.strip()
        if not line:
            close()
            continue
        if len(line) <= 24 and len(line.split()) <= 3 and not _STOP.search(line) and not any(c.isdigit() for c in line):
            short.append(len(out))
            out.append((line, False))
            continue
        close()
        if (faint or line.startswith("at ")) and (_JSON_ERROR.search(line) or _TRACE.match(line)):
            out.append((line, False))
        elif line[0] != "#" and (parts := _items(line)):
            out += [(p.strip(), True) for p in parts]
        else:
            out += [(s.strip(), False) for s in _SENTENCE.split(line) if s and s.strip()]
    close()
    return out


def mask(message: str) -> list[str]:
    """Tokens of the message with numbers and identifiers masked."""
    if message.isascii():
        found = _ASCII_WORD.findall(message.lower())
    else:
        found = _WORD.findall(unicodedata.normalize("NFKC", message).lower())
    return ["<*>" if _CODE_WORD.fullmatch(w) else w for w in found] if _DIGIT.search(message) else found


def form(message: str) -> int:
    """What a verdict rests on beside words: 1 a footer, 2 a JSON error or a line of a trace, 4 nothing but a status code with its name."""
    m = message.strip()
    if _FOOTER.match(m):
        return 1
    low = m.lower()
    if (low.startswith("at ") or _FAINT.search(low)) and (_JSON_ERROR.search(m) or _TRACE.match(m)):
        return 2
    if len(m) <= 40 and _STATUS.search(m) and _CALLED.search(m) and not _WORD.search(_STATUS.sub(" ", _CODES.sub(" ", m))):
        return 4
    return 0


def _covered(kinds: list[str], has: str, classes: str) -> float:
    """Share of the words with content that are of the classes, if any is of ``has``; function words count where they are of the classes."""
    own = [k for k in kinds if k != "-"]
    if not own or not any(c in k for k in own for c in has):
        return 0.0
    good = sum(any(c in k for c in classes) for k in own)
    n = max(1, len(own) - sum("-" in k and not any(c in k for c in classes) for k in own))
    share = good / n
    return share if n <= 4 or share >= COVER_LONG else 0.0


def _judge(kinds: list[str]) -> str:
    """Verdict of the concepts of one language's words."""
    if any("S" in k for k in kinds) and _covered(kinds, "R", "SRTAHfF") >= COVER:
        return "script"
    strong, text = any("P" in k for k in kinds), any("N" in k for k in kinds)
    if (strong or text and any("p" in k for k in kinds)) and _covered(kinds, "Pp", "PpN") >= 0.99:
        return "filler"
    failed = any("F" in k for k in kinds)
    acts = sum("A" in k or "T" in k for k in kinds)
    weak = any("f" in k for k in kinds) and (acts >= 2 or acts == 1 and (len(kinds) == 2 or any("T" in k for k in kinds) and sum("-" not in k for k in kinds) <= 2))
    if (failed or weak) and _covered(kinds, "Ff", "TFfAH") >= COVER:
        return "error"
    return "frame" if _covered(kinds, "H", "HTA") >= COVER and sum("H" in k for k in kinds) >= 2 else "content"


def _by_script(words: list[str]) -> str:
    """Verdict by the language that gives one."""
    rows = [lx.concepts(w) for w in words]
    best = "content"
    for i in range(len(lx.ALPHABETIC)):
        own = _judge([r[i] for r in rows])
        if own in RESIDUE:
            return own
        best = own if own != "content" else best
    return best


def _is_han(word: str) -> bool:
    return len(word) == 1 and "\u3400" <= word <= "\u9fff"


def _by_han(words: list[str]) -> str:
    """Verdict by Chinese terms, each weighing its characters."""
    terms, total = lx.han_concepts("".join(w if _is_han(w) else f" {w} " for w in words)), sum(map(_is_han, words))
    kinds = [k for k, n in terms for _ in range(n)] + [""] * max(0, total - sum(n for _, n in terms))
    kinds += [x for w in words if not _is_han(w) for x in lx.concepts(w)[:1]]
    return _judge(kinds)


def may_decide(tokens: list[str]) -> bool:
    """False where no verdict but ``content`` is possible."""
    words = [w for w in tokens if w != "<*>"]
    text = " ".join(words)
    if not text.isascii() and (found := _HAN.findall(text)):
        known = sum(n for _, n in lx.han_concepts("".join(words)))
        return known >= COVER * len(found) and _by_han(words) != "content"
    bits = lx.BITS
    return not words or lx.decisive([bits[w] for w in words], COVER)


def judge_tokens(tokens: list[str], shape: int = 0) -> str:
    """``script``, ``error``, ``filler``, ``frame`` (footers, advice) or ``content``, by the form and by the concepts of the masked tokens."""
    if shape:
        return "frame" if shape == 1 else "error"
    words = [w for w in tokens if w != "<*>"]
    if not words:
        return "frame"
    if any(w in lx.LATIN_MARKS for w in words) and sum(w in lx.LATIN for w in words) >= 0.8 * len(words) and len(words) >= 2 or sum(map(lx.is_key_run, words)) >= 0.8 * len(words):
        return "filler"
    return _by_han(words) if any(map(_is_han, words)) else _by_script(words)


def classify(message: str) -> str:
    """Verdict of a message."""
    return judge_tokens(mask(message), form(message))


@lru_cache(maxsize=100_000)
def signature(word: str) -> str:
    """What a word may decide: members of a template differ only in words that have no part in any verdict."""
    kinds = lx.concepts(word)
    return word if any(kinds) or word in lx.LATIN or lx.is_key_run(word) or "\u3400" <= word <= "\u9fff" else ""


def is_title(message: str, position: int) -> bool:
    """A heading, or an opening line without end punctuation."""
    return bool(_HEADING.match(message)) or position == 0 and not _STOP.search(message) and len(_WORD.findall(message)) <= 16


# ---- letters typed at random -------------------------------------------------------------------------------------
#: All letters of all documents are counted. A longer document weighs as much as one of so many letters, or it would explain itself; and all documents
#: together weigh as much as so many, or short sentences would be judged by a model that is sharper the larger the corpus.
DOCUMENT_WEIGHT, CORPUS_WEIGHT = 4096, 1_500_000
#: What a letter of a document below that weight counts: sums of whole numbers don't depend on their order.
_UNIT = 1 << 20
#: Least words and letters of a message that can be judged.
LEAST_WORDS, LEAST_LETTERS = 5, 16
#: By how many nats a letter the model must be worse. Random typing lies 1.2 to 4.5 below a random draw, code, names and foreign texts at most 0.7 (1.0 without any corpus).
MARGIN = 1.0
_LETTERS = regex.compile(r"[\p{Latin}\p{M}]+")
_ALPHABET = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
_SIDE = len(_ALPHABET) + 1
_TABLE = np.array([_ALPHABET.get(chr(i), 0) for i in range(256)], dtype=np.int64)


def _codes(words: list[str]) -> np.ndarray:
    plain = f" {' '.join(words)} "
    if plain.isascii():
        return _TABLE[np.frombuffer(plain.encode(), dtype=np.uint8)]
    plain = unicodedata.normalize("NFD", plain)
    return np.array([_ALPHABET.get(c, 0) for c in plain if not unicodedata.combining(c)], dtype=np.int64)


def _text_codes(text: str) -> np.ndarray:
    """Codes of the text's words as ``_codes`` gives them; ASCII needs no look at each word."""
    low = text.lower()
    if not low.isascii():
        return _codes(_LETTERS.findall(low))
    c = _TABLE[np.frombuffer(f" {low} ".encode(), dtype=np.uint8)]
    return c[np.append(True, (c[1:] != 0) | (c[:-1] != 0))]


def _trigrams(codes: np.ndarray) -> np.ndarray:
    return np.bincount((codes[:-2] * _SIDE + codes[1:-1]) * _SIDE + codes[2:], minlength=_SIDE**3)


def count_letters(texts: Iterable[str | None]) -> np.ndarray:
    """Weighted counts of all trigrams of the texts, in units."""
    out = np.zeros(_SIDE**3, dtype=np.int64)
    for t in texts:
        if t and len(c := _text_codes(t)) > 2:
            n = len(c) - 2
            out += _trigrams(c) * max(1, _UNIT * min(n, DOCUMENT_WEIGHT) // n)
    return out


class Letters:
    """Trigram model of letters of texts, or of their counts, smoothed with bigrams and single letters; the vocabularies of the package are always part of it."""

    def __init__(self, texts: Iterable[str | None], counts: np.ndarray | None = None):
        own = sorted(lx.COMMON) + [w.strip("$") for v in lx.CONCEPTS.values() for x in v.values() for w in x.split()] + sorted(lx.LATIN)
        found = (count_letters(texts) if counts is None else counts) / _UNIT
        tri = (_trigrams(_codes(own)) + found * min(1.0, CORPUS_WEIGHT / max(1.0, found.sum()))).reshape(_SIDE, _SIDE, _SIDE)
        bi = tri.sum(axis=0)
        one = (bi.sum(axis=0) + 1) / (bi.sum() + _SIDE)
        p2 = (bi + 8 * one) / (bi.sum(axis=1, keepdims=True) + 8)
        self.log = np.log((tri + 8 * p2) / (tri.sum(axis=2, keepdims=True) + 8)).astype(np.float32).ravel()

    def random(self, message: str) -> bool:
        """Drawing the message's own letters independently explains it far better than the model does; hardly a function word stands in it."""
        words = _LETTERS.findall((message if message.isascii() else unicodedata.normalize("NFKC", message).translate(LOOKALIKES)).lower())
        if len(words) < LEAST_WORDS or sum(map(len, words)) < LEAST_LETTERS or _strange(words) < 0.88:
            return False
        c = _codes(words)
        model = float(self.log[(c[:-2] * _SIDE + c[1:-1]) * _SIDE + c[2:]].sum())
        n = np.bincount(c[2:], minlength=_SIDE)
        n = n[n > 0]
        return model < float((n * np.log(n / n.sum())).sum()) - MARGIN * len(c)


def _strange(words: list[str]) -> float:
    """Share of the words that are no function words of any language."""
    return sum(w not in lx.COMMON for w in words) / len(words)


def letters_of(documents: DataFrame, text_col: str) -> Letters:
    """The model of all letters of all documents; each task counts its own, and one sum for each trigram (at most 19,683) comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIDE**3, dtype=np.int64)
        for batch in batches:
            total += count_letters(t.as_py() for t in batch.column(0))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": at, "n": total[at]})

    counts = np.zeros(_SIDE**3, dtype=np.int64)
    for at, n in spread(documents.select(text_col)).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        counts[at] = n
    return Letters([], counts)


# ---- unfilled slots ----------------------------------------------------------------------------------------------
_NAME = r"[\p{L}][\p{L}\p{N}]*(?:[ _.-][\p{L}\p{N}]+){0,4}"
#: The usual names of slots, for the forms that plain text has too.
SLOT_NAMES = "name|first name|last name|full name|user name|username|company|company name|organization|city|country|region|address|date|deadline|time|email|e-mail|phone|link|url|team|owner|author|title|site title|topic|summary|description|product|product name|version|dataset|model name|model|checkpoint|score|count|reward mean|run id|num steps|number|amount|price|project|customer|client|recipient|sender|signature|position|department|placeholder"
SLOTS = [
    regex.compile(rf"\{{\{{\s*{_NAME}\s*\}}\}}"), regex.compile(rf"<%=?\s*{_NAME}\s*%>"), regex.compile(rf"[$#]\{{\s*{_NAME}\s*\}}"), regex.compile(rf"%\({_NAME}\)[sdf]"),
    regex.compile(rf"\{{%\s*{_NAME}\s*%\}}"), regex.compile(rf"@@{_NAME}@@"), regex.compile(r"(?<![\w])__[A-Z][A-Z0-9_]*[A-Z0-9]__(?![\w])|(?<![A-Za-z0-9_])__[A-Z][A-Z0-9_]*[A-Z0-9]__"), regex.compile(r"%[A-Z][A-Z0-9_]{2,}%"),
    regex.compile(r"\$[A-Z][A-Z0-9_]{2,}\$"), regex.compile(r"<\s*(?:YOUR|INSERT|ENTER)[_ ][A-Z0-9_ ]+>"), regex.compile(r"(?i)\[\s*(?:insert|enter|your|add|fill in|hier|insérer|insertar|votre|su)\s[^\[\]\n]{1,60}\]"),
    regex.compile(rf"(?i)\((?:{_NAME})\s+(?:TBD|TBA|TODO)\)|\[(?:{_NAME})\s+(?:TBD|TBA|TODO)\]"), regex.compile(rf"(?i)\[(?:{SLOT_NAMES})\](?![(:\[])"),
    regex.compile(r"(?<![\\\w$#{}^_])\{[a-z][a-z0-9]*(?:_[a-z0-9]+)*\}(?!\})"), regex.compile(r"(?<![\\\w$#{}^_])\{(?:[A-Z][A-Z0-9_]{2,})\}(?!\})"),
]
#: Slot names that are also names of markup elements.
MARKUP_NAMES = {"title", "link", "time", "address", "summary"}
ANGLE = regex.compile(rf"(?<![\w<])<\s?({'|'.join(n.replace(' ', '[ _-]') for n in SLOT_NAMES.split('|'))})\s?>", regex.I)
SLOT_TRIGGER = re.compile(r"\{\{|<%|[$#]\{|%\(|@@|__[A-Z]|[%$][A-Z]|T(?:BD|BA|ODO)|(?i:tb[da]\b|todo\b)|\[\s*[^\W\d_]|<\s*[A-Za-z]|\{\s*[A-Za-z%]")
_CODE = regex.compile(r"(?s)```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|(?<!`)(`{1,2})(?!`)[^\n]*?\1|<(pre|code|script|style)\b.*?</\2>|(?m:^[^\n]*\{%-?\s*(?:for|if|elif|else|endif|endfor|set|block|endblock|macro|include|extends|raw|with)\b[^\n]*$)")
_CODE_LINE = regex.compile(r"^\s*(?:def |class |import |from \w+ import|return\b|print\(|if .*:$|for .*:$|while .*:$|[\w.\[\]]+\s*[-+*/]?=\s|[{}\[\]();]+\s*$|//|/\*|\$ |>>> |assert |run_|export |echo |curl |sudo |npm |pip |git )|;\s*$")
_QUOTES = "\"'“”‘’«»„`"


def has_slot(text: str) -> bool:
    """An unfilled slot stands in running text, outside code, quotes and template examples."""
    if not any(c in text for c in "{<%$@[") and "__" not in text and not any(w in text.lower() for w in ("tbd", "tba", "todo")) or not SLOT_TRIGGER.search(text):
        return False
    plain = _CODE.sub(" ", text)
    for line in plain.splitlines():
        if not SLOT_TRIGGER.search(line) or _CODE_LINE.search(line):
            continue
        for p in SLOTS:
            for m in p.finditer(line):
                before, after = line[: m.start()][-1:], line[m.end() :][:1]
                if not (before and before in _QUOTES and after and after in _QUOTES):
                    return True
        for m in ANGLE.finditer(line):
            name = m.group(1).lower()
            if name not in MARKUP_NAMES or f"</{name}" not in text.lower() and not regex.search(r"(?i)<(?:html|head|body|meta|svg|details)\b", text):
                before, after = line[: m.start()][-1:], line[m.end() :][:1]
                if not (before and before in _QUOTES and after and after in _QUOTES):
                    return True
    return False


# ---- templates ---------------------------------------------------------------------------------------------------
#: Leading tokens that the prefix tree looks at.
DEPTH = 3
#: Least share of equal tokens for a message to join a template of its leaf.
SIMILARITY = 0.6
#: Messages of a leaf that are clustered at once; a larger leaf is cut where its further tokens change, in their order.
LEAF = 2048
#: A template without a verdict takes that of its pages if it stands on at least so many and this share of them is residue without it, more of it than the template is.
LEAST_PAGES, PAGE_SHARE = 3, 0.9


def mine_leaf(rows: list[tuple[int, list[str], int, int]]) -> list[tuple[int, int, str]]:
    """Clusters one leaf's messages (key, masked tokens, form, count) into templates and classifies each template once: key, template, verdict.

    A template's members agree in their form and in every token that has a part in a verdict, so the verdict of the most frequent is that of all.
    """
    if len(rows) == 1:
        return [(rows[0][0], rows[0][0], judge_tokens(rows[0][1], rows[0][2]))]
    rows = sorted(rows, key=lambda r: (-r[3], r[1], r[0]))
    ids: dict[str, int] = {}
    grid = np.array([[ids.setdefault(w, len(ids)) for w in r[1]] for r in rows], dtype=np.int32)
    parts = np.array([ids[w] + 1 if signature(w) else 0 for w in list(ids)], dtype=np.int32)[grid]
    shape = np.array([r[2] for r in rows])
    out = []
    open_ = np.arange(len(rows))
    while len(open_):
        head = open_[0]
        joins = ((grid[open_] == grid[head]).mean(axis=1) >= SIMILARITY) & (parts[open_] == parts[head]).all(axis=1) & (shape[open_] == shape[head])
        joins[0] = True
        members = open_[joins]
        verdict = judge_tokens(rows[head][1], rows[head][2])
        out += [(rows[m][0], rows[head][0], verdict) for m in members]
        open_ = open_[~joins]
    return out


def mine_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Templates and verdicts of messages (``width, tokens, key, form, n``) that come sorted by width and tokens: a leaf's messages stand together.

    Memory holds one leaf, at most ``LEAF`` messages of it.
    """
    leaf: list[tuple[int, list[str], int, int]] = []
    at, out = None, []

    def done(force: bool = False):
        if out and (force or len(out) >= 4096):
            k, t, v = zip(*out, strict=True)
            out.clear()
            yield pa.table({"key": pa.array(k, pa.int64()), "template": pa.array(t, pa.int64()), "verdict": pa.array(v, pa.string())})

    for batch in batches:
        for width, tokens, key, shape, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = tokens.split(" ")
            here = (width, words[:DEPTH])
            if leaf and (here != at or len(leaf) >= LEAF):
                out += mine_leaf(leaf)
                leaf = []
                yield from done()
            at = here
            leaf.append((key, words, shape, n))
    if leaf:
        out += mine_leaf(leaf)
    yield from done(True)


def mine(unique: DataFrame) -> DataFrame:
    """``key, template, verdict`` of every distinct message (``width, tokens, key, form, n``).

    Messages are range-partitioned by their path in the prefix tree, so a leaf of any size is spread by its further tokens, and the
    number of partitions follows the session's and the data's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in mine_sorted(batches):
            yield from out.to_batches()

    path = unique.select("width", "tokens", "key", "form", "n")
    parts = max(int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions")), unique.sparkSession.sparkContext.defaultParallelism)
    return path.repartitionByRange(parts, "width", "tokens", "key").sortWithinPartitions("width", "tokens", "key").mapInArrow(run, "key long, template long, verdict string")


def learned_latin(odd: DataFrame) -> DataFrame:
    """``key`` of the messages without common words (``key, tokens``) whose words stand beside pseudo-Latin; learnt in two rounds."""
    words = odd.select("key", F.explode(F.array_distinct(F.split("tokens", " "))).alias("w")).where((F.length("w") > 1) & (F.col("w") != "<*>"))
    words = materialize(words.withColumn("m", F.col("w").isin(*sorted(lx.LATIN_MARKS))))
    for _ in range(2):
        per = words.groupBy("key").agg(F.sum(F.col("m").cast("int")).alias("marks"))
        beside = words.join(per.where("marks > 0"), "key").groupBy("w").agg(F.sum((F.col("marks") - F.col("m").cast("int") > 0).cast("int")).alias("seen")).where("seen >= 1")
        total = words.groupBy("w").agg(F.count(F.lit(1)).alias("k"))
        known = beside.join(total, "w").where("k >= 3 and seen >= 0.3 * k").select("w", F.lit(True).alias("known"))
        words = materialize(words.join(known, "w", "left").select("key", "w", (F.col("m") | F.coalesce("known", F.lit(False))).alias("m")))
    return words.groupBy("key").agg(F.avg(F.col("m").cast("double")).alias("share"), F.count(F.lit(1)).alias("k")).where("share >= 0.8 and k >= 2").select("key")


def residue(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct ids of documents that are template residue, with ``slot`` and ``message`` telling why.

    Null and empty texts are no residue. Every document is read whole and cut into messages; messages without any word or form that a verdict could rest on keep
    their key only (and their words, if none of them is common), all others are mined. Repeated ids give one row; other columns are ignored.
    """
    kind = dict(documents.dtypes)[id_col]
    model = documents.sparkSession.sparkContext.broadcast(letters_of(documents, text_col))  # a table of fixed size

    def scan(batch: pa.RecordBatch):
        ids, slot, key, path, width, shapes, size, rest, odd = [], [], [], [], [], [], [], [], []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not t:
                continue
            if has_slot(t):
                ids.append(i), slot.append(True), key.append(0), path.append(None), width.append(0), shapes.append(0), size.append(0), rest.append(0), odd.append(0)
                continue
            seen: dict[str, list[int]] = {}
            for k, (m, menu) in enumerate(cut(t)):
                own = seen.setdefault(m, [0, 0])
                own[0] += 1
                own[1] += menu or m[0] == "#" and is_title(m, -1) or k == 0 and is_title(m, 0)  # a heading is one wherever it stands, an opening line only at its first place
            for m, (times, aside) in seen.items():
                tok, shape = mask(m), form(m)
                own, strange = len(tok) - tok.count("<*>"), 0
                if own >= 3 and m[0].isalpha():
                    found = [w for w in tok if len(w) > 1 and w != "<*>"]
                    if found and "\u3400" > found[0][0] and _strange(found) >= (1 if len(found) < 6 else 0.85):
                        strange = 2 if model.value.random(m) else 1
                tokens = " ".join(tok)
                mined = shape > 0 or may_decide(tok)
                ids.append(i), slot.append(False), path.append(tokens if mined or strange else None), width.append(len(tok) if mined else -1), shapes.append(shape), odd.append(strange)
                key.append(xxhash.xxh64_intdigest(tokens.encode("utf-8", "replace"), shape) - (1 << 63)), size.append(max(own, 1) * times), rest.append(own * (times - aside))
        yield pa.table({
            "id": pa.array(ids, batch.column(0).type), "slot": pa.array(slot, pa.bool_()), "key": pa.array(key, pa.int64()), "tokens": pa.array(path, pa.string()), "width": pa.array(width, pa.int32()),
            "form": pa.array(shapes, pa.int32()), "words": pa.array(size, pa.int32()), "body": pa.array(rest, pa.int32()), "odd": pa.array(odd, pa.int32()),
        })

    found = materialize(map_batches(spread(documents.select(id_col, text_col)), scan, f"id {kind}, slot boolean, key long, tokens string, width int, form int, words int, body int, odd int"))
    slots = found.where("slot").select("id", F.lit(True).alias("slot"))
    said = found.where(~F.col("slot"))
    # equal messages, but for numbers, are mined once
    named = said.where("tokens is not null")
    unique = named.where("width >= 0").groupBy("key").agg(F.first("width").alias("width"), F.first("tokens").alias("tokens"), F.first("form").alias("form"), F.count(F.lit(1)).alias("n"))
    mined = materialize(mine(unique))
    typed = named.where("odd = 2").select("key").distinct()
    latin = learned_latin(named.where("odd > 0").groupBy("key").agg(F.first("tokens").alias("tokens")))
    judged = mined.where("verdict <> 'content'").select("key", "verdict").unionByName(typed.unionByName(latin).select("key", F.lit("filler").alias("verdict")))
    # written: the planner sees how small this side is, and else joins by key
    verdicts = materialize(judged.groupBy("key").agg(F.max(F.col("verdict").isin(*RESIDUE)).alias("bad")))
    rows = said.select("id", "words", "body", "key").join(verdicts, "key", "left")
    # a message counts as often as it stands in the document
    bad, content = F.sum(F.when(F.col("bad"), F.col("words")).otherwise(0)).alias("bad_words"), F.sum(F.when(F.col("bad").isNull(), F.col("body")).otherwise(0)).alias("content")
    per_doc = materialize(rows.groupBy("id").agg(bad, content).where("bad_words > 0"))
    # what the corpus says about templates without a verdict on documents that hold some residue; a message that was not mined is a template of its own
    near = rows.where("bad is null").join(per_doc, "id").select("id", "words", "body", "key", "bad_words", "content")
    plain = materialize(near.join(mined.select("key", "template"), "key", "left").withColumn("template", F.coalesce("template", "key")))
    company = plain.groupBy("template").agg(F.sum((F.col("bad_words") >= F.greatest(F.col("content") - F.col("body"), F.col("body"))).cast("long")).alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    keys = materialize(company.join(mined.select("key", "template").unionByName(plain.select(F.col("template").alias("key"), "template")).distinct(), "template").select("key", "template", "pages"))
    stands = said.select("id", "key").join(keys, "key").groupBy("template", "pages").agg(F.count(F.lit(1)).alias("n")).where(F.col("pages") >= PAGE_SHARE * F.col("n"))
    more = plain.join(stands.select("template"), "template", "left_semi").groupBy("id").agg(F.sum("words").alias("more_words"), F.sum("body").alias("more_body"))
    whole = per_doc.join(more, "id", "left").na.fill(0, ["more_words", "more_body"])
    pages = whole.where("content - more_body <= bad_words + more_words").select("id", F.lit(False).alias("slot"))
    out = slots.unionByName(pages).groupBy("id").agg(F.max("slot").alias("slot"))
    return out.select(F.col("id").alias(id_col), "slot", (~F.col("slot")).alias("message"))

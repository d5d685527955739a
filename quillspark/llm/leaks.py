"""Problem 2: evaluation texts leaking into training text.

Every evaluation question is cut into windows of several item sizes, and each window gets a 256-bit SimHash over its word shingles, weighted by
their rarity among the questions. Corpus texts are cut into windows of the same sizes, one at every position where a shingle known from
the questions begins; shingles that no question has weigh nothing. Multi-index Hamming blocks of 16 bits, looked up in tables, find every window of a question
within ``RADIUS`` of a text's window (two fingerprints that differ in fewer bits than there are blocks agree in a block), and an exact
weighted-shingle comparison over the whole question decides.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_INSTRUCTIONS, instruction_pattern, map_batches, mix64, spread, standing_instructions
from .pairs import LOOKALIKES

#: Words of a shingle: the runs that count as shared have three words or more.
SHINGLE = 3
#: A leak lies in a stretch of at most this many times the question's words.
STRETCH = 1.4
#: Least share of the question's words in shared runs.
SHARE = 0.5
BITS, BLOCK_BITS = 256, 16
#: Fingerprints within this Hamming distance are found without exception: one less than there are blocks.
RADIUS = BITS // BLOCK_BITS - 1
#: Words of the smallest windows: as few as the shortest run that counts, so that every shared run has a window at distance 0. The others are twice as large each, up to the question's size.
SMALLEST = SHINGLE
#: Positions of known shingles in a text that are held at once.
SEGMENT = 16_384
#: Questions of one index, and indexes that are searched in one pass over the corpus.
INDEX_ITEMS, PASS_INDEXES = 2_000, 8

_WORD = regex.compile(r"\p{Han}|[\p{L}\p{N}&&[^\p{Han}]]+", regex.V1)
_ASCII_WORD = re.compile(r"[a-z0-9]+")
_TAG = regex.compile(r"</?[a-zA-Z][^<>]{0,80}>")
_HYPHEN = regex.compile(r"(?<=\p{L})[-‐]\s*\n[\s>#*|]*(?=\p{L})")
_UNICODE, _ESCAPE, _PERCENT = regex.compile(r"\\u([0-9a-fA-F]{4})"), regex.compile(r"\\[ntr]"), regex.compile(r"%[0-9A-Fa-f]{2}(?:%[0-9A-Fa-f]{2})*")
_FORMAT, _COMBINING = regex.compile(r"\p{Cf}"), regex.compile(r"\p{M}")


_ONES = np.array([i.bit_count() for i in range(256)], dtype=np.uint8)


def leak_words(text: str | None) -> list[str]:
    """Words after undoing case, spacing, line breaks, punctuation, markup, escapes and character forms."""
    if not text:
        return []
    t = text
    if "&" in t:
        t = html.unescape(html.unescape(t))
    if "\\" in t:
        t = _ESCAPE.sub(" ", _UNICODE.sub(lambda m: chr(int(m.group(1), 16)), t))
    if "%" in t:
        t = _PERCENT.sub(lambda m: bytes.fromhex(m.group().replace("%", "")).decode("utf-8", "ignore") or " ", t)
    if not t.isascii():
        t = _FORMAT.sub("", unicodedata.normalize("NFKC", t)).translate(LOOKALIKES)
        t = _COMBINING.sub("", unicodedata.normalize("NFD", t))
    if "<" in t:
        t = _TAG.sub(" ", t)
    if "\n" in t and ("-" in t or "‐" in t):
        t = _HYPHEN.sub("", t)
    for mark in "*_~`\\":
        if mark in t:
            t = t.replace(mark, "")
    t = t.lower()
    return _ASCII_WORD.findall(t) if t.isascii() else _WORD.findall(t)


def question_words(prompt: str | None, instructions: regex.Pattern = NO_INSTRUCTIONS) -> list[str]:
    """The item's question: its prompt without answer-format instructions and the word that announces it."""
    return leak_words(regex.sub(r"(?i)^\s*question:\s*", "", instructions.sub(" ", prompt or "").strip()))


class Index:
    """Fingerprints and shingles of the questions.

    Every leak is among the candidates: it shares a run of at least ``SMALLEST`` words with the question, and equal windows have equal fingerprints.
    """

    def __init__(self, items: list[tuple[int, list[str]]]):
        items = [(i, w) for i, w in items if len(w) >= SHINGLE]
        self.ids, self.words = [i for i, _ in items], [w for _, w in items]
        code: dict[str, int] = {}
        for w in self.words:
            for x in w:
                code.setdefault(x, len(code) + 1)
        self.code, self.base = code, len(code) + 1
        grams = [self.shingles(np.array([code[x] for x in w], dtype=np.int64)) for w in self.words]
        count = Counter(g for s in grams for g in set(s.tolist()))
        self.keys = np.array(sorted(count), dtype=np.int64)
        # whole numbers: equal windows have equal sums, whatever stands before them
        self.weight = np.array([max(1, round(8 * math.log(1 + len(items) / count[k]))) for k in self.keys.tolist()], dtype=np.int32)
        self.places: list[dict[int, list[int]]] = []
        for s in grams:
            own: dict[int, list[int]] = {}
            for j, g in enumerate(s.tolist()):
                own.setdefault(g, []).append(j)
            self.places.append(own)
        self.least = min((math.ceil(SHARE * len(w) / SHINGLE) for w in self.words), default=1)
        longest = max((len(w) for w in self.words), default=0)
        self.sizes = [n for n in (SMALLEST << k for k in range(32)) if n <= longest]
        self.prints, self.owner = self._windows(grams)
        blocks = self.prints.view("<u2")
        self.order = [np.argsort(blocks[:, b], kind="stable").astype(np.int32) for b in range(BITS // BLOCK_BITS)]
        self.start = [np.searchsorted(blocks[o, b], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int32) for b, o in enumerate(self.order)]

    def shingles(self, codes: np.ndarray) -> np.ndarray:
        if len(codes) < SHINGLE:
            return np.zeros(0, dtype=np.int64)
        return (codes[:-2] * self.base + codes[1:-1]) * self.base + codes[2:]

    def sums(self, known: np.ndarray) -> np.ndarray:
        """Running sums of the weighted bits of the known shingles (numbers of ``keys``)."""
        keys = self.keys[known].astype(np.uint64)
        bits = np.stack([mix64(keys + np.uint64(1 + i * 0x51ED2701)) for i in range(BITS // 64)], axis=1)
        signs = np.unpackbits(bits.view(np.uint8).reshape(len(keys), -1), axis=1).astype(np.int32) * 2 - 1
        return np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(signs * self.weight[known][:, None], axis=0, dtype=np.int32)])

    def _windows(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the questions' windows and the question of each."""
        prints, owner = [np.zeros((0, BITS // 8), np.uint8)], [np.zeros(0, np.int32)]
        for k, g in enumerate(grams):
            total = self.sums(np.searchsorted(self.keys, g))
            for n in self.sizes:
                if n <= len(g) + SHINGLE - 1:
                    at = np.unique(np.r_[np.arange(0, len(g) - n + SHINGLE, max(1, n // SMALLEST)), len(g) - n + SHINGLE - 1])
                    prints.append(np.packbits(total[at + n - SHINGLE + 1] - total[at] > 0, axis=1))
                    owner.append(np.full(len(at), k, np.int32))
        return np.ascontiguousarray(np.concatenate(prints)), np.concatenate(owner)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``prints``, window of a question) within the radius."""
        blocks, rows, found = np.ascontiguousarray(prints).view("<u2"), [], []
        for b, (order, start) in enumerate(zip(self.order, self.start, strict=True)):
            low, size = start[blocks[:, b]], start[blocks[:, b].astype(np.int64) + 1] - start[blocks[:, b]]
            own = np.flatnonzero(size)
            if not len(own):
                continue
            n = size[own]
            at = np.repeat(low[own] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            rows.append(np.repeat(own, n)), found.append(order[at])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = np.unique(np.concatenate(rows).astype(np.int64) * len(self.prints) + np.concatenate(found))
        row, window = pair // len(self.prints), pair % len(self.prints)
        good = _ONES[prints[row] ^ self.prints[window]].sum(axis=1, dtype=np.int64) <= RADIUS
        return row[good], window[good]

    def candidates(self, at: np.ndarray, known: np.ndarray) -> set[int]:
        """Questions with a window within the radius of one of the text's; ``at`` are the positions of the known shingles ``known``.

        Windows are taken in segments with their overlap, so that a text of any length needs little memory.
        """
        out: set[int] = set()
        for a in range(0, len(at), SEGMENT):
            last = min(a + SEGMENT, len(at))
            until = int(np.searchsorted(at, at[last - 1] + self.sizes[-1], side="right"))
            own, total = at[a:until], self.sums(known[a:until])
            for n in self.sizes:
                end = np.searchsorted(own, own[: last - a] + n - SHINGLE, side="right")
                start = np.arange(last - a)
                # a window that is half empty is none of this size
                start = start[(end - start) * 2 > n - SHINGLE + 1]
                if len(start):
                    prints = np.unique(np.packbits(total[end[start]] - total[start] > 0, axis=1), axis=0)
                    out.update(self.owner[self.near(prints)[1]].tolist())
        return out

    def share(self, k: int, at: np.ndarray, grams: np.ndarray) -> float:
        """Exact: the largest share of the question's words in runs shared within one stretch of the allowed length."""
        n, own = len(self.words[k]), self.places[k]
        reach, best, now, first = int(STRETCH * n), 0, 0, 0
        match = [(i, j) for i, g in zip(at.tolist(), grams.tolist(), strict=True) for j in own.get(g, ())]
        cover = [0] * n
        for i, j in match:
            for x in range(j, j + SHINGLE):
                now += cover[x] == 0
                cover[x] += 1
            while i + SHINGLE - match[first][0] > reach:
                for x in range(match[first][1], match[first][1] + SHINGLE):
                    cover[x] -= 1
                    now -= cover[x] == 0
                first += 1
            best = max(best, now)
        return best / n

    def find(self, words: list[str]) -> list[int]:
        """Ids of the questions that leak into a text of these words."""
        if not self.ids or len(words) < SHINGLE:
            return []
        get = self.code.get
        grams = self.shingles(np.array([get(w, 0) for w in words], dtype=np.int64))
        place = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[place] == grams)
        if len(at) < self.least:
            return []
        return [self.ids[k] for k in sorted(self.candidates(at, place[at])) if self.share(k, at, grams[at]) >= SHARE]


def leaked_items(texts: DataFrame, items: DataFrame, prompts: DataFrame | None = None) -> DataFrame:
    """``corpus, row_id, item_id``: one row for each corpus row and question that leaks into one of its texts.

    ``texts`` has ``corpus, row_id, text``, ``items`` has ``item_id, prompt``; ``prompts`` (``prompt``) are more prompts to tell the answer-format
    instructions from. Null and empty texts hold nothing; questions of fewer than three words have no run to share and never leak; repeated rows and items give one row. The questions are a
    stated query set: they are read once and broadcast in indexes of ``INDEX_ITEMS``, up to ``PASS_INDEXES`` of them for one pass over the texts.
    """
    kind = {c: dict(t.dtypes)[c] for t, c in ((texts, "row_id"), (items, "item_id"))}
    asked = items.select("prompt") if prompts is None else items.select("prompt").unionByName(prompts.select("prompt"))
    fixed = instruction_pattern(standing_instructions(asked))
    texts = spread(texts.select("corpus", "row_id", "text"))
    schema = f"corpus string, row_id {kind['row_id']}, item_id {kind['item_id']}"
    out, blocks = None, _blocks(items)
    while indexes := [Index([(i, question_words(p, fixed)) for i, p in b]) for b in islice(blocks, PASS_INDEXES)]:
        sent = texts.sparkSession.sparkContext.broadcast(indexes)

        def search(batch: pa.RecordBatch, sent=sent):
            found = []
            for row, t in enumerate(batch.column(2).to_pylist()):
                words = leak_words(t)
                found += [(row, i) for index in sent.value for i in index.find(words)]
            rows = pa.array([r for r, _ in found], pa.int64())
            item = pa.array([i for _, i in found], pa.int64())
            yield pa.table({"corpus": batch.column(0).take(rows), "row_id": batch.column(1).take(rows), "item_id": item})

        one = map_batches(texts, search, schema)
        out = one if out is None else out.unionByName(one)
    if out is None:
        return texts.sparkSession.createDataFrame([], schema)
    return out.distinct()


def _blocks(items: DataFrame):
    """The distinct questions in blocks of at most ``INDEX_ITEMS``."""
    block = []
    for r in items.select("item_id", "prompt").where(F.col("item_id").isNotNull()).distinct().orderBy("item_id", "prompt").toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) == INDEX_ITEMS:
            yield block
            block = []
    if block:
        yield block


def corpus_texts(documents: DataFrame, prompts: DataFrame) -> DataFrame:
    """Every text of the two corpora: documents whole, prompts as one text or one text for each message."""
    docs = documents.select(F.lit("documents").alias("corpus"), F.col("doc_id").alias("row_id"), "text")
    plain = prompts.select(F.lit("prompts").alias("corpus"), F.col("prompt_id").alias("row_id"), F.col("prompt").alias("text")).where(F.col("text").isNotNull())
    turns = prompts.select(F.lit("prompts").alias("corpus"), F.col("prompt_id").alias("row_id"), F.explode("messages.content").alias("text"))
    return docs.unionByName(plain).unionByName(turns)

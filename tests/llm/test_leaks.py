import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import leaks as lk
from quillspark.llm.common import instruction_pattern

ITEMS = [
    (1, "Question: The ashen tanner of Drourque buries 35 weathered feathers near the old mill, then sells twelve of them to a passing baker. How many feathers remain in the morning?"),
    (2, "Answer with the letter of the right option only.\n\nWhy might a borrowed film of hops, cooled by a lens grinder, reverse its drift before noon and glow past the belfry? (A) slow chalk exchange (B) a muddy phase"),
    (3, "Given nested tags of gilded sacks, write a procedure which finds the earliest market day at which 372 trays collide and returns the longest stretch without chalk."),
    (4, "two words"), (5, None),
]


def brute(words, question):
    """Largest share of the question's words in shared runs of three, over all stretches."""
    n, best = len(question), 0
    for a in range(len(words)):
        part = words[a : a + int(lk.STRETCH * n)]
        grams = {tuple(part[i : i + 3]) for i in range(len(part) - 2)}
        cover = {j + k for j in range(n - 2) if tuple(question[j : j + 3]) in grams for k in range(3)}
        best = max(best, len(cover))
    return best / n


FIXED = instruction_pattern(["answer with the letter of the right option only."])


def index():
    return lk.Index([(i, lk.question_words(p, FIXED)) for i, p in ITEMS])


def alter(words, rng, rate):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < rate / 3 else [w, "extra"] if x < 2 * rate / 3 else ["changed"] if x < rate else [w]
    return out


def test_recall_against_brute_force():
    ix, rng = index(), random.Random(3)
    want = found = 0
    for trial in range(400):
        k, words = rng.choice(ITEMS[:3])
        q = lk.question_words(words, FIXED)
        part = q[: len(q) // 2 + 3] if trial % 3 == 0 else q
        noise = [rng.choice(["alpha", "beta", "the", "of", "gamma"]) for _ in range(rng.randrange(40))]
        text = " ".join(noise + alter(part, rng, 0.25) + noise)
        truth = {i for i, p in ITEMS[:3] if brute(lk.leak_words(text), lk.question_words(p, FIXED)) >= lk.SHARE}
        got = set(ix.find(lk.leak_words(text)))
        assert got <= truth
        want, found = want + len(truth), found + len(got & truth)
    assert want > 100 and found / want >= 0.99


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.sets(st.integers(0, lk.BITS - 1), max_size=lk.RADIUS))
def test_blocks_miss_no_pair_within_the_radius(pick, flips):
    ix = index()
    window = pick % len(ix.prints)
    bits = np.unpackbits(ix.prints[window])
    bits[list(flips)] ^= 1
    row, found = ix.near(np.packbits(bits)[None, :])
    assert window in found.tolist() and set(row.tolist()) == {0}


def test_blocks_exclude_nearly_all_random_fingerprints():
    ix, rng = index(), np.random.default_rng(1)
    prints = rng.integers(0, 256, (4000, lk.BITS // 8), dtype=np.uint8)
    blocks, own = prints.view("<u2"), ix.prints.view("<u2")
    passed = np.mean([(blocks[:, None, :] == own[None, k : k + 20]).any(axis=2).mean() for k in range(0, len(own), 20)])
    assert passed < 0.001 and not len(ix.near(prints)[0])


def test_character_forms():
    q = lk.question_words(ITEMS[0][1])
    plain = "the ashen tanner of drourque buries 35 weathered feathers"
    for t in ["The **ashen** _tanner_ of Drourque\nburies 35 weathered feathers", "Ｔhe аshen tanner оf Drourque buries ３５ weathered feathers", "the ashen tan-\n> ner of&nbsp;Drourque buries 35 weath​ered feathers", "the%20ashen tanner of \\u0044rourque buries 35 weathered feathers", "THE ASHEN TANNER OF DROURQUE, BURIES: 35 <b>WEATHERED</b> FEATHERS"]:
        assert lk.leak_words(t) == plain.split()
    assert q[:4] == ["the", "ashen", "tanner", "of"]


def test_instructions_and_openings_are_no_leak():
    ix = index()
    assert ix.find(lk.leak_words("Answer with the letter of the right option only. Why might a borrowed film")) == []
    assert lk.leak_words(None) == [] and ix.find([]) == [] and ix.find(["a", "b"]) == []
    assert lk.Index([]).find("anything at all here".split()) == [] and lk.Index([(1, ["a", "b"])]).find("a b a b".split()) == []
    assert lk.Index([(1, "red fox jumps".split())]).find("the red fox jumps high".split()) == [1]


def test_operator(spark, monkeypatch):
    text = "before " + ITEMS[0][1] + " after"
    rows = [("documents", 1, text, 9), ("documents", 1, text, 9), ("documents", 2, None, 9), ("documents", 3, "", 9), ("prompts", None, text, 9), ("documents", 4, "word " * 200000 + text, 9)]
    texts = spark.createDataFrame(rows, "corpus string, row_id long, text string, item_id int")
    items = spark.createDataFrame([(i, p, "x") for i, p in ITEMS] + [(1, ITEMS[0][1], "x")], "item_id long, prompt string, corpus string")
    want = [("documents", 1, 1), ("documents", 4, 1), ("prompts", None, 1)]
    assert sorted(map(tuple, lk.leaked_items(texts, items).collect()), key=str) == sorted(want, key=str)
    monkeypatch.setattr(lk, "INDEX_ITEMS", 2)  # more questions than an index holds
    assert sorted(map(tuple, lk.leaked_items(texts, items).collect()), key=str) == sorted(want, key=str)
    monkeypatch.setattr(lk, "PASS_INDEXES", 1)  # and than a pass takes
    assert sorted(map(tuple, lk.leaked_items(texts, items).collect()), key=str) == sorted(want, key=str)
    assert lk.leaked_items(texts.limit(0), items).count() == 0 and lk.leaked_items(texts, items.limit(0)).count() == 0
    prompts = spark.createDataFrame([(1, None, [("user", text), ("assistant", None)]), (2, "p", None), (3, None, None)], "prompt_id long, prompt string, messages array<struct<role string, content string>>")
    docs = spark.createDataFrame([(7, "d")], "doc_id long, text string")
    assert lk.corpus_texts(docs, prompts).count() == 4


def test_segments_change_nothing(monkeypatch):
    ix, rng = index(), random.Random(5)
    text = " ".join(" ".join(alter(lk.question_words(rng.choice(ITEMS[:3])[1]), rng, 0.3)) for _ in range(40))
    whole = sorted(ix.find(lk.leak_words(text)))
    monkeypatch.setattr(lk, "SEGMENT", 7)
    assert sorted(ix.find(lk.leak_words(text))) == whole == [1, 2, 3]
    assert ix.find(lk.leak_words(" ".join([ITEMS[0][1]] * 3000))) == [1]


def test_fingerprints_are_stable():
    a, b = index(), index()
    assert np.array_equal(a.prints, b.prints) and np.array_equal(a.owner, b.owner)

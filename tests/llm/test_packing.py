import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import packing as pk
from quillspark.llm.common import encoder, tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=400), st.integers(1, 8), st.floats(0.3, 1.0))
def test_every_constraint_holds(sizes, docs, attention):
    limits = pk.Limits(documents=docs, attention=attention)
    sizes = pk.split(np.array(sizes, dtype=np.int64), limits.largest(64))[2]
    box = pk.best_fit(sizes, 64, limits)
    assert (box >= 0).all() if len(sizes) else len(box) == 0
    for b in np.unique(box):
        own = sizes[box == b]
        assert own.sum() <= 64 and len(own) <= docs
        assert (own.astype(float) ** 2).sum() <= attention * 64**2 + 1e-9
    if docs >= 8 and attention == 1.0 and sizes.sum():
        assert len(np.unique(box)) <= 2 * max(1, -(-sizes.sum() // 64)) + len(sizes) // docs + 1


def test_split():
    item, piece, size = pk.split(np.array([0, 5, 10, 11, 25]), 10)
    assert item.tolist() == [0, 1, 2, 3, 3, 4, 4, 4] and piece.tolist() == [0, 0, 0, 0, 1, 0, 1, 2] and size.tolist() == [0, 5, 10, 10, 1, 10, 10, 5]


def test_little_is_wasted():
    rng = np.random.default_rng(0)
    sizes = np.minimum(rng.lognormal(4.5, 0.8, 5000).astype(np.int64), 1024)
    boxes = len(np.unique(pk.best_fit(sizes, 1024)))
    assert 1 - sizes.sum() / (boxes * 1024) < 0.01


def test_operator(spark):
    rows = [(1, "hello world", 5), (1, "hello world", 5), (2, None, 5), (3, "", 5), (4, "a b c " * 30000, 5), (5, "x" * 100000, 5), (None, "hi there", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pack_id int")
    packs = spark.createDataFrame([(1, 64), (2, 1000), (3, None), (4, 0)], "pack_id int, capacity_tokens int")
    got = pk.pack(docs, packs, shard_items=3).toPandas()
    enc = encoder(tokenizer_path())
    want = sorted(len(enc.encode_ordinary(t)) if t else 0 for _, t, _ in rows)
    for cap, part in got.groupby("capacity_tokens"):
        assert part.groupby("container_id")["piece_tokens"].sum().max() <= cap
        assert part["piece_tokens"].sum() == sum(want)
        assert (part[part["doc_id"].isin([2, 3])]["piece_tokens"] == 0).all() and len(part[part["doc_id"] == 1]) == 2
        whole = part.groupby(["doc_id", "container_id", "piece_no"], dropna=False).size().sum()
        assert whole == sum(max(1, -(-n // cap)) for n in want)
    assert sorted(got["capacity_tokens"].unique()) == [64, 1000]
    assert pk.pack(docs.limit(0), packs).count() == 0 and pk.pack(docs, packs.limit(0)).count() == 0
    s = {r["pack_id"]: r for r in pk.summary(pk.pack(docs, packs)).collect()}
    assert s[1]["tokens"] == sum(want) and 0 <= s[1]["unused_share"] < 0.1


def test_limits_that_bind(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 90)) for i in range(400)], "doc_id long, text string")
    packs = spark.createDataFrame([(1, 128)], "pack_id int, capacity_tokens int")
    limits = pk.Limits(documents=3, attention=0.25)
    got = pk.pack(docs, packs, limits=limits).toPandas()
    boxes = got.groupby("container_id")["piece_tokens"]
    assert boxes.size().max() == 3 and (boxes.apply(lambda s: (s.astype(float) ** 2).sum()) <= 0.25 * 128**2).all()
    assert got["piece_tokens"].max() == limits.largest(128) == 64
    assert got["piece_tokens"].sum() == sum(len(encoder(tokenizer_path()).encode_ordinary("word " * (i % 90))) for i in range(400))


def test_too_many_sizes_are_an_error(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="pack sizes"):
        pk.pack(docs, spark.range(1, 1002).selectExpr("cast(id as int) AS pack_id", "cast(id as int) AS capacity_tokens"))

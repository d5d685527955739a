import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.llm import mixing as mx


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=6), st.integers(1, 9))
def test_tree_deals_every_block_once(counts, shards):
    counts = np.array(counts)
    deal = mx.splitting_tree(counts, shards, np.random.default_rng(1))
    assert deal.shape == (shards, len(counts)) and (deal.sum(axis=0) == counts).all() and (deal >= 0).all()
    assert deal.sum(axis=1).max() - deal.sum(axis=1).min() <= max(1, shards.bit_length())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=9), st.integers(0, 40))
def test_best_subset(sizes, gap):
    chosen = mx.best_subset(sizes, gap)
    best = max(s for k in range(len(sizes) + 1) for s in map(sum, itertools.combinations(sizes, k)) if s <= gap)
    assert len(set(chosen)) == len(chosen) and sum(sizes[i] for i in chosen) == best


def frames(spark):
    docs = [(i, "word " * (1 + i % 17), ("Big-Source", " big_source", "BIG_SOURCE")[i % 3], 1, 2) for i in range(600)]
    docs += [(1000 + i, "tiny text here", "small", 1, 2) for i in range(20)] + [(2000, "no target", "other", 1, 2), (2001, None, "small", 1, 2), (2002, "", None, 1, 2), (2003, "blank source", " ", 1, 2)]
    targets = [("big_source", 0.6, 1), ("small", 0.3, 4), ("missing", 0.1, 2)]
    return spark.createDataFrame(docs, "doc_id long, text string, source string, uses int, bucket int"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_mix(spark):
    docs, targets = frames(spark)
    m = mx.Mix(docs, targets, shard_tokens=100)
    uses = m.uses().toPandas()
    assert len(uses) == docs.count()
    by = uses[uses["source"].isin(["big_source", "small"])].groupby("source")["uses"].max()
    assert by["big_source"] <= 1 and by["small"] <= 4
    assert (uses[~uses["source"].isin(["big_source", "small"])]["uses"] == 0).all()
    shares = {r["source"]: r for r in m.shares().collect()}
    assert shares["missing"]["actual_share"] == 0 and shares["missing"]["tokens"] == 0
    for s in ("big_source", "small"):
        assert shares[s]["actual_share"] == pytest.approx(shares[s]["reachable_share"], abs=0.01)
    placed = m.shards().toPandas()
    assert (uses["shards"].map(len) == uses["uses"]).all()
    assert len(placed) == uses["uses"].sum() and not placed.duplicated(["doc_id", "use_no"]).any() and placed["shard"].nunique() > 1
    assert (placed.groupby("shard")["position"].max() == placed.groupby("shard").size()).all()
    again = mx.Mix(docs.repartition(5), targets, shard_tokens=100)
    assert uses.sort_values("id")["uses"].tolist() == again.uses().toPandas().sort_values("id")["uses"].tolist()


def test_narrowing_a_hot_range(spark, monkeypatch):
    docs, targets = frames(spark)
    want = mx.Mix(docs, targets).shares().orderBy("source").collect()
    monkeypatch.setattr(mx, "EDGE_ROWS", 1)
    monkeypatch.setattr(mx, "STEP_BITS", 3)
    m = mx.Mix(docs, targets)
    assert all(q.high - q.low < 1 << 51 for q in m.quotas if q.wanted > 0)
    got = m.shares().orderBy("source").collect()
    assert [r["actual_share"] for r in got] == pytest.approx([r["actual_share"] for r in want], abs=0.01)
    assert all(r["most_uses"] <= r["max_repeats"] for r in got)


def test_shards_are_filled_alike(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', 3 + id % 5)").alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    m = mx.Mix(docs, targets)
    sizes = m.shards().groupBy("shard", "source").agg(F.sum("n_tokens").alias("t")).toPandas().pivot_table(index="shard", columns="source", values="t", fill_value=0)
    assert len(sizes) == mx.LEAST_SHARDS and sizes.sum(axis=1).min() > 0.4 * sizes.sum(axis=1).mean()


def test_edges(spark):
    docs, targets = frames(spark)
    assert mx.Mix(docs.limit(0), targets).uses().count() == 0
    empty = mx.Mix(docs, targets.limit(0))
    assert empty.uses().agg(F.sum("uses")).first()[0] == 0 and empty.shards().count() == 0 and empty.shares().count() == 0
    small = mx.Mix(docs, targets, total=50).shares().agg(F.sum("tokens")).first()[0]
    assert 40 <= small <= 50
    dup = mx.Mix(docs.unionByName(docs), targets)
    assert dup.uses().count() == 2 * docs.count()

"""Dense and lexical top-k retrieval."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import materialize


def dense_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", block: int = 1024, normalized: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k vectors of largest inner product with each query, ties by id.

    Queries are sent out in blocks of fixed size; each task keeps its k best per query, so at most tasks x k rows per query are shuffled.
    Null vectors are left out; with ``normalized`` both sides are scaled to length 1.
    """

    def unit(m: np.ndarray) -> np.ndarray:
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) if normalized else m

    kind, out = dict(vectors.dtypes)[id_col], None
    for ids, matrix in _blocks(queries.select(id_col, vec_col).where(F.col(vec_col).isNotNull()), block):
        sent = vectors.sparkSession.sparkContext.broadcast((ids, unit(matrix)))

        def best(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            q, m = sent.value
            top_s, top_i = np.full((len(q), 0), 0.0), np.full((len(q), 0), 0)
            for b in batches:
                for a in range(0, len(b), 2048):
                    part = b.iloc[a : a + 2048]
                    s = m @ unit(np.stack(part[vec_col].to_numpy()).astype(np.float64)).T
                    top_s, top_i = best_of(top_s, top_i, s, part[id_col].to_numpy(), k)
            if top_s.shape[1]:
                yield pd.DataFrame({"query_id": np.repeat(q, top_s.shape[1]), id_col: top_i.ravel(), "score": top_s.ravel()})

        part = vectors.select(id_col, vec_col).where(F.col(vec_col).isNotNull()).mapInPandas(best, f"query_id {kind}, {id_col} {kind}, score double")
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
        part = part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else vectors.sparkSession.createDataFrame([], f"query_id {kind}, {id_col} {kind}, score double, rank int")


def best_of(top_s: np.ndarray, top_i: np.ndarray, s: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row's best so far and new scores, ties to the smaller id; only what reaches the k-th score is sorted."""
    have = top_s.shape[1]
    both = np.concatenate([top_s, s], axis=1)
    width = min(k, both.shape[1])
    least = -np.partition(-both, width - 1, axis=1)[:, width - 1]
    row, col = np.nonzero(both >= least[:, None])
    score = both[row, col]
    name = np.where(col < have, top_i[row, np.minimum(col, max(have - 1, 0))] if have else ids[np.maximum(col - have, 0)], ids[np.maximum(col - have, 0)])
    order = np.lexsort((name, -score, row))
    row, score, name = row[order], score[order], name[order]
    at = np.arange(len(row)) - np.searchsorted(row, row)
    keep = at < width
    return score[keep].reshape(len(both), width), name[keep].reshape(len(both), width)


def pool(tokens: DataFrame, by: str, order: str, vec: str, kind: str, mask: str | None = None, pooler: DataFrame | None = None) -> DataFrame:
    """``by, pooled``: one vector for each sequence of token vectors.

    ``mean`` is the mean over the tokens with mask 1 (a sequence without any has zeros), ``cls`` the first token's vector, ``pooler`` the model's own (``by, vec``).
    """
    if kind == "pooler":
        if pooler is None:
            raise ValueError("the model has no pooled output")
        return pooler.select(by, F.col(vec).alias("pooled"))
    if kind == "cls":
        return tokens.groupBy(by).agg(F.min_by(vec, order).alias("pooled"))
    if kind != "mean":
        raise ValueError(f"unknown pooling {kind!r}")
    m = F.col(mask).cast("double") if mask else F.lit(1.0)
    x = tokens.select(by, m.alias("_m"), F.posexplode(vec).alias("_i", "_v")).groupBy(by, "_i").agg((F.sum(F.col("_v") * F.col("_m")) / F.greatest(F.sum("_m"), F.lit(1e-9))).alias("_v"))
    return x.groupBy(by).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_v"))), lambda e: e["_v"]).alias("pooled"))


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, rows = [], []
    for r in queries.toLocalIterator():
        ids.append(r[0]), rows.append(r[1])
        if len(ids) == size:
            yield np.array(ids), np.array(rows, dtype=np.float64)
            ids, rows = [], []
    if ids:
        yield np.array(ids), np.array(rows, dtype=np.float64)


_TERM = re.compile(r"[a-z0-9]+")


def bm25_top_k(docs: DataFrame, queries: DataFrame, k: int, k1: float = 0.9, b: float = 0.4, block: int = 1024) -> DataFrame:
    """``query_id, doc_id, score``: the k best documents of each query (``doc_id, text`` and ``query_id, text``).

    Queries are a stated set, sent out in blocks of fixed size. One pass writes every document's length and counts of the query terms; a second scores whole
    batches of documents against all queries of the block and keeps the k best of each task, so no posting of a common term is ever shuffled. Ties go to the smaller id; null texts have no terms.
    """
    spark, out = docs.sparkSession, None
    kinds = dict(docs.dtypes)["doc_id"], dict(queries.dtypes)["query_id"]
    schema = f"query_id {kinds[1]}, doc_id {kinds[0]}, score double"
    for names, texts in _text_blocks(queries, block):
        sets = [sorted(set(_TERM.findall(t.lower()))) if t else [] for t in texts]
        vocabulary = {w: i for i, w in enumerate(sorted({w for s in sets for w in s}))}
        sent = spark.sparkContext.broadcast(vocabulary)

        def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            get = sent.value.get
            for batch in batches:
                length, term, times = [], [], []
                for t in batch.column(1).to_pylist():
                    words = _TERM.findall(t.lower()) if t else []
                    c = Counter(i for w in words if (i := get(w)) is not None)
                    length.append(len(words)), term.append(list(c)), times.append(list(c.values()))
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "len": pa.array(length, pa.int32()), "term": pa.array(term, pa.list_(pa.int32())), "tf": pa.array(times, pa.list_(pa.int32()))})

        post = materialize(docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kinds[0]}, len int, term array<int>, tf array<int>"))
        n, mean = post.agg(F.count(F.lit(1)), F.avg("len")).first()
        df = dict(map(tuple, post.select(F.explode("term").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect()))  # one row for each term of the block
        idf = np.array([np.log(1 + (n - df.get(i, 0) + 0.5) / (df.get(i, 0) + 0.5)) for i in range(len(vocabulary))])
        hits = np.zeros((len(vocabulary), len(names)), dtype=bool)
        for j, s in enumerate(sets):
            hits[[vocabulary[w] for w in s], j] = True
        parts = spark.sparkContext.broadcast((names, hits, idf, mean))

        def best(batches: Iterator[pa.RecordBatch], parts=parts) -> Iterator[pa.RecordBatch]:
            who, hit, weight, avg = parts.value
            top_s, top_i = np.full((len(who), 0), 0.0), np.full((len(who), 0), 0)
            known = hit.astype(np.float64)
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    row = pa.compute.list_parent_indices(batch.column("term")).to_numpy()
                    if not len(row):
                        continue
                    tf, long = batch.column("tf").flatten().to_numpy().astype(np.float64), batch.column("len").to_numpy()
                    term = batch.column("term").flatten().to_numpy()
                    dense = np.zeros((batch.num_rows, len(weight)))
                    dense[row, term] = weight[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * long[row] / avg))
                    s = np.round(known.T @ dense.T, 6)
                    s[s <= 0] = -np.inf  # documents without any of the terms are no results
                    top_s, top_i = best_of(top_s, top_i, s, batch.column("doc_id").to_numpy(), k)
            found = np.isfinite(top_s)
            q, c = np.nonzero(found)
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.array(who)[q]), "doc_id": pa.array(top_i[q, c]), "score": pa.array(top_s[q, c])})

        part = post.where(F.size("term") > 0).mapInArrow(best, schema)
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")  # at most k rows of each task
        part = part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _text_blocks(queries: DataFrame, size: int) -> Iterator[tuple[list, list[str | None]]]:
    ids, rows = [], []
    for r in queries.select("query_id", "text").toLocalIterator():
        ids.append(r[0]), rows.append(r[1])
        if len(ids) == size:
            yield ids, rows
            ids, rows = [], []
    if ids:
        yield ids, rows

"""Queries of the training-data operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import digest as dg
from . import leaks, mixing, packing, pairs
from . import repetition as rep
from . import residue
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.mostly_repeated(table(spark, sf_dir, "samples"), "sample_index", "response", measure_all=True)


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "samples").select("sample_index", "response")
    out = rep.repetition(samples, "sample_index", "response", measure_all=True)
    return out.select("sample_index", "n_words", F.round("repeated_share", 6).alias("repeated_share")).distinct()


_P1_SHARES = r"""
WITH s AS (SELECT DISTINCT sample_index, response FROM samples),
w AS (SELECT sample_index, regexp_extract_all(lower(coalesce(response, '')), '\p{Han}|\p{L}+') AS l0 FROM s),
-- a letter run may mix Han and other letters: split those runs again
w2 AS (SELECT sample_index, flatten(list_transform(l0, lambda x: CASE WHEN regexp_matches(x, '\p{Han}') THEN regexp_extract_all(x, '\p{Han}|[^\p{Han}]+') ELSE [x] END)) AS l FROM w),
g AS (SELECT sample_index, l, generate_subscripts(l, 1) AS i FROM w2 WHERE len(l) >= 5),
k AS (SELECT sample_index, i, array_to_string(l[i:i + 4], ' ') AS gram FROM g WHERE i + 4 <= len(l)),
r AS (SELECT sample_index, i, row_number() OVER (PARTITION BY sample_index, gram ORDER BY i) AS nth FROM k),
c AS (SELECT DISTINCT sample_index, i + d AS pos FROM r, (SELECT unnest([0, 1, 2, 3, 4]) AS d) WHERE nth > 1),
n AS (SELECT sample_index, count(*) AS rep FROM c GROUP BY 1)
SELECT w2.sample_index, CAST(len(l) AS BIGINT) AS n_words, round(coalesce(rep, 0) / greatest(len(l), 1), 6) AS repeated_share
FROM w2 LEFT JOIN n ON w2.sample_index = n.sample_index
"""


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = table(spark, sf_dir, "prompts")
    return leaks.leaked_items(leaks.corpus_texts(table(spark, sf_dir, "documents"), prompts), table(spark, sf_dir, "eval_items"), prompts)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.broken_pairs(table(spark, sf_dir, "samples"))


def p4_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.latency_percentiles(table(spark, sf_dir, "replay_results"))


def p4_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group, its counts, and whether its estimates keep the stated bound."""
    out = p4_percentiles(spark, sf_dir)
    ok = [(F.coalesce(F.col(f"err{q}"), F.lit(0.0)) <= F.col("bound")).alias(f"ok{q}") for q in (50, 95, 99)]
    return out.select("grouping", "run_id", F.col("replay_day").cast("string").alias("replay_day"), "model", "status_code", "n", "n_null", *ok)


def p4_small_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentiles of the groups with up to 200 values: digests hold those one by one, so they are the interpolated percentiles themselves."""
    out = p4_percentiles(spark, sf_dir).where("n between 1 and 200")
    return out.select("grouping", "run_id", F.col("replay_day").cast("string").alias("replay_day"), "model", "status_code", "n", *[F.round(F.col(f"p{q}") + 0.000001, 4).alias(f"p{q}") for q in (50, 95, 99)])


def p4_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.report_percentiles(table(spark, sf_dir, "replay_stats"))


def p4_reports_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run and day: the reports' counts, and whether their merged digests keep the bound."""
    out = p4_reports(spark, sf_dir)
    ok = [(F.coalesce(F.col(f"err{q}"), F.lit(0.0)) <= F.col("bound")).alias(f"ok{q}") for q in (50, 95, 99)]
    return out.select("grouping", "run_id", F.col("replay_day").cast("string").alias("replay_day"), "n", "results", *ok)


def p5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_sizes"))


def p5_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.summary(p5_pack(spark, sf_dir))


def p5_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per pack size: distinct documents packed, containers above the capacity, documents split though they fit."""
    packed = p5_pack(spark, sf_dir)
    keys = ["pack_id", "capacity_tokens"]
    over = packed.groupBy(*keys, "container_id").agg(F.sum("piece_tokens").alias("t")).groupBy(*keys).agg(F.sum((F.col("t") > F.col("capacity_tokens")).cast("long")).alias("overfull"))
    docs = packed.groupBy(*keys, "doc_id").agg(F.count(F.lit(1)).alias("k"), F.sum("piece_tokens").alias("t"))
    docs = docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("documents"), F.sum(((F.col("k") > 1) & (F.col("t") <= F.col("capacity_tokens"))).cast("long")).alias("wrongly_split"))
    return docs.join(over, keys)


def p5_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing under limits that bind: at most 8 pieces and half of the attention cost; what the containers hold at most, and the unused share."""
    limits = packing.Limits(documents=8, attention=0.5)
    packed = packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_sizes"), limits=limits)
    boxes = packed.groupBy("pack_id", "capacity_tokens", "container_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("piece_tokens").alias("tokens"), F.sum(F.col("piece_tokens").cast("double") * F.col("piece_tokens")).alias("cost"))
    share = F.max(F.col("cost") / (F.col("capacity_tokens").cast("double") * F.col("capacity_tokens")))
    return boxes.groupBy("pack_id", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), F.max("pieces").alias("most_pieces"), F.round(share, 4).alias("most_attention"),
        (1 - F.sum("tokens") / (F.count(F.lit(1)) * F.col("capacity_tokens"))).alias("unused_share"),
    )


def p6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_of(spark, sf_dir).uses().select(F.col("id").alias("doc_id"), "source", "n_tokens", "uses", "shards")


def p6_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_of(spark, sf_dir).shares()


def p6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_of(spark, sf_dir).shards()


def p6_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target: whether it has documents, keeps its cap and comes within 0.005 of its reachable share."""
    out = p6_shares(spark, sf_dir)
    return out.select("source", "target_share", (F.col("tokens") > 0).alias("used"), (F.col("most_uses") <= F.col("max_repeats")).alias("cap_kept"), (F.abs(F.col("actual_share") - F.col("reachable_share")) < 0.005).alias("share_kept"))


_P5_VALID = "SELECT pack_id, capacity_tokens, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0 AS overfull, 0 AS wrongly_split FROM pack_sizes"
_P6_VALID = r"""
WITH d AS (SELECT DISTINCT regexp_replace(lower(trim(source)), '[-\s]+', '_', 'g') AS source FROM documents WHERE length(text) > 0)
SELECT m.source, target_share, d.source IS NOT NULL AS used, true AS cap_kept, true AS share_kept FROM mix_targets m LEFT JOIN d ON m.source = d.source
"""


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(table(spark, sf_dir, "documents")).select("doc_id")


_P4_RESULTS = """SELECT run_id, replay_round, line_number, result_id, max_by(latency_ms, recorded_at) AS latency_ms, max_by(CAST(CAST(sent_at AS DATE) AS VARCHAR), recorded_at) AS replay_day,
 max_by(coalesce(model, '<null>'), recorded_at) AS m, max_by(coalesce(status_code, -1), recorded_at) AS s FROM replay_results GROUP BY 1, 2, 3, 4"""
_P4_CERTIFIED = f"""
WITH r AS (SELECT run_id, replay_day, nullif(m, '<null>') AS model, nullif(s, -1) AS status_code, latency_ms FROM ({_P4_RESULTS})),
g AS (
  SELECT 'run' AS "grouping", run_id, CAST(NULL AS VARCHAR) AS replay_day, CAST(NULL AS VARCHAR) AS model, CAST(NULL AS INT) AS status_code, count(latency_ms) AS n, count(*) AS n_all FROM r GROUP BY run_id
  UNION ALL SELECT 'run_day', run_id, replay_day, NULL, NULL, count(latency_ms), count(*) FROM r GROUP BY run_id, replay_day
  UNION ALL SELECT 'model_status', NULL, NULL, model, status_code, count(latency_ms), count(*) FROM r GROUP BY model, status_code)
SELECT "grouping", run_id, replay_day, model, status_code, n, n_all - n AS n_null, true AS ok50, true AS ok95, true AS ok99 FROM g
"""
_P4_SMALL = f"""
WITH r AS (SELECT run_id, replay_day, nullif(m, '<null>') AS model, nullif(s, -1) AS status_code, latency_ms FROM ({_P4_RESULTS})),
g AS (
  SELECT 'run' AS "grouping", run_id, CAST(NULL AS VARCHAR) AS replay_day, CAST(NULL AS VARCHAR) AS model, CAST(NULL AS INT) AS status_code, latency_ms FROM r
  UNION ALL SELECT 'run_day', run_id, replay_day, NULL, NULL, latency_ms FROM r
  UNION ALL SELECT 'model_status', NULL, NULL, model, status_code, latency_ms FROM r)
SELECT "grouping", run_id, replay_day, model, status_code, count(latency_ms) AS n,
 round(quantile_cont(latency_ms, 0.5) + 0.000001, 4) AS p50, round(quantile_cont(latency_ms, 0.95) + 0.000001, 4) AS p95, round(quantile_cont(latency_ms, 0.99) + 0.000001, 4) AS p99
FROM g GROUP BY 1, 2, 3, 4, 5 HAVING count(latency_ms) BETWEEN 1 AND 200
"""
_P4_AGREE = f"""
WITH r AS (SELECT run_id, replay_day, latency_ms FROM ({_P4_RESULTS}))
SELECT 'run' AS "grouping", run_id, CAST(NULL AS VARCHAR) AS replay_day, count(latency_ms) AS n, count(*) AS results, true AS ok50, true AS ok95, true AS ok99 FROM r GROUP BY run_id
UNION ALL SELECT 'run_day', run_id, replay_day, count(latency_ms), count(*), true, true, true FROM r GROUP BY run_id, replay_day
"""


def queries() -> dict[str, Query]:
    return {"p1_found": p1_found, "p1_shares": p1_shares, "p2_found": p2_found, "p3_found": p3_found, "p4_percentiles": p4_percentiles, "p4_certified": p4_certified, "p4_small_groups": p4_small_groups, "p4_reports": p4_reports, "p4_reports_agree": p4_reports_agree, "p5_pack": p5_pack, "p5_summary": p5_summary, "p5_valid": p5_valid, "p5_limited": p5_limited, "p6_mix": p6_mix, "p6_shares": p6_shares, "p6_shards": p6_shards, "p6_valid": p6_valid, "p7_found": p7_found}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": f"SELECT sample_index FROM ({_P1_SHARES}) WHERE repeated_share >= 0.5", "p1_shares": _P1_SHARES, "p4_certified": _P4_CERTIFIED, "p4_small_groups": _P4_SMALL, "p4_reports_agree": _P4_AGREE, "p5_valid": _P5_VALID, "p6_valid": _P6_VALID}

"""Properties of packings, mixes and percentiles, recomputed in SQL from the emitted rows."""

import os

import duckdb
import pytest

from quillspark.llm import queries as q

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def test_packing(spark, duck):
    duck.register("packed", q.p5_pack(spark, SF).toPandas())
    over = "SELECT count(*) FROM (SELECT capacity_tokens AS c, sum(piece_tokens) AS t, count(*) AS k, sum(piece_tokens::DOUBLE * piece_tokens) AS a FROM packed GROUP BY pack_id, capacity_tokens, container_id) WHERE t > c OR k > 512 OR a > c::DOUBLE * c"
    assert duck.execute(over).fetchone()[0] == 0
    # every document whole under every capacity, with pieces numbered from 0, split only where it is larger
    docs = "SELECT count(*), count(*) FILTER (k > 1 AND t <= c), count(*) FILTER (last <> k - 1), count(DISTINCT doc_id) FROM (SELECT doc_id, capacity_tokens AS c, count(*) AS k, sum(piece_tokens) AS t, max(piece_no) AS last FROM packed GROUP BY doc_id, pack_id, capacity_tokens)"
    n, split, odd, ids = duck.execute(docs).fetchone()
    want = duck.execute("SELECT (SELECT count(*) FROM documents), (SELECT count(*) FROM pack_sizes)").fetchone()
    assert (n, split, odd, ids) == (want[0] * want[1], 0, 0, want[0])
    assert duck.execute("SELECT count(DISTINCT t) FROM (SELECT sum(piece_tokens) AS t FROM packed GROUP BY pack_id)").fetchone()[0] == 1
    waste = "SELECT max(1 - t / (k * c)) FROM (SELECT capacity_tokens AS c, count(DISTINCT container_id) AS k, sum(piece_tokens) AS t FROM packed GROUP BY pack_id, capacity_tokens) WHERE c <= 1024"
    assert duck.execute(waste).fetchone()[0] < 0.02


def test_mix(spark, duck):
    duck.register("mixed", q.p6_mix(spark, SF).toPandas())
    assert duck.execute("SELECT (SELECT count(*) FROM mixed) = (SELECT count(*) FROM documents)").fetchone()[0]
    clean = r"regexp_replace(lower(trim(source)), '[-\s]+', '_', 'g')"
    wrong = f"SELECT count(*) FROM mixed m JOIN (SELECT doc_id, nullif({clean}, '') AS s FROM documents) d ON m.doc_id = d.doc_id WHERE m.source IS DISTINCT FROM d.s"
    assert duck.execute(wrong).fetchone()[0] == 0
    assert duck.execute("SELECT count(*) FROM mixed WHERE len(shards) <> uses").fetchone()[0] == 0
    caps = "SELECT count(*) FROM mixed m LEFT JOIN mix_targets t USING (source) WHERE m.uses > coalesce(t.max_repeats, 0)"
    assert duck.execute(caps).fetchone()[0] == 0
    shares = """WITH u AS (SELECT source, sum(uses * n_tokens) AS t FROM mixed GROUP BY 1), r AS (SELECT source, target_share FROM mix_targets WHERE source IN (SELECT source FROM mixed WHERE n_tokens > 0))
     SELECT max(abs(t / (SELECT sum(t) FROM u) - target_share / (SELECT sum(target_share) FROM r))) FROM r JOIN u USING (source)"""
    assert duck.execute(shares).fetchone()[0] < 0.005
    # as large as the caps allow: some source has all of its repeats
    full = "SELECT count(*) FROM (SELECT source, sum(uses * n_tokens) AS t, sum(n_tokens) AS n FROM mixed GROUP BY 1) JOIN mix_targets USING (source) WHERE t >= 0.99 * max_repeats * n AND n > 0"
    assert duck.execute(full).fetchone()[0] >= 1


def test_percentiles(spark, duck):
    duck.register("est", q.p4_percentiles(spark, SF).where("grouping = 'run'").toPandas())
    # ranks of the estimates among the distinct results
    ranks = """WITH r AS (SELECT run_id, max_by(latency_ms, recorded_at) AS v FROM replay_results GROUP BY run_id, replay_round, line_number, result_id)
     SELECT max(greatest(0, below - 1 - q * (n - 1), q * (n - 1) - upto) / n) FROM (SELECT e.run_id, x.q, any_value(e.n) AS n, count(*) FILTER (r.v < x.p) AS below, count(*) FILTER (r.v <= x.p) AS upto FROM (SELECT run_id, n, p50, p95, p99 FROM est) e, LATERAL (VALUES (0.5, e.p50), (0.95, e.p95), (0.99, e.p99)) x(q, p) JOIN r ON r.run_id = e.run_id WHERE r.v IS NOT NULL GROUP BY e.run_id, x.q)"""
    assert duck.execute(ranks).fetchone()[0] <= 0.005

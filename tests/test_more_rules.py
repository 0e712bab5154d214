"""More rule fixtures: fallback pairs, outlets check, registration records,
stored reasons, lookup budget, run-log views, components brute force."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from sigmesh.config import CURRENT
from sigmesh.operators.evaluate import silent_failure
from sigmesh.operators.graph import cached_reasons, recently_detected
from sigmesh.operators.registration import flatten_registration, plan_lookups
from sigmesh.operators.similarity import block_products, pairs_or_top, prepare_vectors
from sigmesh.plans import mapping as M
from sigmesh.sources.tables import Tables


def test_top_pairs_fallback_matches_brute_force(spark):
    prep = prepare_vectors(M.vectors(Tables(spark, SF001)), CURRENT)
    cfg = CURRENT.with_(sim_threshold=0.99, sim_edge_threshold=0.99)
    got = pairs_or_top(block_products(prep, cfg, 3, plain=True, top_k=10), 10).collect()
    rows = prep.select("domain", "u").collect()
    U = np.array([r.u for r in rows]); names = [r.domain for r in rows]
    S = U @ U.T
    cand = sorted(((-S[i, j], min(names[i], names[j]), max(names[i], names[j]))
                   for i in range(len(names)) for j in range(i + 1, len(names))))[:10]
    assert len(got) == 10
    assert [round(-c[0], 9) for c in cand] == [round(r.raw, 9) for r in sorted(got, key=lambda r: -r.raw)]


def test_silent_failure(spark):
    p = spark.createDataFrame([("reuters.com", 0.9), ("reuters.com", 0.1), ("fake-news.xyz", 0.99)],
                              "domain string, prob double")
    assert [r.domain for r in silent_failure(p, 0.5).collect()] == ["reuters.com"]


def test_flatten_registration(spark):
    rec = ('{"registryData": {"createdDate": "2024-03-01T00:00:00Z", "registrarName": "NameCheap, Inc.",'
           ' "nameServers": {"hostNames": ["a", "b", "c", "d"]}}, "registrant": {"country": "IS"}}')
    r = flatten_registration(spark.createDataFrame([(rec,)], "record string")).collect()[0]
    assert (r.created_raw, r.registrar, r.registration_country, r.nameservers) == \
        ("2024-03-01T00:00:00Z", "NameCheap, Inc.", "IS", "a|b|c")


def test_stored_reasons(spark):
    df = spark.createDataFrame([(0.9, 10, 0.7, 3), (0.1, -1, 0.0, 0)],
                               "max_similarity double, domain_age_days int, burst_score double, related_count int")
    got = [r[0] for r in df.select(cached_reasons()).collect()]
    assert got[0].startswith("High content similarity") and got[0].endswith("network graph.")
    assert got[1] == "No strong warning signals were found in stored graph features."


def test_lookup_budget(spark):
    d = spark.createDataFrame([("a-b-c.com",), ("x.xyz",), ("plain.org",), ("daily-truth.net",)], "domain string")
    cache = spark.createDataFrame([("x.xyz",)], "domain string")
    got = {r.domain: r.action for r in plan_lookups(d, cache, used_today=14, limit=15).collect()}
    assert got == {"a-b-c.com": "lookup", "plain.org": "heuristic", "daily-truth.net": "heuristic"}


def test_recently_detected_clamp(spark):
    n = spark.createDataFrame([(f"d{i}", "SYNTHETIC", 0.9, i) for i in range(80)],
                              "domain string, verdict string, confidence double, updated_at int")
    assert recently_detected(n, 500).count() == 50 and recently_detected(n, 0).count() == 1


def test_components_brute_force(spark):
    from sigmesh.operators.iterative import connected_components
    nodes = spark.createDataFrame([(x,) for x in "abcdefg"], "domain string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("e", "f")], "domain_a string, domain_b string")
    got = {r.domain: r.component for r in connected_components(nodes, edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e", "f": "e", "g": "g"}


def test_components_of_a_long_chain_and_a_hub(spark):
    from sigmesh.operators.components import component_labels
    chain = [(i, i + 1) for i in range(120)]
    hub = [(500, 1000 + i) for i in range(300)]
    edges = spark.createDataFrame(chain + hub + [(7, 7), (3, 2)], "a long, b long")
    got = {r["node"]: r["component"] for r in component_labels(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(121)}, 500: 500, **{1000 + i: 500 for i in range(300)}}
    assert component_labels(edges.limit(0), "a", "b").count() == 0


def test_redirect_links_timestamps(spark):
    from sigmesh.operators.links import clean_links
    from sigmesh.operators.pages import is_redirect
    from sigmesh.functions.timeparts import parse_ts
    df = spark.createDataFrame([("news.example.com", "other.org"), ("a.example.com", "b.example.com"),
                                ("x.com", None)], "domain string, final_domain string")
    assert [r.is_redirect for r in is_redirect(df).orderBy("domain").collect()] == [False, True, False]
    links = spark.createDataFrame([(" a.com | bad | b.org |x.io|c.net ",)], "links string")
    assert links.select(clean_links("links", 2)).collect()[0][0] == ["a.com", "b.org"]
    ts = spark.createDataFrame([("2024-12-01T17:20:07Z",), ("garbage-value-longer-than-19",)], "t string")
    assert [r[0] for r in ts.select(parse_ts("t")).collect()] == ["2024-12-01 17:20:07", "garbage-value-longe"]


def test_bylines_three_patterns_in_order_noise_dropped_distinct(spark):
    from sigmesh.operators.pages import bylines_col
    text = ("By John Smith. Author: Jane Doe wrote this. Written by Staff Writer today. "
            "by John Smith again. By Al Li")
    got = spark.createDataFrame([(text,), (None,)], "t string").select(bylines_col("t").alias("b")).collect()
    # pattern 1 hits first (John Smith, Staff Writer, John Smith, Al Li), then
    # pattern 2 (Jane Doe), then pattern 3 (Staff Writer); the desk name is
    # dropped, "Al Li" has exactly the minimum 5 chars, repeats keep their
    # first place
    assert got[0].b == ["John Smith", "Al Li", "Jane Doe"]
    assert got[1].b == []


def test_forest_samples_by_one_rule_at_every_size(spark):
    from sigmesh.operators.models import fit_isolation_forest
    for n, want in ((100, 100), (3000, 256), (30000, 256)):
        df = spark.range(n).select(F.concat(F.lit("d"), "id").alias("domain"), F.rand(1).alias("a"), F.rand(2).alias("b"))
        leaves = fit_isolation_forest(df, ["a", "b"], trees=100, sample=256).query("feat < 0")
        assert set(leaves.groupby("tree_id")["size"].sum()) == {want} and leaves["tree_id"].nunique() == 100

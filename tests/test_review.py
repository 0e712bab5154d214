"""Pair counts with precedence, cluster runs, neighbourhoods, the forest's guard, listings."""

import itertools
import json
import random

from pyspark.sql import functions as F


def test_pairs_of_hosts_count_once(spark):
    from sigmesh.operators.hosting import host_pair_counts
    rng = random.Random(4)
    where = {f"d{i}": (f"ip{rng.randint(0, 6)}" if rng.random() < 0.8 else None, f"as{rng.randint(0, 2)}" if rng.random() < 0.8 else None) for i in range(60)}
    rows = [(d, kind, key) for d, (ip, asn) in where.items() for kind, key in (("SAME_IP", ip), ("SAME_ASN", asn)) if key]
    edges = {}
    for a, b in itertools.combinations(sorted(where), 2):
        if where[a][0] and where[a][0] == where[b][0]:
            edges[(a, b)] = ("SAME_IP", where[a][0])
        elif where[a][1] and where[a][1] == where[b][1]:
            edges[(a, b)] = ("SAME_ASN", where[a][1])
    got = {(r.edge_type, r.group_key): r.pairs for r in host_pair_counts(spark.createDataFrame(rows, "domain string, edge_type string, group_key string")).collect()}
    assert sum(got.values()) == len(edges)
    for g, n in got.items():
        assert n == sum(e == g for e in edges.values())


def test_cluster_runs(spark):
    from sigmesh.operators.evaluate import cluster_runs, evaluation_source, signal_matrix
    v = spark.createDataFrame([("a", "SYNTHETIC", 1, 0), ("b", "ORGANIC", 0, None), ("c", "REVIEW", 1, 1)], "domain string, verdict string, s1 int, s2 int")
    truth = spark.createDataFrame([("a", 1), ("b", 1), ("gone", 1), ("c", 0), ("d", 0)], "domain string, label int")
    rows = {r.cluster: r for r in cluster_runs(v, truth, ["s1", "s2"]).collect()}
    s, o, t = rows["synthetic_cluster"], rows["organic_cluster"], rows["overall"]
    assert (s.n_domains, s.n_flagged, s.flagged_rate, s.s1, s.s2) == (3, 1, 0.3333, 1, 0)
    assert (o.n_domains, o.n_flagged, o.flagged_rate, o.s1, o.s2) == (2, 1, 0.5, 1, 1)
    assert (t.tp, t.fn, t.fp, t.tn, t.precision, t.recall, t.f1) == (1, 2, 1, 1, 0.5, 0.3333, 0.4)
    assert cluster_runs(v, truth.limit(0), ["s1"]).count() == 1
    assert sorted(map(tuple, signal_matrix(v, ["s1", "s2"]).collect()))[2:4] == [("b", "s1", 0), ("b", "s2", 0)]
    names = ["signal_1_similarity", "signal_2_cadence", "signal_3_whois", "signal_4_hosting", "signal_5_link_network", "signal_6_wayback", "signal_7_authors"]

    def log(rows):
        return spark.createDataFrame([(*r, p) for r, p in rows], ", ".join(f"{n} int" for n in names) + ", predicted_label int")
    three = [((1, 0, 0, 0, 0, 0, 0), 0), ((0, 1, 0, 0, 0, 0, 0), 0), ((0, 0, 1, 0, 0, 0, 0), 1)]
    assert evaluation_source(log(three)).first()["source"] == "log"  # three signals fire, though never two at once
    assert evaluation_source(log(three[:2] + [((0, 1, 0, 0, 0, 0, 0), 1)])).first()["source"] == "features"
    assert evaluation_source(log([(r, 0) for r, _ in three])).first()["source"] == "features"


def test_neighbourhood_is_an_optional_match(spark):
    from sigmesh.operators.graph import neighborhood
    nodes = spark.createDataFrame([("a", "REVIEW", 1, "xa"), ("b", None, None, "xb"), ("c", "SYNTHETIC", 4, "xc"), ("alone", "ORGANIC", 0, "")],
                                  "domain string, verdict string, signals int, excerpt string")
    edges = spark.createDataFrame([("a", "b", "SIMILAR_TO", 0.91234), ("a", "c", "SIMILAR_TO", None), ("alone", "c", "LINKS_TO", None), ("a", "gone", "SIMILAR_TO", 0.99)],
                                  "domain_a string, domain_b string, kind string, similarity double")
    focus = spark.createDataFrame([("a",), ("alone",), ("unknown",)], "domain string")
    got = {(r.domain, r.neighbor): r for r in neighborhood(edges, nodes, focus).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("alone", None)}
    assert (got["a", "b"].similarity, got["a", "b"].neighbor_verdict, got["a", "b"].neighbor_signals) == (0.9123, "ORGANIC", 0)
    assert (got["a", "c"].similarity, got["a", "c"].neighbor_excerpt) == (0.0, "xc") and got["alone", None].rank is None
    assert len([1 for r in neighborhood(edges, nodes, focus, limit=1).collect() if r.domain == "a"]) <= 1


def test_forest_needs_rows(spark):
    from sigmesh.operators.models import forest_signal
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "domain string, x double")
    assert [(r.anomaly_score, r.cadence_flagged) for r in forest_signal(df, ["x"]).collect()] == [(0.0, 0), (0.0, 0)]
    many = spark.createDataFrame([(f"d{i}", float(i % 5)) for i in range(40)] + [("odd", 400.0)], "domain string, x double")
    rows = forest_signal(many, ["x"], trees=30, contamination=0.05).collect()
    assert min(rows, key=lambda r: r.anomaly_score).domain == "odd"


def test_listings(spark):
    from sigmesh.streaming.monitor import listing_posts, social_feed_domains
    doc = {"data": {"children": [{"data": {"url": "https://www.one.example/x", "selftext": "see http://Two.example/a) and https://reddit.com/b"}},
                                 {"data": {"url": "https://one.example", "url_overridden_by_dest": "https://three.example/y"}}, {"data": {}}]}}
    raw = spark.createDataFrame([(json.dumps(doc),), ("{broken",), ("{}",), (None,)], "listing string")
    posts = listing_posts(raw)
    assert posts.count() == 3 and posts.filter(F.col("url") == "").count() == 1
    assert {r.domain for r in social_feed_domains(posts, "url", "selftext").collect()} == {"one.example", "two.example", "three.example"}


def test_tables_and_versions(spark, tmp_path):
    from sigmesh.sources.files import publish, read_csv_table, read_latest, write_table
    (tmp_path / "a.csv").write_text('domain,text,n\n"a.example","two\nlines, one ""quote""",3\nb.example,,\n')
    rows = {r.domain: (r.text, r.n) for r in read_csv_table(spark, str(tmp_path / "a.csv"), "domain string, text string, n int").collect()}
    assert rows == {"a.example": ('two\nlines, one "quote"', 3), "b.example": (None, None)}
    df = spark.createDataFrame([(1, "x"), (2, "y")], "n int, k string")
    write_table(df, str(tmp_path / "t"), ["k"])
    write_table(df.filter("n = 2"), str(tmp_path / "t"), ["k"])
    assert [(r.n, r.k) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [(2, "y")]
    for v in ("v9", "v10"):
        publish(df.withColumn("k", F.lit(v)), str(tmp_path / "p"), v)
    assert {r.k for r in read_latest(spark, str(tmp_path / "p")).collect()} == {"v10"}


def test_run_log(spark, tmp_path):
    from sigmesh.operators.monitor import append_run, latest_run, read_runs
    path = str(tmp_path / "runs")
    line = "ran_at string, whoisds_count int, reddit_count int, queued_unique int, batches int, results int, synthetic_batches int"
    for at, syn in (("2024-01-01T06:00:00+00:00", 1), ("2024-01-01T09:00:00+02:00", 0)):
        append_run(spark.createDataFrame([(at, 0, 5, 5, 1, 1, syn)], line), path)
    with open(tmp_path / "runs" / "broken.json", "w") as f:
        f.write("\n{not json\n")
    runs = read_runs(spark, path)
    assert runs.count() == 2 and latest_run(runs).first().ran_at == "2024-01-01T09:00:00+02:00"
    assert latest_run(runs.limit(0)).first().status == "no-data"

"""Pruned similarity, global order, graph network, stores, cycles, archives, searches and the crawl queue."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigmesh.config import Settings
from sigmesh.operators import graphnet as G
from sigmesh.operators.order import with_rank, with_running

CFG = Settings().with_(sim_threshold=0.6, sim_edge_threshold=0.6)


def vectors(spark, rows):
    """rows: (domain, parent, vector, auth, synd)"""
    unit = []
    for d, p, v, a, s in rows:
        n = np.linalg.norm(v)
        unit.append((d, p, [float(x) for x in (np.array(v) / n if n else v)], a, s))
    return spark.createDataFrame(unit, "domain string, parent string, u array<double>, auth boolean, synd boolean")


def brute_similarity(rows, cfg):
    unit = {d: (np.array(v) / (np.linalg.norm(v) or 1.0), p, a, s) for d, p, v, a, s in rows}
    stats, pairs = {}, {}
    for d, (u, p, a, s) in unit.items():
        effs, over = [], 0
        for e, (v, q, b, t) in unit.items():
            if d == e or p == q:
                continue
            raw = float(u @ v)
            w = cfg.authority_pair_weight if a and b else cfg.authority_mixed_weight if a or b else 1.0
            limit = cfg.sim_threshold * (cfg.authority_pair_mult if a and b else cfg.authority_mixed_mult if a or b else 1.0)
            eff = 0.0 if s or t else raw * w
            effs.append(eff)
            if eff >= limit:
                over += 1
                if d < e:
                    pairs[(d, e)] = raw
        stats[d] = (round(float(np.mean(effs)), 4) + 0.0 if effs else 0.0, round(max(effs), 4) + 0.0 if effs else 0.0, over)
    return stats, pairs


@pytest.mark.parametrize("grouped", [True, False])
def test_pruned_similarity_is_exact(spark, grouped):
    from sigmesh.operators.similarity import similarity_pairs
    from sigmesh.operators.simjoin import pairs_compared, pinned, pruned_products, pruned_scores
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(6, 12))
    rows = []
    for i in range(240):
        v = middles[i % 6] + rng.normal(size=12) * 0.15 if grouped else rng.normal(size=12)
        rows.append((f"d{i}", f"s{i % 5}", v, i % 17 == 0, i % 23 == 0))
    rows += [("zero", "z", np.zeros(12), False, False), ("alone", "s0", -middles[0], False, True)]
    prep = pinned(vectors(spark, rows))
    products = pruned_products(prep, CFG, len(rows), pivots=12, block_rows=16)
    stats, pairs = brute_similarity(rows, CFG)
    got = {r.domain: (round(r.avg_similarity, 4) + 0.0, round(r.max_similarity, 4) + 0.0, r.similar_domain_count)
           for r in pruned_scores(prep, prep, products, CFG).collect()}
    assert got.keys() == stats.keys()
    for d in stats:
        assert got[d] == pytest.approx(stats[d], abs=1.01e-4), d
    found = {(r.domain_a, r.domain_b): r.raw for r in similarity_pairs(products).collect()}
    assert found.keys() == pairs.keys() and all(abs(found[k] - pairs[k]) < 1e-9 for k in pairs)
    if grouped:  # far fewer comparisons than all ordered pairs of different sites
        every = sum(1 for a in rows for b in rows if a[0] != b[0] and a[1] != b[1])
        assert pairs_compared(products).first().compared < 0.5 * every


def test_pruned_similarity_of_nothing(spark):
    from sigmesh.operators.simjoin import pinned, pruned_products
    assert pruned_products(pinned(vectors(spark, [("a", "b", [1.0], False, False)]).limit(0)), CFG, 0).count() == 0


def test_rank_and_running_totals(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 50), i, rng.randint(-5, 9)) for i in range(700)]
    df = spark.createDataFrame(rows, "k int, id int, x int").repartition(7)
    want, total = {}, 0
    for place, (k, i, x) in enumerate(sorted(rows)):
        total += x
        want[i] = (place, total)
    got = {r.id: (r.place, r.s) for r in with_running(df, ["k", "id"], {"s": "x"}, "place").collect()}
    assert got == want
    assert with_rank(df.limit(0), ["k"]).count() == 0
    down = {r.id: r["rank"] for r in with_rank(df, [F.desc("k"), F.desc("id")]).collect()}
    assert all(down[i] == len(rows) - 1 - p for i, (p, _) in want.items())
    plan = with_rank(df, ["k", "id"])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


# ---------------------------------------------------------------- graph network

def graph(n=60, seed=1):
    rng = np.random.default_rng(seed)
    nodes = [(f"n{i}", float(rng.normal() + (i % 2)), float(rng.normal()), 3.0, int(rng.integers(0, 4)), i % 2 if i % 3 else -1) for i in range(n)]
    edges = {tuple(sorted((f"n{a}", f"n{b}"))) for a, b in rng.integers(0, n, (150, 2)) if a % 2 == b % 2 and a != b}
    edges |= {("n0", f"n{i}") if "n0" < f"n{i}" else (f"n{i}", "n0") for i in range(1, n)} | {("n1", "gone"), ("n2", "n2")}
    return nodes, sorted(edges)


NODE = "domain string, a double, b double, c double, signals int, label int"


def adjacency(nodes, edges):
    name = {r[0]: i for i, r in enumerate(nodes)}
    m = np.eye(len(nodes))
    for x, y in edges:
        if x in name and y in name and x != y:
            m[name[x], name[y]] = m[name[y], name[x]] = 1.0
    return m / m.sum(1, keepdims=True)


def plain_scores(nodes, edges, net):
    x = np.array([r[1:4] for r in nodes])
    x = (x - np.array(net.mean)) / np.array(net.scale)
    a = adjacency(nodes, edges)
    for w, b in zip(net.weights[:2], net.biases[:2]):
        x = np.maximum(a @ x @ w + b, 0.0)
    z = np.exp(x @ net.weights[2] + net.biases[2])
    return z[:, 1] / z.sum(1)


def test_network_scores(spark, tmp_path):
    from sigmesh.sources.versions import newest, publish_version, read_part
    nodes, edges = graph()
    n, e = spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, "domain_a string, domain_b string")
    net = G.with_scaling(G.fixed_network(["a", "b", "c"], 16), n)
    assert net.scale[2] == 1.0
    want = dict(zip([r[0] for r in nodes], plain_scores(nodes, edges, net)))
    got = {r.domain: r.prob for r in G.scores(n, e, net).collect()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-9 for d in want)
    # the store: nothing before the first manifest; what a failed writer left is not seen; numbers survive exactly
    base = str(tmp_path / "models")
    assert newest(spark, base) is None
    assert publish_version(spark, base, {"network": G.as_table(spark, net)}, {"note": "first"}) == 1
    G.as_table(spark, net).limit(3).write.parquet(f"{base}/v=2/network")
    assert newest(spark, base) == (1, {"parts": ["network"], "note": "first"})
    again = G.from_table(read_part(spark, base, "network"))
    assert all((x == y).all() for x, y in zip(again.weights + again.biases, net.weights + net.biases))
    assert (again.features, again.mean, again.scale) == (net.features, net.mean, net.scale)
    assert publish_version(spark, base, {"network": G.as_table(spark, G.random_network(["a"], 4))}) == 2
    assert newest(spark, base)[0] == 2 and read_part(spark, base, "network", 1).count() == G.as_table(spark, net).count()


def test_network_gradient_and_split_packs(spark):
    """The sums of a round are the derivative of the loss, whether or not nodes are cut into several packs."""
    nodes, edges = graph(24)
    n, e = spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, "domain_a string, domain_b string")
    split = G.stratified(G.labels_of(n)).checkpoint()
    net = G.with_scaling(G.random_network(["a", "b", "c"], 8, seed=5), n)
    rows = {r.domain: r for r in split.collect()}
    order = [r[0] for r in nodes]

    def loss(flat):
        z = plain_scores(nodes, edges, net.with_flat(flat))
        return sum(-np.log(p if rows[d].y == 1 else 1 - p) for d, p in zip(order, z) if d in rows and rows[d].train)
    sent = G.messages(n, e).checkpoint()
    heavy = G._heavy(sent, "src").checkpoint()
    first = G._means(G.inputs(n, net), sent, heavy, 3)
    x = net.flat()
    for pack_rows in (20_000, 4):
        packs = G._packs(first, sent, heavy, split, 3, pack_rows).checkpoint()
        whole = packs.filter(~F.col("alone")).isEmpty()
        assert whole == (pack_rows > 100)
        g, total, _, count = G._round(packs, whole, net)
        assert count == sum(r.train for r in rows.values()) and abs(total - loss(x)) < 1e-9
        for i in range(0, len(x), 7):
            step = np.zeros_like(x)
            step[i] = 1e-6
            assert abs((loss(x + step) - loss(x - step)) / 2e-6 - g[i]) < 1e-5


def test_network_learns_and_split_is_exact(spark):
    nodes, edges = graph(80, seed=2)
    n, e = spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges[:100], "domain_a string, domain_b string")
    labelled = G.labels_of(n)
    want = {r[0]: (r[5] if r[5] in (0, 1) else 1 if r[4] >= 2 else 0 if r[4] == 0 else None) for r in nodes}
    assert {r.domain: r.y for r in labelled.collect()} == {d: y for d, y in want.items() if y is not None}
    split = G.stratified(labelled).checkpoint()
    rows = split.collect()
    tests = [r for r in rows if r.test]
    assert len(tests) == -(-len(rows) // 5) and all(r.test != r.train for r in rows)
    for y in (0, 1):
        share = sum(r.y == y for r in rows) / len(rows)
        assert abs(sum(r.y == y for r in tests) - share * len(tests)) <= 1
    few = G.stratified(labelled.limit(4)).collect()
    assert len(few) == 4 and all(r.test and r.train for r in few)
    net = G.train(n, e, split, ["a", "b", "c"], rounds=15, rate=0.05, hidden=16)
    assert net.metrics["last_loss"] < net.metrics["first_loss"]
    m = G.held_out(split, G.scores(n, e, net)).first()
    assert m.n_test == len(tests) and m.tp + m.fn + m.fp + m.tn == len(tests)


# ---------------------------------------------------------------- stores, streams, archives

def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_graph_store_rewrites_only_what_it_must(spark, tmp_path):
    from sigmesh.operators.graphstore import GraphStore
    store = GraphStore(spark, str(tmp_path / "g"), buckets=16, flag_at=0.5)
    at = lambda rows, t: rows.withColumn("updated_at", F.to_timestamp(F.lit(t)))
    nodes = spark.createDataFrame([(f"d{i}", f"r{i}") for i in range(200)], "domain string, registrar string")
    with pytest.raises(FileNotFoundError):
        store.table("nodes")
    store.rebuild(at(nodes, "2024-01-01 00:00:00"))
    base = f"{store.base}/v=1/nodes"
    before = files(base)
    rows = spark.createDataFrame([("d3", "x" * 200), ("d4", "new"), ("fresh", "n")], "domain string, registrar string")
    touched = store.upsert_nodes(rows, "2024-02-01 00:00:00")
    after = files(base)
    kept = {f for f in before if after.get(f) == before[f]}
    assert 1 <= len(touched) <= 3 and len(kept) == len({f for f in before if not any(f"bucket={b}{os.sep}" in f for b in touched)})
    got = {r.domain: r.registrar for r in store.table("nodes").collect()}
    assert len(got) == 201 and got["d3"] == "x" * 80 and got["d4"] == "new" and got["d5"] == "r5"
    old = store.upsert_nodes(rows.withColumn("registrar", F.lit("older")), "2023-01-01 00:00:00")  # an older stamp changes nothing
    assert {r.domain: r.registrar for r in store.table("nodes").collect()} == got and old == touched

    edges = spark.createDataFrame([("d2", "d1", "SIMILAR_TO", 0.7), ("d1", "d9", "LINKS_TO", None), ("d1", "missing", "SIMILAR_TO", 0.9)],
                                  "domain_a string, domain_b string, kind string, similarity double")
    for _ in range(2):
        store.upsert_edges(edges, "2024-03-01 00:00:00")
        assert {(r.domain_a, r.domain_b, r.kind, r.similarity, r.flagged) for r in store.table("edges").collect()} == {
            ("d1", "d2", "SIMILAR_TO", 0.7, 1), ("d1", "d9", "LINKS_TO", None, 0)}
    store.upsert_memberships(spark.createDataFrame([("d1", "SAME_HOST", "ip:1"), ("nobody", "SAME_HOST", "ip:1")],
                                                   "domain string, kind string, member_of string"), "2024-03-01 00:00:00")
    assert [tuple(r)[:3] for r in store.table("memberships").collect()] == [("d1", "SAME_HOST", "ip:1")]
    assert store.rebuild(at(nodes.limit(5), "2024-04-01 00:00:00")) == 2
    assert store.table("nodes").count() == 5 and store.table("edges").count() == 0
    assert spark.read.parquet(f"{store.base}/v=1/nodes").count() == 201


def test_cycles_replay(spark, tmp_path):
    from sigmesh.streaming.cycles import CycleStore
    store = CycleStore(spark, str(tmp_path / "cycles"))
    assert store.summaries().count() == 0 and store.results().count() == 0
    rows = [("registration" if i % 4 == 0 else "social", f"d{i:03d}", "2024-01-01 06:00:00") for i in range(57)] + [("social", None, "2024-01-01 06:00:00")]
    batch = spark.createDataFrame(rows, "source string, domain string, at string").select("source", "domain", F.to_timestamp("at").alias("ran_at"))
    seen = []

    def analyse(names):
        seen.append(sorted(r.domain for r in names.collect()))
        return names.select("domain", F.when(F.col("domain") == "d013", "SYNTHETIC").otherwise("ORGANIC").alias("verdict"))
    store.cycle(batch, 4, analyse)
    assert [len(s) for s in seen] == [10, 10, 10, 10] and seen[0][0] == "d000"
    first = (store.summaries().collect(), sorted(map(tuple, store.results().collect())))
    (line,) = first[0]
    assert [line[c] for c in ("batch_id", "whoisds_count", "reddit_count", "queued_unique", "batches", "results", "synthetic_batches")] \
        == [4, 15, 42, 40, 4, 4, 1] and len(first[1]) == 40
    store.cycle(batch, 4, analyse)  # the batch again, as after a failure
    assert (store.summaries().collect(), sorted(map(tuple, store.results().collect()))) == first
    # a cycle that broke before its summary is not seen

    def broken(names):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        store.cycle(batch, 5, broken)
    spark.createDataFrame([(0, "d1", "ORGANIC")], "chunk int, domain string, verdict string").write.parquet(f"{store.path}/results/batch_id=5")
    assert store.summaries().count() == 1 and store.results().count() == 40
    store.cycle(batch.limit(0), 6, analyse)
    assert store.summaries().count() == 1


def test_archive_round_trip(spark, tmp_path):
    from sigmesh.sources.archive import read_archive, read_pages_archive, write_archive
    body = "<html>" + "é text\r\n\r\nmore\n" * 12 + "</html>"
    rows = [("http://a.example/1", body, "response", "Text/HTML; charset=utf-8"), ("http://a.example/2", body, "request", "text/html"),
            ("ftp://a.example/3", body, "response", "text/html"), ("http://a.example/4", body, "response", "image/png"),
            ("http://a.example/5", "short", "response", "text/html"), ("http://a.example/6", None, "response", "text/html"),
            ("http://a.example/7", body + "\r\n", "response", "text/html")]
    df = spark.createDataFrame(rows, "url string, html string, record_type string, content_type string")
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        write_archive(df.repartition(2), path, compression=compression)
        assert read_archive(spark, path).count() == len(rows)
        got = {(r.url, r.html) for r in read_pages_archive(spark, path).collect()}
        assert got == {("http://a.example/1", body), ("http://a.example/7", body + "\r\n")}
    assert read_pages_archive(spark, path, limit=1).count() == 1
    # a hand-written record with fields in another case and an info record without HTTP
    text = ("WARC/1.0\r\nwarc-type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
            "WARC/1.0\r\nWARC-Type: response\r\nwarc-target-uri: http://b.example/\r\nContent-Length: 300\r\n\r\n"
            "HTTP/1.1 404 Not Found\r\ncontent-type: text/html\r\n\r\n" + "y" * 120 + "\r\n\r\n")
    (tmp_path / "hand.warc").write_bytes(text.encode())
    rows = {r.record_type: r for r in read_archive(spark, str(tmp_path / "hand.warc")).collect()}
    assert rows["warcinfo"].body == "abcd" and rows["response"].http_status == 404 and rows["response"].body == "y" * 120


def test_search_against_brute_force(spark):
    from sigmesh.operators.search import search
    rng = np.random.default_rng(11)
    x = rng.normal(size=(150, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] = x[3]
    df = spark.createDataFrame([(f"d{i}", x[i].tolist()) for i in range(150)], "domain string, u array<double>").repartition(4).cache()
    seeds = df.filter(F.substring("domain", 2, 9).cast("int") % 10 == 3)
    stats, best = search(seeds, df, CFG, 15, 150, k=4, block_rows=32)
    want = {}
    for i in range(3, 150, 10):
        others = sorted(((-round(float(x[i] @ x[j]), 12), f"d{j}") for j in range(150) if j != i))
        want[f"d{i}"] = [d for _, d in others[:4]]
    got = {}
    for r in sorted(best.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.seed, []).append(r.domain)
    assert got == want
    for r in stats.collect():
        i = int(r.seed[1:])
        raw = np.delete(x @ x[i], i)
        assert abs(r.avg_similarity - raw.mean()) < 1e-4 and abs(r.max_similarity - raw.max()) < 1e-4 and r.similar_domain_count == (raw >= 0.6).sum()


def test_encoder(spark):
    from sigmesh.operators.encoder import encoded
    rows = [(1, "The quick brown fox jumps over the lazy dog " * 5), (2, "The quick brown fox jumped over the lazy dog " * 5),
            (3, "Completely different words stand in this other text " * 5), (4, None), (5, ""), (6, "ab")]
    got = {r.id: np.array(r.embedding) for r in encoded(spark.createDataFrame(rows, "id int, text string").repartition(3)).collect()}
    assert all(len(v) == 64 for v in got.values()) and not got[4].any() and not got[5].any()
    assert abs(np.linalg.norm(got[6]) - 1) < 1e-5 and got[1] @ got[2] > 0.8 > 0.5 > got[1] @ got[3]

    def other():
        return lambda texts: np.array([[float(len(t))] for t in texts], dtype=np.float32)
    assert {r.id: r.embedding for r in encoded(spark.createDataFrame(rows, "id int, text string"), make=other).collect()}[6] == [2.0]


def crawl(seeds, pages, links, per_page, cap):
    """The queue one page after the other."""
    queue, discovered, redirect, out, results = list(seeds), set(seeds), {}, [], 0
    while queue and results < cap:
        d = queue.pop(0)
        ok, final = pages.get(d, (False, None))
        if final and final != d:
            redirect[d] = final
        out.append((d, len(out), "result" if ok else "failed"))
        if not ok:
            continue
        results += 1
        if results < cap:
            for x in links.get(d, [])[:per_page]:
                if x not in discovered and x not in redirect.values():
                    discovered.add(x)
                    queue.append(x)
    return out


@pytest.mark.parametrize("cap", [10 ** 6, 7])
def test_crawl_queue(spark, cap):
    from sigmesh.operators.iterative import crawl_frontier
    rng = random.Random(cap)
    for _ in range(3):
        names = [f"site{i}.example" for i in range(60)]
        pages = {n: (rng.random() < 0.7, rng.choice(names) if rng.random() < 0.25 else None) for n in names if rng.random() < 0.9}
        links = {n: rng.sample(names, rng.randint(0, 9)) for n in names}
        seeds = rng.sample(names, 4)
        # parent of siteN.example is itself: two labels
        got = crawl_frontier(spark.createDataFrame([(d, i) for i, d in enumerate(seeds)], "domain string, place int"),
                             spark.createDataFrame([(d, ok, f) for d, (ok, f) in pages.items()], "domain string, ok boolean, final_domain string"),
                             spark.createDataFrame([(s, i + 1, d) for s, ds in links.items() for i, d in enumerate(ds)], "src string, place int, dst string"),
                             depth=40, cap=cap).collect()
        assert sorted((r.place, r.domain, r.status) for r in got) == [(p, d, s) for d, p, s in crawl(seeds, pages, links, 5, cap)]


def test_bursts_close_with_the_watermark(spark, tmp_path):
    from sigmesh.streaming.monitor import burst_sessions, parquet_stream, run_append
    minutes = {"a": [0, 10, 50, 200, 205], "b": [0, 90], "c": [600]}
    rows = [(d, f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00") for d, ms in minutes.items() for m in ms]
    path = str(tmp_path / "e.parquet")
    spark.createDataFrame(rows, "domain string, at string").select("domain", F.to_timestamp("at").alias("ts")).coalesce(1).write.parquet(path)
    got = sorted((r.domain, str(r.burst_start)[11:16], r.pages) for r in run_append(spark, burst_sessions(parquet_stream(spark, path)), "t").collect())
    assert got == [("a", "00:00", 3), ("a", "03:20", 2), ("b", "00:00", 1), ("b", "01:30", 1)]  # c's is still open
    assert json.dumps(got)

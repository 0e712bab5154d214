"""Tiles of similarity, search and training: bounded memory, nothing written that is not asked for, the same results."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from sigmesh.config import CURRENT
from sigmesh.operators import similarity as S

CFG = CURRENT.with_(sim_threshold=0.3, sim_edge_threshold=0.3)


def prepared(spark, x, parts=4):
    rows = [(f"d{i}", f"s{i % 3}", v.tolist(), i % 19 == 0, i % 29 == 0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "domain string, parent string, u array<double>, auth boolean, synd boolean").repartition(parts)


def unit_rows(n, dim, seed=3):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_tile_memory_does_not_follow_its_pairs():
    """Matrices of a tile are steps, pairs leave in batches: also where every pair is found."""
    n = 1500
    x = np.ones((2 * n, 8)) / np.sqrt(8)
    rows = pa.table({"lo": np.zeros(2 * n, np.int32), "hi": np.ones(2 * n, np.int32), "blk": np.repeat([0, 1], n).astype(np.int32),
                     "domain": [f"d{i}" for i in range(2 * n)], "parent": [f"s{i}" for i in range(2 * n)],
                     "u": pa.array(list(x), pa.list_(pa.float64())), "auth": np.zeros(2 * n, bool), "synd": np.zeros(2 * n, bool)})
    tracemalloc.start()
    found = sum(b.num_rows for b in S.block_task(CFG, 0.3)((pa.scalar(0), pa.scalar(1)), iter(rows.to_batches())))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert found == n * n + 2 * n and peak < 120, peak


@pytest.mark.parametrize("pivots", [1, 6])
def test_scores_ask_for_no_pairs(spark, pivots):
    from sigmesh.operators.simjoin import pinned, pruned_products
    prep = pinned(prepared(spark, unit_rows(150, 6)))
    every = pruned_products(prep, CFG, 150, pivots=pivots, block_rows=40)
    parts = pruned_products(prep, CFG, 150, pivots=pivots, block_rows=40, pairs=False)
    assert parts.filter("kind != 'part'").isEmpty() and not every.filter("kind = 'pair'").isEmpty()
    per = lambda df: sorted((r.domain_a, r.k, round(r.m, 9)) for r in df.filter("kind = 'part'").groupBy("domain_a").agg(
        F.sum("n_over").alias("k"), F.max("max_eff").alias("m")).collect())
    assert per(parts) == per(every)


def test_blocks_grow_with_the_rows():
    assert [S.blocks_for(n) for n in (0, 10, 2048, 2049, 32_768, 100_000, 524_288)] == [1, 1, 1, 2, 16, 16, 16]
    assert S.blocks_for(1_000_000) == 31  # copies of a vector, not 489


def test_pairs_meet_authors_only_where_a_rule_asks(spark):
    texts = [("a", "home about us contact privacy policy newsletter"), ("b", "home about us contact privacy policy newsletter"), ("c", "x"), ("d", None)]
    pairs = [("a", "b", .95, .95), ("a", "c", .95, .95), ("a", "d", .95, .95), ("b", "c", .8, .8), ("a", "b", .82, .82), ("b", "c", .7, .7), ("a", "b", .4, .4)]
    by = [("a", "Ann"), ("a", " ann "), ("b", "ANN"), ("c", "Bob"), ("z", "Ann")]
    vecs = spark.createDataFrame(texts, "domain string, text string")
    got = S.classify_pairs(spark.createDataFrame(pairs, "domain_a string, domain_b string, raw double, eff double"), vecs,
                           spark.createDataFrame(by, "domain string, author string"), CURRENT)
    types = sorted((r.domain_a, r.domain_b, r.score, r.similarity_type) for r in got.collect())
    assert types == [("a", "b", .4, "topic_overlap"), ("a", "b", .82, "structural_clone"), ("a", "b", .95, "structural_clone"),
                     ("a", "c", .95, "shared_journalistic"), ("a", "d", .95, "shared_journalistic"),
                     ("b", "c", .7, "shared_journalistic"), ("b", "c", .8, "shared_journalistic")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "an#" not in plan and plan.count("Join") == 3, plan


def test_lsh_pairs_are_those_of_the_join(spark):
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    prep = prepared(spark, unit_rows(160, 5)).unionByName(prepared(spark, np.zeros((2, 5))).withColumn("domain", F.concat(F.lit("z"), "domain")))
    v = prep.select("domain", "parent", "u", array_to_vector("u").alias("vec"))
    model = BucketedRandomProjectionLSH(inputCol="vec", outputCol="h", bucketLength=0.4, numHashTables=3, seed=42).fit(v)
    joined = model.approxSimilarityJoin(v, v, np.sqrt(2 - 2 * 0.6) + 1e-9, distCol="d")
    want = {(r.a, r.b) for r in joined.filter("datasetA.domain < datasetB.domain AND datasetA.parent != datasetB.parent AND datasetA.domain NOT LIKE 'z%'").selectExpr(
        "datasetA.domain as a", "datasetB.domain as b").collect()}
    found = S.lsh_pairs(prep, 0.6, 0.4, 3)  # zero vectors are like nothing
    rows = found.collect()
    assert {(r.domain_a, r.domain_b) for r in rows} == want and len(rows) == len(want) > 100
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_box_bounds_hold_and_exclude():
    """No product of two boxes exceeds their bound, and vectors in groups leave few pairs of boxes."""
    from sigmesh.operators.boxes import Boxed, directions, most, parts
    rng = np.random.default_rng(5)
    x = np.repeat(unit_rows(6, 40), 200, axis=0) + 0.02 * rng.normal(size=(1200, 40))
    x[7], x[8, 3] = 0.0, np.nan
    p = parts(x, directions(x))
    boxed = Boxed(p, 50)
    bound = most(boxed.least, boxed.largest, boxed.least, boxed.largest)
    y = np.nan_to_num(x[boxed.order])
    for i, (a, b) in enumerate(zip(boxed.starts, boxed.ends)):
        assert all((y[a:b] @ y[c:d].T).max() <= bound[i, j] for j, (c, d) in enumerate(zip(boxed.starts, boxed.ends)))
    assert (bound >= 0.9).mean() < 0.5 and sorted(boxed.order.tolist()) == list(range(1200)) and len(boxed.starts) >= 20


def test_lsh_pairs_of_boxes_are_those_of_a_plain_pass(spark, monkeypatch):
    """Many boxes and blocks, vectors of floats, names of several rows: every pair once, nothing left out; no distinct where names are unique."""
    monkeypatch.setattr(S, "FEW_BOXES", 5)
    monkeypatch.setattr(S, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(9)
    x = np.repeat(unit_rows(7, 12), 40, axis=0) + 0.08 * rng.normal(size=(280, 12))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(f"d{i:03d}", f"p{i}", v.tolist()) for i, v in enumerate(x)], "domain string, parent string, u array<float>")
    found = S.lsh_pairs(df, 0.9, 4.0, 6)  # buckets so wide that nearly all share one
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    v = df.select("domain", array_to_vector("u").alias("vec"))
    sig = {r.domain: [h[0] for h in r.h] for r in BucketedRandomProjectionLSH(inputCol="vec", outputCol="h", bucketLength=4.0, numHashTables=6, seed=42).fit(v).transform(v).collect()}
    g = x.astype(float) @ x.astype(float).T
    want = {(f"d{i:03d}", f"d{j:03d}"): g[i, j] for i in range(280) for j in range(i + 1, 280)
            if g[i, j] >= 0.9 and any(a == b for a, b in zip(sig[f"d{i:03d}"], sig[f"d{j:03d}"]))}
    rows = found.collect()
    assert len(rows) == len(want) > 1000 and all(abs(want[r.domain_a, r.domain_b] - r.raw) < 1e-12 for r in rows)
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    twice = S.lsh_pairs(df.unionByName(df), 0.9, 4.0, 6).collect()
    assert sorted((r.domain_a, r.domain_b) for r in twice) == sorted(want)


def test_copies_are_members_of_a_class(spark):
    from sigmesh.plans.q_iterative import near_copies
    x = np.eye(4)
    near = np.array([1.0, 0.2, 0.0, 0.0]) / np.sqrt(1.04)
    rows = [(f"a{i:03d}", x[0].tolist()) for i in range(100)] + [(f"b{i}", near.tolist()) for i in range(3)] + [("c", x[2].tolist()), ("e0", [0.0] * 4), ("e1", [0.0] * 4), (None, x[0].tolist())]
    got = sorted((r.domain_a, r.domain_b) for r in near_copies(spark.createDataFrame(rows, "domain string, u array<float>"), 0.9).collect())
    assert got == sorted([("a000", f"a{i:03d}") for i in range(1, 100)] + [("b0", "b1"), ("b0", "b2"), ("a000", "b0")])


def test_search_with_a_floor_writes_nothing(spark):
    from sigmesh.operators.search import search
    x = unit_rows(130, 6, seed=5)
    df = spark.createDataFrame([(f"d{i}", v.tolist()) for i, v in enumerate(x)], "domain string, u array<double>").cache()
    stats, pairs = search(df.limit(40), df, CFG, 40, 130, block_rows=32, floor=0.5)
    seeds = [int(r.domain[1:]) for r in df.limit(40).collect()]
    want = {(f"d{i}", f"d{j}") for i in seeds for j in range(130) if i != j and x[i] @ x[j] >= 0.5}
    assert {(r.seed, r.domain) for r in pairs.collect()} == want and stats.count() == 40
    assert "FlatMapGroupsInArrow" in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_training_pieces_are_bounded():
    from sigmesh.operators import graphnet as G
    counts = [3, 70_000, 40_000, 40_000, 1, 2]
    b = pa.record_batch([pa.array([f"n{i}" for i in range(6)]), pa.array([np.full(2 * c, i, float) for i, c in enumerate(counts)], pa.list_(pa.float64()))], ["domain", "zs"])
    for batch in (b, b.slice(1)):
        seen = []
        for part, z, first in G._pieces(batch, 2):
            assert z.shape == (first[-1], 2) and (len(z) <= G.PIECE_ROWS or part.num_rows == 1)
            seen += [(part.column("domain")[i].as_py(), int(z[first[i], 0]), int(first[i + 1] - first[i])) for i in range(part.num_rows)]
        assert seen == [(f"n{i}", i, c) for i, c in enumerate(counts)][6 - batch.num_rows:]


def test_training_packs_hold_each_neighbour_once(spark):
    """40 nodes that all know each other: 40 means in a pack and two places a message, not a mean for each of the 1,600 messages."""
    from sigmesh.operators import graphnet as G
    nodes = spark.createDataFrame([(f"d{i}", float(i), float(i % 3), i % 2) for i in range(40)], "domain string, a double, b double, label int")
    edges = spark.createDataFrame([(f"d{i}", f"d{j}") for i in range(40) for j in range(i)] + [("d1", "d0"), ("d0", "d0"), (None, "d1"), ("d1", "x")],
                                  "domain_a string, domain_b string")
    sent = G.messages(nodes, edges).checkpoint()
    assert sent.count() == 1600 == sent.distinct().count()
    split = nodes.select("domain", nodes.label.alias("y"), (nodes.label >= 0).alias("train"), (nodes.label < 0).alias("test"))
    net = G.with_scaling(G.random_network(["a", "b"], 8), nodes)
    first = G._means(G.inputs(nodes, net), sent, G._heavy(sent, "src").checkpoint(), 2)
    pack, = G._packs(first, sent, G._heavy(sent, "src").checkpoint(), split, 2, 20_000).collect()
    assert len(pack.zs) == 40 * 2 and len(pack.near) == len(pack.users) == 1600 * 4 and pack.alone


def test_sums_of_places():
    """Short and long sums of listed rows, and none."""
    from sigmesh.operators import graphnet as G
    rng = np.random.default_rng(9)
    values, counts = rng.normal(size=(500, 3)), np.array([0, 1, 400, 5, G.LONG_SUM, G.LONG_SUM + 1, 0, 2, *[3] * (G.STEP_ROWS + 5)])
    index = rng.integers(0, 500, counts.sum())
    want = [values[x].sum(0) for x in np.split(index, np.cumsum(counts)[:-1])]
    assert np.allclose(G._sums(values, index, counts), want, atol=1e-12)


def test_unit_takes_the_norm_once(spark):
    from sigmesh.functions.vectors import unit
    rows = [([3.0, 4.0],), ([0.0, 0.0],), ([1.0, None],), ([],), (None,), ([float("nan"), 1.0],)]
    out = spark.createDataFrame(rows, "v array<float>").select(unit("v").alias("u"))
    assert repr([r.u for r in out.collect()]) == "[[0.6, 0.8], [0.0, 0.0], [0.0, 0.0], [], None, [nan, nan]]"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1


def test_syndicated_rows_cost_a_tile_no_matrices():
    """Rows that count 0 are set in place: a tile with some needs no more room than one without, and gives what the rule says."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1024, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]

    def tile(share):
        t = pa.table({"domain": [f"d{i}" for i in range(1024)], "parent": [f"s{i % 7}" for i in range(1024)], "u": pa.array(list(x)),
                      "auth": np.zeros(1024, bool), "synd": rng.random(1024) < share})
        half = pa.array(np.arange(1024) < 512)
        left, right = S.sides(t, half, pc.invert(half))
        tracemalloc.start()
        rows = pa.Table.from_batches(list(S.tile_products(left, right, CFG, 0.3, pairs=False, sums=False))).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return left, right, rows, peak
    left, right, rows, peak = tile(0.1)
    eff = np.where(left.synd[:, None] | right.synd[None, :], 0.0, left.u @ right.u.T)
    eff[left.site[:, None] == right.site[None, :]] = -np.inf
    got = {r["domain_a"]: (r["max_eff"], r["n_over"]) for r in rows}
    want = {**dict(zip(left.name.to_pylist(), zip(eff.max(1), (eff >= CFG.sim_threshold).sum(1)))),
            **dict(zip(right.name.to_pylist(), zip(eff.max(0), (eff >= CFG.sim_threshold).sum(0))))}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)
    assert peak < 1.3 * tile(0.0)[3]


def test_package_is_sent_before_the_pivots_are_used(spark, monkeypatch):
    from sigmesh import session
    from sigmesh.operators import simjoin
    seen = []

    def homes(prep, pivots):
        seen.append(spark.sparkContext.applicationId in session._SHIPPED)
        raise StopAsyncIteration

    monkeypatch.setattr(session, "_SHIPPED", set())
    monkeypatch.setattr(simjoin, "_with_home", homes)
    prep = spark.createDataFrame([(f"d{i}", f"s{i}", [float(i), 1.0], False, False) for i in range(5)],
                                 "domain string, parent string, u array<double>, auth boolean, synd boolean")
    with pytest.raises(StopAsyncIteration):
        simjoin.pruned_products(prep, CFG, 5, pivots=2)
    assert seen == [True]


def test_near_copies_group_the_vectors_once(spark):
    """Vectors are read for their classes and for the members, not again by each pass over the classes."""
    from sigmesh.plans.q_iterative import near_copies
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for pdf in frames:
            read.add(len(pdf))
            yield pdf

    rows = [(f"d{i}", [1.0, float(i % 3)]) for i in range(12)]
    got = near_copies(spark.createDataFrame(rows, "domain string, u array<float>").mapInPandas(counted, "domain string, u array<float>"), 0.9).collect()
    assert read.value <= 2 * len(rows)
    first = {i: min((f"d{j}" for j in range(12) if j % 3 == i)) for i in range(3)}
    assert {(r.domain_a, r.domain_b) for r in got if r.raw >= 0.9} >= {(first[i % 3], f"d{i}") for i in range(12) if f"d{i}" != first[i % 3]}


def tables_of(spark, tmp_path, vectors, texts, **more):
    """A folder with embeddings (id, vector, label), documents (id, text) and other tables as (rows, schema)."""
    spark.createDataFrame([(i, [float(x) for x in v], s) for i, v, s in vectors], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name, (rows, schema) in more.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_evidence_moves_no_pairs_to_texts(spark, tmp_path):
    """Every pair with the lengths of each of its ends' texts, also of an id with two; nothing is joined to pairs."""
    from sigmesh.plans.q_monitor import q_evidence_pairs
    x = unit_rows(40, 5, seed=8)
    texts = [(i, "t" * (i + 1)) for i in range(39)] + [(3, "three")]
    d = tables_of(spark, tmp_path, [(i, v, i % 3) for i, v in enumerate(x)], texts)
    out = q_evidence_pairs(spark, d)
    u = x.astype(np.float32).astype(float)
    lens = {i: sorted(len(t) for k, t in texts if k == i) or [0] for i in range(40)}
    want = []
    for i in range(40):
        for j in range(40):
            if f"d{i}" < f"d{j}" and i % 3 != j % 3 and u[i] @ u[j] / np.linalg.norm(u[i]) / np.linalg.norm(u[j]) >= 0.3:
                want += [(f"d{i}", f"d{j}", a, b) for a in lens[i] for b in lens[j] for _ in range(len(lens[i]) * len(lens[j]))]
    got = sorted((r.domain_a, r.domain_b, r.excerpt_a_len, r.excerpt_b_len) for r in out.collect())
    assert got == sorted(want) and len(got) > 100
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_search_copies_few():
    """6 GB of documents: a seed goes to every block of vectors, a vector to every block of seeds."""
    from sigmesh.operators.search import FEW_BLOCKS, FEW_SEED_BLOCKS, MOST_ROWS, MOST_SEEDS, search_blocks
    n_seeds, n = 61_538, 3_076_920
    s, v = search_blocks(n_seeds, FEW_SEED_BLOCKS, MOST_SEEDS), search_blocks(n, FEW_BLOCKS, MOST_ROWS)
    assert n_seeds * v + n * s < 13e6  # 95 million with blocks of 4,096 rows
    assert (search_blocks(0, 2, 10), search_blocks(4096, 16, 32_768), search_blocks(65_536, 16, 32_768), search_blocks(10, 2, 10, 3)) == (1, 1, 16, 4)


def odd_vectors(spark, n=90, dim=6):
    """Vectors with names of several rows (one with two sites), without a name, without a site, without numbers, and listed ones."""
    x = unit_rows(n, dim, seed=11)
    name = [f"d{i % 70:02d}" for i in range(n)]
    name[5], name[33], name[9] = None, None, "reuters.com"
    rows = [(name[i], None if i == 20 else f"s{i % 4}", None if i == 40 else v.tolist(), name[i] == "reuters.com", i % 17 == 3) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "domain string, parent string, u array<double>, auth boolean, synd boolean").repartition(3)


@pytest.mark.parametrize("plain", [False, True])
def test_sums_over_neighbours_are_those_of_the_pairs(spark, plain, monkeypatch):
    """What tiles add up is what joins with the written pairs give; blocks of a few rows, steps of a few comparisons."""
    from sigmesh.operators import graph as G, graphnet as N, neighbours as B
    monkeypatch.setattr(B, "STEP_CELLS", 200)
    monkeypatch.setattr(B, "PAIR_STEP", 16)
    prep = odd_vectors(spark).cache()
    links = spark.createDataFrame([("d00", "d01"), ("d02", "d60"), ("d03", "x1"), ("x1", "x2"), ("d04", "d05"), ("d04", "d05")], "domain_a string, domain_b string")
    links = links.unionByName(spark.createDataFrame([(f"d{i:02d}", f"d{i + 9:02d}") for i in range(40)], links.schema))
    nodes = spark.createDataFrame([(f"d{i:02d}", float(i), i % 5) for i in range(0, 60)] + [("d07", 1.5, None), ("x1", 2.0, 1), ("lonely", 3.0, 2), (None, 9.0, 9)],
                                  "domain string, f double, g int")
    pairs = S.similarity_pairs(S.block_products(prep, CFG, 4, plain=plain)).cache()
    monkeypatch.setattr(B, "blocks_for", lambda n: 4)
    edges = B.VectorEdges(prep, CFG, 90, plain)
    linked = B.VectorEdges(prep, CFG, 90, plain, links)
    both = pairs.select("domain_a", "domain_b").unionByName(links)
    rounded = lambda df: sorted(((*(round(v, 9) if isinstance(v, float) else v for v in r),) for r in df.collect()), key=str)
    assert pairs.count() > 300
    assert rounded(G.neighbor_mean(nodes, linked, ["f", "g"])) == rounded(G.neighbor_mean(nodes, both, ["f", "g"]))
    assert rounded(G.domain_cards(nodes, linked, 3)) == rounded(G.domain_cards(nodes, both, 3))
    assert rounded(S.edge_features(nodes, edges, .85)) == rounded(S.edge_features(nodes, pairs, .85))
    net = N.with_scaling(N.fixed_network(["f", "g"]), nodes)
    assert rounded(N.scores(nodes, edges, net)) == rounded(N.scores(nodes, pairs, net))


def test_neighbour_queries_write_no_pair(spark, monkeypatch):
    """Cards, means and scores read tiles that add up: nothing asks for pairs."""
    from sigmesh.operators import similarity
    from sigmesh.plans import q_graph, q_graphnet, q_legacy
    for m in (q_graph, q_legacy, similarity):
        monkeypatch.setattr(m, "similarity_pairs", lambda *a, **k: pytest.fail("pairs are made"))
    d = "/root/testdata/sf0.001"
    for q in (q_graph.q_domain_cards, q_graph.q_neighbor_mean, q_graphnet.q_graph_network_scores, q_graphnet.q_graph_network_stored):
        assert q(spark, d).count() > 0


def test_bylines_and_links_are_stored_once(spark):
    """Rows that several branches read are columns on disk, not cached rows, and their shuffles are no part of the last plan."""
    from sigmesh.operators.authors import author_signal
    from sigmesh.operators.links import link_signal
    doms = spark.createDataFrame([("a",), ("b",), ("c",), ("e",)], "domain string")
    by = spark.createDataFrame([("a", "Ann Lee"), ("a", " ann lee "), ("b", "ANN LEE"), ("c", "Bob Day"), ("z", "Bob Day"), ("b", None), (None, "Bob Day")], "domain string, author string")
    out = author_signal(doms, by)
    assert sorted((r.domain, r.shared_author_count, list(r.shared_authors)) for r in out.collect()) == [
        ("a", 1, [" ann lee "]), ("b", 1, ["ANN LEE"]), ("c", 1, ["Bob Day"]), ("e", 0, [])]
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "a"), ("a", "a"), ("a", "x"), ("c", "a"), (None, "a")], "src string, dst string")
    net = link_signal(links, doms, CURRENT)
    assert sorted((r.domain, r.n_links, r.in_set_links, r.mutual_link_count) for r in net.collect()) == [("a", 2, 1, 1), ("b", 1, 1, 1), ("c", 1, 1, 0), ("e", 0, 0, 0)]
    for df in (out, net):
        assert "InMemoryRelation" not in df._jdf.queryExecution().withCachedData().toString()


def test_upserts_keep_columns_not_rows(spark, tmp_path, monkeypatch):
    """What an upsert writes on its way is compressed columns, never a checkpoint of rows."""
    from pyspark.sql.classic.dataframe import DataFrame
    from sigmesh.operators.graphstore import GraphStore
    store = GraphStore(spark, f"{tmp_path}/graph", buckets=3, flag_at=.5)
    nodes = spark.createDataFrame([(f"d{i}", "x") for i in range(9)], "domain string, registrar string").withColumn("updated_at", F.to_timestamp(F.lit("2001-01-01")))
    store.rebuild(nodes)
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("rows are checkpointed"))
    edges = spark.createDataFrame([("d1", "d2", "SIMILAR_TO", .7), ("d3", "d2", "SIMILAR_TO", .4), ("d1", "zz", "SIMILAR_TO", .9)], "domain_a string, domain_b string, kind string, similarity double")
    for at in ("2001-02-01", "2001-03-01"):
        assert store.upsert_edges(edges, at)
    assert sorted(tuple(r)[:5] for r in store.table("edges").select("domain_a", "domain_b", "kind", "similarity", "flagged").collect()) == [
        ("d1", "d2", "SIMILAR_TO", .7, 1), ("d2", "d3", "SIMILAR_TO", .4, 0)]

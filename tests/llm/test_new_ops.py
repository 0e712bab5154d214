"""Fingerprints, spelling variants and centroids against brute force, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "\n".join(" ".join(f"w{i}x{j}" for j in range(30)) for i in range(40))
TEXTS = [(1, None), (2, ""), (3, "\n"), (4, "a b c d\ne f"), (5, "e f\na b c d"), (6, "a b c d\ne f"), (7, LONG), (8, LONG + "\nmore é \U0001f600"),
         (9, "x" * 20_000), (10, "word " * 30_000), (12, "one\n\n\ntwo"), (12, "one\n\n\ntwo"), (12, "same id"), (None, "no id"), (-3, "a  b\t c")]
SCHEMA = "doc_id long, text string, part string, n int, row array<string>, place int, word string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", 0, ["x"], 1, "w") for i, t in TEXTS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def vector(text):
    """The fingerprint by its definition."""
    lanes = [0] * 82
    for p in (text or "").split("\n"):
        d = hashlib.sha256(p.encode()).hexdigest()
        lanes[0] += 1
        for k in range(8):
            e = xxhash.xxh64(struct.pack("<i", k), seed=xxhash.xxh64(d.encode(), seed=42).intdigest()).intdigest()
            lanes[2 + 2 * k] += e & 0xFFFFFFFF
            lanes[3 + 2 * k] += e >> 32
        w = p.split(" ")
        for i in range(max(len(w) - 3, 0) + 1):
            h = 42
            for x in w[i:i + 3]:
                h = xxhash.xxh64(x.encode(), seed=h).intdigest()
            lanes[1] += 1
            for g in range(64):
                lanes[18 + g] += 1 if h >> g & 1 else -1
    return [x % (1 << 32) for x in lanes]


def like(a, b):
    if a == b:
        return 1.0
    x, y = (np.array([s - (1 << 32) if s >= 1 << 31 else s for s in v[18:]], dtype=float) for v in (a, b))
    return max(0.0, 2 * float(x @ y) / float(x @ x + y @ y))


def test_multiset(spark, docs, none):
    from sigmesh.llm import multiset as m
    once = sorted({(i, t or "") for i, t in TEXTS}, key=lambda r: (
        r[0] is not None, r[0] or 0, hashlib.sha256((("-" if r[0] is None else str(r[0])) + "\n" + r[1]).encode()).digest()))
    want = Counter()
    copies = Counter((i, t or "") for i, t in TEXTS)
    for k, (i, t) in enumerate(once):
        n, after = len(t) // 4, once[(k + 1) % len(once)][1]
        e = t[:len(t) - n] + after[:n]
        v, w = vector(t), vector(e)
        want[(i, len(t), hashlib.sha256(e.encode()).hexdigest(), tuple(v), tuple(w), tuple(vector(after)))] += copies[(i, t)]
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, tuple(r.vector), tuple(r.edited_vector), tuple(r.next_vector))
                  for r in m.edited(spark, docs).collect())
    assert got == want
    assert m.edited(spark, none).count() == 0 and m.fingerprints(none).count() == 0
    one = m.edited(spark, docs.filter("doc_id = 7")).select(m.likeness(F.col("vector"), F.col("next_vector")).alias("x")).collect()
    assert [r.x for r in one] == [1.0]


def test_multiset_is_homomorphic(spark, docs):
    from sigmesh.llm import multiset as m
    rows = m.fingerprints(docs).select("doc_id", "vector", m.as_text(F.col("vector")).alias("hex"))
    v = {r.doc_id: r for r in rows.filter("doc_id < 12").collect()}
    assert v[4].vector == v[5].vector == v[6].vector and v[4].hex == v[6].hex and len(v[4].hex) == 82 * 8  # in any order
    assert v[1].vector == v[2].vector != v[3].vector
    two = spark.createDataFrame([(1, LONG), (2, "more é \U0001f600")], "doc_id long, text string")
    a, b = [r.vector for r in m.fingerprints(two).orderBy("doc_id").collect()]
    pair = spark.createDataFrame([(a, b, v[8].vector)], "a array<long>, b array<long>, both array<long>")
    r = pair.select((m.plus(F.col("a"), F.col("b")) == F.col("both")).alias("p"), (m.minus(F.col("both"), F.col("b")) == F.col("a")).alias("q"),
                    m.likeness(F.col("a"), F.col("both")).alias("near"), m.likeness(F.col("a"), F.col("b")).alias("far")).first()
    assert r.p and r.q and r.near == like(a, v[8].vector) > 0.95 and r.far == like(a, b) < 0.2


def brute_words(rows, least=3, letters=5):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if n >= least and len(w) >= letters}


def edits_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(count):
    near = {w: [x for x in count if edits_one(w, x)] for w in count}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= 2 * count[w]:
            form[w] = best
    out = set()
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, count[w], len(near[w]), count[form[w]] if w in form else None))
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_spelling(spark, none, block):
    from sigmesh.llm import spelling
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcé"), size=rng.integers(4, 9))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(base, size=60)) + " ÉCOLE Ecole1école×abcab " + "aaaaa aaaaaa aaaaaaa " * (i % 3)) for i in range(40)]
    rows += [(None, "words words wordz words"), (None, "wordz wordz"), (1, None), (2, ""), (3, "1234 --"), (7, "ba" * 300 + " "), (8, "ba" * 300), (9, "ba" * 300 + "c"),
             (9, "ba" * 300 + "c"), (9, "ba" * 300)]
    docs = spark.createDataFrame([(i, t, "clash", 0, ["x"], 1, "w") for i, t in rows], SCHEMA).repartition(4)
    got = {tuple(r) for r in spelling.variants(spark, docs, block=block).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_variants(brute_words(rows))
    assert spelling.variants(spark, none).count() == 0


def test_tile_of_two_blocks():
    from sigmesh.llm import spelling
    words = ["abcde", "abcdf", "abcdef", "abcXe", "abcdeg"]
    n = np.array([5, 9, 4, 2, 9])
    count, best = spelling.tile(words, n, np.array([0, 1, 0, 0, 1]), 6, 0, 0, 1)
    # across the blocks, in the bucket of longer words of six: pairs of two shorter words belong elsewhere
    assert count.tolist() == [1, 1, 2, 0, 2] and best.tolist() == [4, 2, 4, -1, 0]


def brute_clusters(rows, k=40, rounds=5, dim=64):
    kept = [(i, [int(np.floor(256 * float(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dim and all(x is not None and np.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    v = np.array([e for _, e in kept], dtype=np.int64)
    c = np.array([e for _, e in order[:k]], dtype=np.int64)

    def nearest():
        d = np.stack([((v - x) ** 2).sum(1) for x in c], 1)
        return d.argmin(1), d.min(1)
    for _ in range(rounds):
        a, _d = nearest()
        for j in range(len(c)):
            if (a == j).any():
                c[j] = v[a == j].sum(0) // (a == j).sum()
    a, d = nearest()
    return Counter((i, int(x), int(y), int(d[a == x].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, c[x].tolist())).encode()).hexdigest())
                   for (i, _), x, y in zip(kept, a, d))


def test_centroids(spark):
    from sigmesh.llm import centroids
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 1, (12, 64))
    rows = [(i, (middles[i % 12] + rng.normal(0, 0.02, 64)).tolist()) for i in range(1500)]
    rows += [(i, rows[0][1]) for i in range(2000, 2700)] + [(5000, rows[1][1])] * 3 + [(None, rows[2][1])]
    rows += [(6000, None), (6001, []), (6002, [1.0] * 63), (6003, [1.0] * 65), (6004, [None] + [1.0] * 63), (6005, [float("nan")] * 64),
             (6006, [float("inf")] + [0.0] * 63), (6007, [0.0] * 64), (6008, [-0.001] * 64)]
    df = spark.createDataFrame([(i, e, 1, "x", 2) for i, e in rows], "vec_id long, embedding array<double>, label int, cluster string, distance int").repartition(5)
    work = []
    got = Counter(tuple(r) for r in centroids.clusters(spark, df, block=16, work=work).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())
    assert got == brute_clusters(rows)
    assert len(work) == 5 and all(w["compared"] < 0.5 * w["all"] for w in work)  # boxes leave few candidates where vectors form groups
    few = df.filter("vec_id in (6007, 6008, 6005)")
    assert Counter(tuple(r) for r in centroids.clusters(spark, few).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()) \
        == brute_clusters([r for r in rows if r[0] in (6007, 6008, 6005)])
    assert centroids.clusters(spark, df.limit(0)).count() == 0


def test_large_numbers(spark):
    from sigmesh.llm import centroids
    rows = [(i, [float(x)] * 64) for i, x in enumerate([1e30, -1e30, 400000.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    capped = [(i, [max(min(x, centroids.LIMIT / 256), -centroids.LIMIT / 256) for x in e]) for i, e in rows]
    got = centroids.clusters(spark, df, k=2).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert Counter(map(tuple, got)) == brute_clusters(capped, k=2)


def test_curve_visits_neighbours():
    from sigmesh.llm import centroids
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = centroids.curve_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_box_bounds_keep_the_nearest():
    from sigmesh.llm import centroids
    rng = np.random.default_rng(1)
    for _ in range(50):
        x, c = rng.integers(-50, 50, (20, 8)), rng.integers(-80, 80, (15, 8))
        may = centroids.candidates(x.min(0), x.max(0), c)
        assert set(((x[:, None] - c[None]) ** 2).sum(2).argmin(1)) <= set(may)


def test_toxicity_places_go_to_texts_that_are_read(spark):
    """Labels of texts that are too long, or of ids that are gone, take no place in the sample."""
    from sigmesh.llm import toxicity
    short = [(i, ("you awful horrible " if i % 4 == 0 else "a calm and friendly ") + f"text number {i}") for i in range(200)]
    docs = spark.createDataFrame([*short, *[(1000 + i, "long " * 2000) for i in range(300)]], "doc_id long, text string")
    labels = spark.createDataFrame([*[(i, int(i % 4 == 0)) for i in range(200)], *[(1000 + i, 1) for i in range(300)], *[(5000 + i, 1) for i in range(300)]],
                                   "doc_id long, toxic int")
    clf = toxicity.fit(docs, labels, rows=120)
    got = {r.doc_id: r.score for r in toxicity.score(spark, docs, clf).collect()}
    toxic, calm = [got[i] for i in range(200) if i % 4 == 0], [got[i] for i in range(200) if i % 4]
    assert min(toxic) > max(calm)


def test_toxicity_learns_from_every_labelled_row(spark):
    """Counts, gradients and thresholds are those of all rows and whole texts, however they lie in partitions."""
    import zlib
    from sigmesh.llm import toxicity
    rows = [(i, ("x " * 5000 + "vile end" if i % 5 == 0 else f"plain w{i % 40}"), int(i % 5 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    table = toxicity.labelled(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")).cache()
    want = {i: (t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert {r.doc_id: (r.text, r.label) for r in table.collect()} == want  # long texts too
    kept, seen, bad = toxicity.count_buckets(table)
    vile, plain = (int(np.flatnonzero(kept == toxicity._word_hash(w))[0]) for w in ("vile", "plain"))
    p = sum(y for _, y in want.values())
    assert seen[vile] >= bad[vile] >= p and seen[plain] >= len(want) - p and bad[plain] < p
    net = toxicity.start(kept, seen, bad, p, len(want) - p)
    many, one = (toxicity.gradient_sums(table.repartition(n), net, p, len(want) - p) for n in (7, 1))
    (a, b), (c, d) = ((x[0][np.argsort(x[0])], x[1][np.argsort(x[0])]) for x in (many, one))
    assert (a == c).all() and np.abs(b - d).max() < 1e-6


def test_toxicity_gradient_is_that_of_the_loss():
    from sigmesh.llm import textkit, toxicity
    import pyarrow as pa
    texts, y = ["vile thing here", "calm day", "", "a vile vile word", "plain"], np.array([1, 0, 0, 1, 0])
    feats, first = toxicity.features(next(textkit.chunks(pa.array(texts))))
    kept = np.unique(feats)
    net = toxicity.start(kept, np.full(len(kept), 5), np.arange(len(kept)) % 5, 3, 2)
    x, weight = net.parameters(), np.array([.1, .2, .3, .2, .2])

    def loss(values):
        z = net.with_parameters(values).logits(feats, first).astype(float)
        return float((weight * (np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))).sum())
    at, g = net.gradient(feats, first, y, weight)
    full = np.zeros_like(x)
    full[at] = g
    rng = np.random.default_rng(0)
    for _ in range(5):
        way = rng.normal(size=x.shape) * (np.abs(full) > 0)
        assert abs((loss(x + 1e-3 * way) - loss(x - 1e-3 * way)) / 2e-3 - (full * way).sum()) < 2e-3 * max(1, np.abs(full * way).sum())


def test_toxicity_thresholds_are_the_best_of_all_rows(spark):
    from sigmesh.llm import toxicity
    rng = np.random.default_rng(3)
    rows = [(["en", "de", None][i % 3], round(float(rng.normal() + (i % 4 == 0) * (1.5 if i % 3 else .5)), 2), int(i % 4 == 0)) for i in range(900)]
    rows += [("fr", 1.0, 1)] * 3 + [("fr", 0.0, 0)] * 20  # too few of one label
    got = toxicity.thresholds(spark.createDataFrame(rows, "language string, z double, label int"))

    def f1(own, at):
        picked = [y for z, y in own if z >= at]
        return 2 * sum(picked) / (len(picked) + sum(y for _, y in own))
    assert set(got) == {"", "en", "de"}
    for lang, at in got.items():
        own = [(z, y) for k, z, y in rows if lang in ("", k)]
        assert f1(own, at) == max(f1(own, z) for z, _ in own)
    assert toxicity.thresholds(spark.createDataFrame([], "language string, z double, label int")) == {}

"""The ten operators against brute force on a small table with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

WS = r"[\x20\x09-\x0D]+"
LINE = "This very common line stands in many documents."
LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  b"), (6, "a b"), (7, "a b"), (7, "a b"),
    (10, LONG), (11, LONG + " x"), (12, LONG.replace("w30", "v30")), (13, LONG.upper()), (14, "w1 w2 " + LONG[30:]),
    (20, f"{LINE}\nown one\n{LINE}"), (21, f"  {LINE.upper()}\t\nown two"), (22, f"x\n{LINE}\n"), (23, f"{LINE}"),
    (30, "word " * 3000), (31, "Hello, WORLD! éè \U0001f600 " * 40), (None, "no id at all"),
    (40, "Released under the MIT License. " + LONG), (41, "some words first\nThis work is licensed under the GNU General Public License, version 3.\nmore"),
]
SCHEMA = "doc_id long, text string, k1 string, n_tokens int, name array<string>"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", 0, ["x"]) for i, t in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_exact_groups(spark, docs, none):
    from sigmesh.llm import exact_dedup
    same = defaultdict(list)
    for i, t in ROWS:
        same[re.sub(WS, " ", t or "")].append(i)
    want, seen = [], set()
    for i, t in ROWS:
        n = re.sub(WS, " ", t or "")
        keep = min((x for x in same[n] if x is not None), default=None)
        first = (i, n) not in seen
        seen.add((i, n))
        want.append((i, keep, len(same[n]), i == keep and first, hashlib.sha256(n.encode()).hexdigest()))
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(exact_dedup.exact_groups(spark, docs), *cols) == sorted(want, key=repr)
    # a two-bit block hash forces collisions: the names must still tell all texts apart
    assert rows(exact_dedup.exact_groups(spark, docs, block_bytes=2048, hash_bits=2), *cols) == sorted(want, key=repr)
    kept = exact_dedup.keep_first(spark, docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(w[0] for w in want if w[3])
    assert exact_dedup.exact_groups(spark, none).count() == 0


def test_line_dedup(spark, docs, none):
    from sigmesh.llm import line_dedup
    key = lambda s: "".join(c.lower() if c.isascii() else c for c in s.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(list)
    for i, t in ROWS:
        for k in {key(x) for x in (t or "").split("\n") if len(key(x)) >= 20}:
            held[k].append(i)
    want = []
    for i, t in ROWS:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(held[key(x)]) < 3 or max(held[key(x)]) == i]
        want.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    assert rows(line_dedup.drop_repeated_lines(spark, docs), "doc_id", "kept_text", "n_lines", "n_dropped") == sorted(want, key=repr)
    assert sum(w[3] for w in want) == 4
    # documents are counted by id: two ids (one with two texts) and one id beside rows without any are too few
    line = "a line of more than twenty characters"
    for ids in ([1, 1, 2], [None, None, None, 2]):
        few = spark.createDataFrame([(i, f"{line}\n{k}") for k, i in enumerate(ids)], "doc_id long, text string")
        assert all(r.n_dropped == 0 for r in line_dedup.drop_repeated_lines(spark, few).collect())
    three = spark.createDataFrame([(i, f"{line}\n{k}") for k, i in enumerate([1, 1, 2, 3, 3, None])], "doc_id long, text string")
    assert rows(line_dedup.drop_repeated_lines(spark, three), "doc_id", "n_dropped") == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 0), (3, 0), (None, 1)], key=repr)
    assert line_dedup.drop_repeated_lines(spark, none).count() == 0


def test_quality_ledger(spark, docs, none):
    from sigmesh.llm import quality

    def brute(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover)

    led = quality.ledger(spark, docs)
    got = rows(quality.verdicts(led), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = [(i, *(m := brute(t)), m[0] < 20 or 100 * m[4] > 30 * m[0]) for i, t in ROWS]
    assert got == sorted(want, key=repr)
    by_rule = {r.rule: r for r in quality.ablations(led, "base-1").collect()}
    failed = [(w[1] < 20, 100 * w[5] > 30 * w[1]) for w in want]
    assert by_rule["few_words"].only_by_it == sum(a and not b for a, b in failed)
    assert by_rule["repeated_words"].rejected_without_it == sum(a for a, _ in failed)
    assert quality.ledger(spark, none).count() == 0


def test_huffman_round_trip(spark, docs, none):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    from sigmesh.llm import huffman
    rng = np.random.default_rng(3)
    counts = np.zeros(300, dtype=np.int64)
    counts[:200] = rng.zipf(1.3, 200) % 10_000_000 + 1
    lengths = huffman.code_lengths(counts, 9)
    assert lengths.max() <= 9 and (lengths[200:] == 0).all() and sum(2.0 ** -int(x) for x in lengths if x) <= 1 + 1e-12
    free = huffman.code_lengths(np.array([1, 1, 2, 4, 8]), 20)
    assert list(free) == [4, 4, 3, 2, 1]
    ids = rng.integers(0, 200, 3001).astype(np.uint32)
    box = huffman.pack_container([(5, ids[:1]), (None, ids[1:])], lengths, huffman.canonical(lengths))
    index, out = huffman.unpack_container(box, huffman.decode_table(lengths))
    assert (out == ids).all() and index.tolist() == [[5, 1], [huffman.NO_ID, 3000]]

    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    coded = [(i, tok.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in ROWS]
    got = huffman.read_tokens(spark, huffman.write_tokens(spark, docs, path, 2), with_ids=True).collect()
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == sorted(coded, key=repr)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.ids_crc32 == zlib.crc32(r.ids) and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert in_order == sorted(in_order)
    assert huffman.read_tokens(spark, huffman.write_tokens(spark, none, path, 2)).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    from sigmesh.llm import tokens
    texts = [t or "" for _, t in ROWS] + ["a  b", "\n a\n\nb ", "x y", "a\x1cb c", "<|endoftext|> x<|endoftext|>y", "it's  don't ' s",
                                           "\0a b", "a \0 b\0", " lead", "trail ", "\t", "é ́x", "word.'s word,,", "tab\tx \x01 y"]
    tok, enc = Tokenizer.from_file(P.path(name)), tokens.load(P.path(name))
    for _ in range(2):  # the second time from what is kept
        assert [o.tolist() for o in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_asks_for_known_words_once(name):
    """Words before signs and line ends, and those after a line end, are known from elsewhere."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    from sigmesh.llm import tokens
    tok, enc, asked = Tokenizer.from_file(P.path(name)), tokens.Encoder(P.path(name)), []
    library = enc.batch
    enc.batch = lambda texts, **how: asked.extend(texts) or library(texts, **how)
    for text in ("alpha beta gamma\nDelta gamma\nBeta x", "alpha, beta.\nDelta; gamma.\nBeta, beta!\nDelta, gamma"):
        asked.clear()
        got, = enc.encode([text])
        assert got.tolist() == tok.encode(text, add_special_tokens=False).ids
    assert not any(w in t.lower() for t in asked for w in ("alpha", "beta", "gamma", "delta"))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_null_characters_and_line_ends(name):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    from sigmesh.llm import tokens
    tok, enc = Tokenizer.from_file(P.path(name)), tokens.Encoder(P.path(name))
    texts = ["a\nb", "\0\0 \0a", "! \0,alpha \0.\nbeta", "a\n\nb \nc\n d\n", "\na\n\tb\r\nc\x85\nd\x1c\ne"]
    assert [o.tolist() for o in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_keeps_what_it_met_again(name, monkeypatch):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    from sigmesh.llm import tokens
    monkeypatch.setattr(tokens, "KEPT_PIECES", 40)
    tok, enc, asked = Tokenizer.from_file(P.path(name)), tokens.Encoder(P.path(name)), []
    library = enc.batch
    enc.batch = lambda texts, **how: asked.extend(texts) or library(texts, **how)
    for r in range(12):
        texts = ["common word, again\nand\n\n" + " ".join(f"{chr(97 + r)}{chr(97 + i)}z" for i in range(10 + 3 * r)), "", "common word"]
        if r == 2:
            asked.clear()
        assert [o.tolist() for o in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(enc.known) <= 40 + 60
    assert not any("common" in t for t in asked if "\n\n" not in t)


def test_packing(spark, docs, none):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    from sigmesh.llm import packing
    lengths = np.sort(np.random.default_rng(1).integers(1, 64, 400))[::-1]
    bins, offs = packing.first_fit_decreasing(lengths, 64)
    room, want = [], []
    for n in lengths:  # plain first fit
        b = next((i for i, r in enumerate(room) if r >= n), len(room))
        room += [64] * (b == len(room))
        want.append((b, 64 - room[b]))
        room[b] -= n
    full = int((lengths == 64).sum())
    assert full == 0 and list(zip(bins.tolist(), offs.tolist())) == want

    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack_documents(spark, docs, path, 1).collect()
    coded = {(i, t): tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in ROWS}
    assert sum(r.length for r in got) == sum(len(coded[x]) for x in ROWS)
    big = coded[ROWS[17]]
    mine = sorted((r for r in got if r.doc_id == 30), key=lambda r: r.start)
    assert [r.start for r in mine] == [0, 2048] and all(
        r.ids_crc32 == zlib.crc32(np.array(big[r.start:r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(big) for r in mine)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    whole = packing.sequences(spark, docs, path, 1).collect()
    assert all(len(r.ids) == 4 * (r.length if r.length & (r.length - 1) == 0 else 2048) for r in whole)
    assert packing.pack_documents(spark, none, path, 1).count() == 0


def _sets(data):
    out = {}
    for i, t in data:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k:k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])
    return out


def test_near_duplicates(spark, none):
    from sigmesh.llm import near_dedup
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    data = [(i, t) for i, t in ROWS if i is not None]
    for k in range(60):  # copies changed in up to nine words, so that links form chains and gaps
        w = list(base)
        for j in rng.choice(120, int(rng.integers(0, 10)), replace=False):
            w[j] = f"c{rng.integers(0, 1000)}"
        data.append((100 + k, " ".join(w)))
    df = spark.createDataFrame([(i, t, "c", 0, []) for i, t in data], SCHEMA).repartition(3)
    sets = _sets(data)
    label = {i: i for i in sets}
    ids = [i for i in sets if sets[i]]
    moved = True
    while moved:
        moved = False
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    moved = True
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(spark, df).collect()}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}
    kept = near_dedup.keep_one(spark, df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i in sets if label[i] == i}
    assert near_dedup.near_duplicates(spark, none).count() == 0


def test_main_text(spark):
    from sigmesh.llm import html_main
    page = ("<html><head><title>T</title><style>p{}</style></head><body class='has-sidebar'><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>"
            "<main><article><header><h1>Title &amp; more</h1></header><p>One<b>two</b>  three<br>four<p>five &lt;six&gt;<div class='ad'>BUY</div>"
            "<form>f<input></form><section class=comments><p>nice</p></section><aside>x</aside></article></main>"
            "<script>if(a<b){'</p>'}</script><!-- gone --><div class='sidebar'>s</div><footer>&copy; c</footer>tail <p")
    plain = "<body><div>Our plain banner line</div><p>Page {} tells a story of its own, long enough.</p><div>Contact us</div></body>"
    data = [(1, "http://a.example/1", page, "x"), (2, None, None, "x"), (3, "", "", "x"), (3, "", "", "x"), (4, "u", "just text", "x")]
    data += [(10 + k, f"https://Host.example:80/{k}", plain.format(k), "x") for k in range(6)]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string").repartition(3)
    got = sorted((r.page_id, r.text) for r in html_main.main_text(spark, df).collect())
    want = [(1, "Title & more\nOnetwo three four\nfive <six>"), (2, ""), (3, ""), (3, ""), (4, "just text")]
    # the lines around the story recur on every page of their host; the stories don't
    want += [(10 + k, f"Page {k} tells a story of its own, long enough.") for k in range(6)]
    assert got == sorted(want)
    assert html_main.main_text(spark, df.limit(0)).count() == 0


def test_templates_inside_and_beside_articles(spark):
    from sigmesh.llm import html_main
    page = ("<body><nav><a href=/>Home {0}</a></nav><h2>Headline {0} stands beside</h2><div>Site banner</div>"
            "<article><p>Story {0} has words of its own.</p><p>Buy our paper, said on every page.</p></article></body>")
    data = [(k, f"http://many.example/{k}", page.format(k)) for k in range(12)] + [(99, "http://one.example/", page.format(99))]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_main.main_text(spark, df).collect()}
    assert got == {k: f"Headline {k} stands beside\nStory {k} has words of its own." for k in range(12)} | {
        99: "Story 99 has words of its own.\nBuy our paper, said on every page."}
    # 5 blocks a page: banner and notice recur on the 12, menus are marked; on the lonely page all but the article is
    assert html_main.removals(spark, df).first().asDict() == {"blocks": 65, "recurring": 24, "marked": 15, "both": 0}


def test_pages_travel_in_compressed_bundles():
    import pyarrow as pa
    from sigmesh.llm import html_main
    rows = [*range(130), *range(1 << 33, (1 << 33) + 70)]
    blocks = [[f"A line of page {r} that is much like the others."] * 5 for r in rows]
    b = pa.record_batch([pa.array(rows), pa.array(rows), pa.array(["u"] * 200), pa.array(blocks), pa.array([[0, 1, 2, 0, 0]] * 200, pa.list_(pa.int32()))],
                        ["row", "page_id", "url", "blocks", "marks"])
    bundles = pa.concat_batches(list(html_main._bundled(iter([b.slice(0, 100), b.slice(100), b.slice(0, 0)]))))
    assert bundles.column("bundle").to_pylist() == [0, 1, 1, 2, 1 << 27, (1 << 27) + 1]
    assert sum(map(len, bundles.column("pages").to_pylist())) < b.nbytes / 4
    known = [[{"row": 3, "first": 1, "end": 2, "open": False}, {"row": 3, "first": 4, "end": 5, "open": False}], None, [{"row": 101, "first": None, "end": None, "open": True}],
             None, None, None]
    out = pa.Table.from_batches(list(html_main._opened(iter([bundles.append_column("known", pa.array(known))]))))
    assert out.select(["page_id", "url", "blocks", "marks"]).to_pylist() == b.select(["page_id", "url", "blocks", "marks"]).to_pylist()
    got = {r["page_id"]: (r["gone"], r["open"]) for r in out.to_pylist() if r["gone"] or r["open"]}
    assert got == {3: ([{"first": 1, "end": 2}, {"first": 4, "end": 5}], False), 101: ([], True)}


def test_copies_of_a_page_are_no_template(spark):
    from sigmesh.llm import html_main
    page = "<body><div>Few words {0}</div><ul><li>one {0}</li><li>two</li></ul><p>A paragraph of page {0}.</p></body>"
    data = [(k, "http://copies.example/", page.format(min(k, 9))) for k in range(9, 15)]
    data += [(k, "http://copies.example/", page.format(k)) for k in range(2)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    for r in html_main.main_text(spark, df).collect():
        k = min(r.page_id, 9)
        assert r.text == f"Few words {k}\none {k}\ntwo\nA paragraph of page {k}."


def test_templates_never_pass_the_driver(spark, monkeypatch):
    """What recurs and what is known of pages grows with the pages: no join broadcasts it, however small its files are."""
    from pyspark.sql.readwriter import DataFrameWriter
    from sigmesh.llm import html_main
    plans, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (plans.append(self._df), write(self, *a, **k))[1])
    page = "<html><body><div><p>menu of the site {h}</p></div><article><p>text {i}</p></article></body></html>"
    df = spark.createDataFrame([(i, f"http://h{i % 3}.example/{i}", page.format(h=i % 3, i=i)) for i in range(40)], "page_id long, url string, html string")
    out = html_main.main_text(spark, df)
    assert sorted(r.text for r in out.collect()) == sorted(f"text {i}" for i in range(40))
    shown = [p._jdf.queryExecution().executedPlan().toString() for p in [*plans, out]]
    assert sum("Join" in p for p in shown) >= 3 and not any("Broadcast" in p for p in shown)


def test_license_matches(spark, docs, none):
    from sigmesh.llm import license_scan
    mit = license_scan.TEMPLATES[1][1].split()
    data = [(1, "intro words here " + " ".join(mit) + " outro"), (2, " ".join(mit[:40])), (3, "intro " + " ".join(mit[:30] + ["changed"] + mit[31:])), (4, None)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.first_word, r.end_word, r.containment) for r in license_scan.license_matches(spark, df).collect()}
    assert got[1, "MIT"] == (3, 3 + len(mit), 1.0) and 0.8 <= got[3, "MIT"][2] < 1 and {d for d, _ in got} == {1, 3}
    assert rows(license_scan.license_matches(spark, docs), "doc_id", "license", "containment") == [(40, "MIT", 1.0), (41, "GPL-3.0", 1.0)]
    assert license_scan.license_matches(spark, none).count() == 0


def test_license_copies_close_together():
    import pyarrow as pa
    from sigmesh.llm import license_scan, textkit
    words = [f"t{i}" for i in range(80)]
    templates = license_scan.Templates((("X", " ".join(words)),))
    changed = words[:40] + ["other"] + words[41:]
    for gap in (0, 5, 10, 20, 60):
        for copies in ((words, words), (changed, words), (words, words, words)):
            text, want = ["lead"] * 7, []
            for c in copies:
                want.append((len(text), len(text) + 80))
                text = text + c + [f"g{len(text)}x{i}" for i in range(gap)]
            h, begin, _ = license_scan.shingles(next(textkit.chunks(pa.array([" ".join(text)]))))
            assert [m[2:4] for m in templates.matches(h, begin)] == want


def test_mixing_meets_targets(spark, docs, none):
    from pyspark.sql import functions as F
    from sigmesh.llm import mixing
    rng = np.random.default_rng(2)
    data, labels = [], []
    for i in range(400):
        junk = i % 4 == 0
        words = [("zz%%%" if junk else "plain") + str(rng.integers(0, 50)) for _ in range(int(rng.integers(5, 60)))]
        data.append((i, " ".join(words), "c", 0, []))
        labels.append((i, "junk" if junk else "good"))
    df = spark.createDataFrame(data, SCHEMA)
    lab = spark.createDataFrame(labels + [(None, "good"), (5, None)], "doc_id long, domain string")
    out = mixing.mixture(spark, df, lab, {"good": 0.9, "junk": 0.1}).select("doc_id", "n_tokens", F.col("p")["good"].alias("good"), "rate", "copies").toPandas()
    total = (out.n_tokens * out.rate).sum()
    assert abs((out.n_tokens * out.rate * out.good).sum() / total - 0.9) < 1e-3 and abs(total / out.n_tokens.sum() - 1) < 1e-3
    assert (out.rate >= 0).all() and dict(zip(out.doc_id, out.n_tokens)) == {i: len(t.split()) for i, t, *_ in data}
    kept = mixing.thin(spark, df, lab, {"good": 0.9, "junk": 0.1})
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == df.columns and {i for i in range(400) if i % 4} <= ids and len(ids) < 400
    bare = mixing.mixture(spark, docs, lab.limit(0), {"good": 1.0}).collect()
    assert len(bare) == len(ROWS) and {r.rate for r in bare} == {1.0}
    assert len(mixing.mixture(spark, docs, lab, {"good": 0.9, "junk": 0.1}).collect()) == len(ROWS)
    assert mixing.mixture(spark, none, lab, {"good": 1.0}).count() == 0


def test_thin_meets_weights_where_junk_prevails(spark):
    from sigmesh.llm import mixing
    rng = np.random.default_rng(9)
    data, labels = [], []
    for i in range(3000):
        junk = i % 5 < 3
        words = [("zz%%%" if junk else "plain") + str(rng.integers(0, 50)) for _ in range(int(rng.integers(20, 40)))]
        data.append((i, " ".join(words), "c", 0, []))
        labels.append((i, "junk" if junk else "good"))
    lab = spark.createDataFrame(labels, "doc_id long, domain string")
    kept = mixing.thin(spark, spark.createDataFrame(data, SCHEMA).repartition(3), lab, {"good": 0.92, "junk": 0.08}).collect()
    size = Counter()
    for r in kept:
        size[r.doc_id % 5 < 3] += len(r.text.split())
    assert abs(size[True] / (size[True] + size[False]) - 0.08) < 0.02
    assert {i for i in range(3000) if i % 5 >= 3} <= {r.doc_id for r in kept}


def test_rates_of_rare_domains(spark):
    from sigmesh.llm import mixing
    rng = np.random.default_rng(7)
    goal = {"good": 0.9, "junk": 0.06, "toxic": 0.04}
    for rare in (0.01, 0.001):
        y = rng.choice(3, 8000, p=[0.9 - rare, 0.1, rare])
        z = 8 * np.eye(3)[y] + rng.normal(size=(8000, 3))
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)  # soft posteriors
        data = [(int(n), *map(float, x)) for n, x in zip(rng.integers(1, 500, 8000), p)]
        df = spark.createDataFrame(data, "n_tokens long, p0 double, p1 double, p2 double")
        rate, totals = mixing.fit_rates(df, list(goal), goal)
        got = df.withColumn("r", rate).toPandas()
        n = got.n_tokens.sum()
        for k, (d, share) in enumerate(goal.items()):
            assert abs((got.n_tokens * got.r * got[f"p{k}"]).sum() / n / share - 1) < 1e-3 and abs(totals[d] / n / share - 1) < 1e-3
        assert (got.r >= 0).all()
    # no document holds enough of the target: the nearest rates, with a warning and what remains
    flat = spark.createDataFrame([(10, 0.5, 0.4, 0.1), (30, 0.6, 0.3, 0.1)], df.schema)
    with pytest.warns(UserWarning, match="targets not met"):
        rate, totals = mixing.fit_rates(flat, list(goal), goal)
    row = flat.select("p0", rate)
    off = row.schema["rate"].metadata["off_target"]
    assert set(off) == set(goal) and off["good"] < 0 < off["junk"] and abs(totals["good"] / 40 - 0.9 - off["good"]) < 1e-9
    # nearest of all: only the second kind, at the rate of its projection
    assert {r.p0: round(r.rate, 2) for r in row.collect()} == {0.5: 0.0, 0.6: round(0.562 / 0.46 / 0.75, 2)}


def test_toxicity_held_out(spark, docs, none):
    from sigmesh.llm import toxicity
    rng = np.random.default_rng(4)
    bad = ["vilea", "vileb", "vilec", "rotten"]
    data, labels = [], []
    for i in range(1500):
        w = ["the"] + [f"t{rng.integers(0, 400)}" for _ in range(int(rng.integers(5, 40)))]
        toxic = i % 6 == 0
        for _ in range(2 * toxic):
            w.insert(int(rng.integers(0, len(w))), bad[int(rng.integers(0, 4))])
        data.append((i, " ".join(w), "c", 0, []))
        labels.append((i, 1, int(toxic)))
    df = spark.createDataFrame(data, SCHEMA)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    clf = toxicity.fit(df, lab)
    got = {r.doc_id: r for r in toxicity.score(spark, df, clf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(i, r) for i, r in got.items() if r.held_out]
    right = sum(r.predicted == (i % 6 == 0) for i, r in held)
    assert right >= 0.97 * len(held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    left = toxicity.reject(spark, df, clf)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.score(spark, docs, clf).count() == len(ROWS) and toxicity.score(spark, none, clf).count() == 0
    blank = toxicity.fit(none, lab)
    assert all(r.predicted == 0 for r in toxicity.score(spark, docs, blank).collect())


def test_pipeline_stages(spark):
    import __spark_entry__ as entry
    import corpus_pipeline
    from conftest import SF001
    assert "pipeline" in entry.queries() and sorted(n for n in entry.queries() if n.startswith("op")) == sorted(
        f.__name__ for f in entry.LLM_QUERIES.values())
    documents = spark.read.parquet(f"{SF001}/documents.parquet")
    docs, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF001).cache()
        assert docs.columns == documents.columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < documents.count()

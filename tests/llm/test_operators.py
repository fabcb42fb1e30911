"""Each operator against brute force or a round trip, with the cases that its docstring defines."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from vocabspark.llm import bpe_tree, decontaminate, html_main, induced, katz, links, ngram_join, paragraph_dedup
from vocabspark.llm import pii, queries, suffix_dedup, toxicity, winnow
from vocabspark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, score double, keys string"
ALPHABET = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(["alpha", "Beta", "gámma", "delta", "eps", "zeta", "eta", "theta"]) + str(rnd.randrange(60)) for _ in range(words))


@pytest.fixture(scope="session")
def rows():
    """Documents with copies, near copies, shared passages, and every odd case."""
    out = [(i, _prose(i, 40 + i)) for i in range(12)]
    long = _prose(99, 3000)
    shared = _prose(77, 60)
    out += [(20, out[3][1]), (21, out[3][1]), (22, out[4][1] + " end"), (23, out[5][1].upper())]
    out += [(30, long), (31, long.replace(" ", "  ", 1)), (32, long[:-9])]
    out += [(40 + j, f"{_prose(200 + j, 30)} {shared} {_prose(300 + j, 30)}\nlast line {j}") for j in range(4)]
    out += [(50, ""), (51, None), (52, " \n\t "), (53, "one"), (54, "one two"), (55, "one two"), (56, "漢字 かな 漢字"), (57, "a" * 500)]
    out += [(None, out[3][1]), (None, None), (20, out[3][1]), (9, "another text of nine")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(i, t, None if k % 3 else "en", "s", len(t or ""), "x", 7, 0.5, "k") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ALPHABET))
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def joined(rows, k, num, den):
    """Component and number of linked documents of each distinct (id, set)."""
    nodes = {(i, shingles(t, k)) for i, t in rows if i is not None}
    nodes = [n for n in nodes if n[1]]
    parent, degree = {n: n for n in nodes}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_set = defaultdict(set)
    for i, s in nodes:
        by_set[s].add(i)
    for x in nodes:
        for y in nodes:
            if x != y and den * len(x[1] & y[1]) >= num * len(x[1] | y[1]):
                parent[root(x)] = root(y)
                degree[x] += 1
    least = {}
    for n in nodes:
        least[root(n)] = min(least.get(root(n), n[0]), n[0])
    return {n: (least[root(n)], degree[n]) for n in nodes}


@pytest.mark.parametrize("hot", [1, 32])
def test_ngram_join(docs, rows, empty, monkeypatch, hot):
    monkeypatch.setattr(links, "HOT", hot)
    monkeypatch.setattr(links, "BLOCK_SETS", 2)
    monkeypatch.setattr(ngram_join, "COMBINED_CLASS", 1)
    want = joined(rows, 3, 90, 100)
    expected = Counter(
        (i, len(s := shingles(t, 3)), *(want[i, s] if s and i is not None else (i, 0))) for i, t in rows
    )
    assert Counter(map(tuple, ngram_join.join(docs, 3, 90, 100).collect())) == expected
    assert ngram_join.join(empty).collect() == []


def test_index_keys_meet_whatever_the_order():
    rnd = np.random.default_rng(3)
    for size in (2, 9, 40, 470, 560, 700):
        for _ in range(20):
            x = np.unique(rnd.integers(0, 1 << 60, size).astype(np.uint64))
            y = np.unique(np.concatenate([x[int(0.05 * len(x)) :], rnd.integers(0, 1 << 60, int(0.04 * size)).astype(np.uint64)]))
            cls = {int(t): int(c) for t, c in zip(np.union1d(x, y), rnd.integers(0, 9, len(x) + size))}
            of = [np.array([cls[int(t)] for t in s], np.uint8) for s in (x, y)]
            if 100 * len(np.intersect1d(x, y)) < 90 * len(np.union1d(x, y)) or (len(x) == len(y) and (x == y).all()):
                continue
            keys = [set(ngram_join.index_keys(s, c, 90, 100).tolist()) for s, c in zip((x, y), of)]
            assert keys[0] & keys[1]
            (p, least), (q, other) = (ngram_join.probe_of(s, c, 90, 100) for s, c in zip((x, y), of))
            assert len(np.intersect1d(p, q)) >= min(least, other)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 500), (500, 100), (7, 7), (900, 800), (900, 700)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 500: 100, 900: 700, 800: 700, 700: 700}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_decontamination(spark, docs, rows, empty):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    bench = [(1, rows[2][1][30:200]), (2, "one two"), (3, "..."), (4, None), (None, rows[1][1]), (5, rows[6][1]), (5, "漢字"), (6, rows[6][1])]
    table = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, doc_id string")
    windows = defaultdict(set)
    for i, t in bench:
        w = word.findall((t or "").translate(ALPHABET))
        for j in range(max(1, len(w) - 12) if w and i is not None else 0):
            windows[tuple(w[j : j + 13])].add(i)
    expected = Counter()
    for i, t in rows:
        w = word.findall((t or "").translate(ALPHABET))
        hit, items = set(), set()
        for win, names in windows.items():
            for j in range(len(w) - len(win) + 1):
                if tuple(w[j : j + len(win)]) == win:
                    hit |= set(range(j, j + len(win)))
                    items |= names
        expected[i, len(w), len(hit), tuple(sorted(items)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    found = decontaminate.contaminated(docs, table).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in found) == expected
    assert all(sum(s.end - s.start for s in r.hit_spans) == r.n_hit for r in found)
    assert decontaminate.contaminated(empty, table).collect() == []
    assert not any(r.n_hit for r in decontaminate.contaminated(docs, table.limit(0)).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "a b c d"), (3, "a y y y b c d")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    exact = {r.doc_id: r.n_hit > 0 for r in decontaminate.contaminated(docs, bench, width=4).collect()}
    near = {r.doc_id: r.n_hit > 0 for r in decontaminate.contaminated(docs, bench, width=4, slop=1).collect()}
    assert exact == {1: False, 2: True, 3: False} and near == {1: True, 2: True, 3: False}


def test_paragraphs(docs, rows, empty):
    found = paragraph_dedup.repeats(docs).collect()
    assert {r.doc_id for r in found if r.doc_id in (40, 41, 42, 43)} == {40, 41, 42, 43}  # a passage inside lines
    assert any(r.removed for r in found if r.doc_id == 21) and any(r.removed for r in found if r.doc_id == 22)
    text = {i: t for i, t in rows if i != 9}
    for r in found:
        if r.doc_id == 9:
            continue
        assert (r.kept_id < r.doc_id) or not r.removed or r.kept_id == r.doc_id
        assert len(text[r.doc_id][r.start : r.end].split()) == r.n_words
    assert not {50, 51, 52, 53, None} & {r.doc_id for r in found}
    assert paragraph_dedup.repeats(empty).collect() == []
    assert paragraph_dedup.bands_for(0.8) == 7


def test_winnow_guarantee_and_order(docs, rows, empty):
    found = winnow.against_next(docs).collect()
    assert len(found) == len(rows)
    assert winnow.against_next(empty).collect() == []
    plain = {(r.doc_id, r.n_chars): r for r in found}
    order = sorted({(i, t or "") for i, t in rows if i not in (None, 20, 9)})
    for (i, t), (j, nxt) in zip(order, order[1:]):
        if {20, 9} & set(range(i, j + 1)):
            continue
        q = len(t) // 4
        assert plain[i, len(t)].edited == t[: len(t) - q] + nxt[:q]
    by_text = defaultdict(set)
    for r in winnow.fingerprints(docs).collect():
        by_text[{i: t for i, t in rows}.get(r.doc_id)].add(r.fingerprint) if r.doc_id not in (None, 9) else None
    assert all(len(v) == 1 for v in by_text.values())
    entries = {r.doc_id: {e >> 32 for e in r.entries} for r in winnow.fingerprints(docs).collect() if r.doc_id}
    assert entries[40] & entries[41] and entries[50] == set()


def test_winnow_picks_rightmost_minimum(spark):
    text = _prose(5, 80)
    df = winnow.with_winnow(spark.createDataFrame([(text + " " + text,)], "text string"), "text", "w")
    packed = df.first().w
    tokens = (text + " " + text).lower().split()
    hashes = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string").select("i", F.xxhash64("t").alias("h"))
    h = [r.h for r in hashes.orderBy("i").collect()]
    triples = spark.createDataFrame([(i, *h[i : i + 3]) for i in range(len(h) - 2)], "i int, a long, b long, c long")
    g = [r.g >> 33 for r in triples.select("i", F.xxhash64("a", "b", "c").bitwiseAND(F.lit(-1)).alias("s"), F.shiftrightunsigned(F.xxhash64("a", "b", "c"), 0).alias("g")).orderBy("i").collect()]
    g = [x & ((1 << 31) - 1) for x in g]
    want = set()
    for s in range(len(g) - winnow.WINDOW + 1):
        window = g[s : s + winnow.WINDOW]
        want.add(s + max(k for k, x in enumerate(window) if x == min(window)))
    assert [((1 << 32) - 1) - (p & ((1 << 32) - 1)) for p in packed] == sorted(want)


@pytest.mark.parametrize("words", [8, 1 << 20])
def test_katz_sums_to_one_and_matches_definition(docs, rows, empty, monkeypatch, words):
    monkeypatch.setattr(katz, "TABLE_WORDS", words)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 500)
    known = [(i, t) for i, t in rows]
    learns = F.col("doc_id") % 4 != 0
    out = katz.score(docs, learns).collect()
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ALPHABET))
    training = [split(t) for i, t in known if i is not None and i % 4]
    count = Counter(w for t in training for w in t)
    ends = len(training)
    total = sum(count.values()) + ends
    distinct = len(count) + 1
    expected = Counter()
    for i, t in known:
        c = [count[w] for w in split(t)] + [ends]
        base = sum(np.log10((x + 0.1) / (total + 0.1 * (distinct + 1))) for x in c)
        expected[i, i is not None and i % 4 != 0, len(c), sum(x > 0 for x in c), total, round(base, 6)] += 1
    got = Counter((r.doc_id, r.learned, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert got == expected
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)
    assert katz.score(empty, learns).collect() == []
    assert len(katz.score(docs, F.lit(False)).collect()) == len(rows)


def test_marginals_match_enumeration():
    rnd = np.random.default_rng(1)
    emission, moves, bounds = rnd.normal(size=9), rnd.normal(size=(2, 2)), np.array([0, 4, 5, 9])
    p, expected, log_z = toxicity.marginals(emission, moves, bounds)
    weight, total_moves, want = 0.0, np.zeros((2, 2)), np.zeros(9)
    for a, b in zip(bounds, bounds[1:]):
        z, m, mv = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for code in range(1 << (b - a)):
            y = [(code >> k) & 1 for k in range(b - a)]
            s = np.exp(sum(emission[a + k] * y[k] for k in range(b - a)) + sum(moves[y[k], y[k + 1]] for k in range(b - a - 1)))
            z += s
            m += s * np.array(y)
            for k in range(b - a - 1):
                mv[y[k], y[k + 1]] += s
        want[a:b] = m / z
        total_moves += mv / z
        weight += np.log(z)
    assert np.allclose(p, want) and np.allclose(expected, total_moves) and np.isclose(log_z, weight)


def test_toxicity_on_held_out(spark, empty):
    rnd = random.Random(4)
    bad = ["vilething", "vilestuff", "nastyword"]
    data = [(i, _prose(i, 60) + (" " + rnd.choice(bad) if i % 5 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame([*data, (None, "vilething"), (901, None), (902, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(1, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all((out[i].score >= 0.7) == (i % 5 == 0) for i in range(300))
    text = dict(data)
    assert all(text[i][s.start : s.end] in bad for i in range(0, 300, 5) for s in out[i].spans)
    assert out[901].score == out[902].score < 0.5
    assert toxicity.score(empty, model).collect() == []
    unlabelled = toxicity.learn(docs, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, unlabelled).collect())


def test_suffix_array_against_sorting():
    rnd = random.Random(2)
    for trial in range(60):
        strings = [bytes(rnd.choice(b"ab\x00" if trial % 2 else b"abcdef") for _ in range(rnd.randrange(0, 50))) for _ in range(4)]
        symbols, _ = induced.concatenated(strings)
        listed = symbols.tolist()
        want = sorted(range(len(listed)), key=lambda i: listed[i:])
        assert induced.suffix_array(symbols, 1000).tolist() == want
        shallow = [listed[i : i + 6] for i in induced.suffix_array(symbols, 6)]
        assert shallow == sorted(shallow)


@pytest.mark.parametrize("crowd", [1, 5000])
def test_suffix_dedup(docs, rows, empty, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "SHARD_PIECES", crowd)
    first = {}
    for i, t in rows:
        raw, i = (t or "").encode(), 1 << 62 if i is None else i
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(first.get(raw[p : p + 50], i), i)
    expected = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            gone[p : p + 50] |= first[raw[p : p + 50]] < (1 << 62 if i is None else i)
        expected[i, len(raw), int(gone.sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes()] += 1
    found = suffix_dedup.repeated_spans(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), bytes(r.kept)) for r in found) == expected
    assert suffix_dedup.repeated_spans(empty).collect() == []


def test_html(spark):
    page = (
        "<html><head><title>t</title></head><body><nav><a href=/>menu</a></nav><div class='ad x'>buy</div><{0}><h1>A &amp; B</h1>"
        "<p>one <b>two<br>three<p>four &lt;5&gt;<script>var p='</p>'</script><ul><li>x<li>y</ul><form>f</form>"
        "<div class='comments'><p>reader</p></div></{0}><aside>side</aside><footer>foot</footer></body></html>"
    )
    rows = [(1, "http://H.example/a", page.format("article")), (2, "https://h.example:80/b", page.format("article")), (3, None, None)]
    rows += [(4, "x", ""), (5, "http://other/", page.format("section")), (5, "http://other/", "plain text"), (None, "http://q", "<p>p")]
    out = [tuple(r) for r in html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    text = "A & B\none two three\nfour <5>\nx\ny"
    assert Counter(out) == Counter(
        [(1, rows[0][1], text), (2, rows[1][1], text), (3, None, ""), (4, "x", ""), (5, "http://other/", text), (5, "http://other/", "plain text"), (None, "http://q", "p")]
    )
    assert html_main.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.fixture(scope="session")
def ranks():
    return bpe_tree.read_ranks(None, public_tokenizers.path(queries.TOKENIZER))


def test_bpe_round_trip(docs, rows, empty, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe_tree.encode(docs, ranks, public_tokenizers.PATTERN)
    got = Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in bpe_tree.decode(encoded, ranks).collect())
    assert got == Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert bpe_tree.encode(empty, ranks, public_tokenizers.PATTERN).collect() == []


def test_bpe_tree_on_hard_pieces(ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe_tree.Encoder(ranks, public_tokenizers.PATTERN, bpe_tree.mergeable(ranks))
    rnd = random.Random(6)
    for size in (1, 33, 200, 2000):
        for letters in ("a", "ab", "thinger", "éa", "漢字語", "= -", "\n \t"):
            text = "".join(rnd.choice(letters) for _ in range(size))
            assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_bpe_leaves_side_by_side(ranks):
    """Many matches of a chunk at once, forgetting in between, and a vocabulary without mergeable pairs."""
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe_tree.Encoder(ranks, public_tokenizers.PATTERN, bpe_tree.mergeable(ranks))
    rnd = random.Random(7)
    for _ in range(3):
        texts = ["".join(rnd.choice("aabeht \n\té漢0x😀") for _ in range(rnd.randrange(300))) for _ in range(400)] + [None, ""]
        assert [ids.tolist() for ids in encoder.encode(texts)] == [library.encode_ordinary(t or "") for t in texts]
        encoder.pieces |= {str(i): [0] for i in range(bpe_tree.REMEMBERED)}  # the next chunk finds it full
    plain = {bytes([b]): b for b in range(256)}
    alone = bpe_tree.Encoder(plain, public_tokenizers.PATTERN, bpe_tree.mergeable(plain))
    assert bytes(alone.encode(["hé, 12"])[0].tolist()) == "hé, 12".encode()
    assert alone.encode([]) == []


def test_pii(docs, rows, empty):
    base = {
        "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
        "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
    }

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) < 256 for x in m.split("."))
        if kind == "card":
            s = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
            return 12 <= len(d) <= 19 and s % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    rnd = random.Random(8)
    texts = ["".join(rnd.choice("a1.@-+ 9(é") for _ in range(rnd.randrange(60))) for _ in range(4000)]
    texts += ["4041894974608795 x 4041894974608796", "+1 (988) 555-2485 é a.b@c.de 1.2.3.4.5 300.1.1.1"]
    for text in texts:
        want = [(k, *m.span()) for k, rx in base.items() for m in rx.finditer(text) if valid(k, m[0])]
        assert sorted(want) == sorted(x[:3] for x in pii.find(text) if x[0] != "iban")
    account = "IBAN DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00"
    assert [x[:3] for x in pii.find(account) if x[0] == "iban"] == [("iban", 5, 32)]
    assert pii.find("call +1 (988) 555-2485")[0][3] > pii.find("+1 (988) 555-2485")[0][3]
    assert pii.redact("mail a.b@c.de now", 0.5) == "mail [EMAIL] now"
    assert pii.spans(docs).count() == len(rows) and pii.spans(empty).collect() == []


def test_pipeline_on_odd_rows(spark, docs, empty, sf):
    for start in (docs, empty):
        kept, before = start, start.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, kept, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == kept.columns
            assert out.count() <= before
            kept, before = out, out.count()
    groups = corpus_pipeline.jaccard_stage(spark, docs, sf)
    ids = [r.doc_id for r in groups.select("doc_id").collect()]
    assert 3 in ids and not {20, 21, 22, 31, 32} & set(ids) and {50, 51, 52, 53, 57} <= set(ids) and ids.count(None) == 2


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_every_row(spark, sf, name):
    out = queries.QUERIES[name](spark, sf)
    source = "pages" if name.startswith("op8") else "documents"
    if name.startswith("op3"):
        assert out.where("removed").count() > 0
    else:
        assert out.count() == queries.table(spark, sf, source).count()


def test_digests(spark, sf):
    found = queries.op9_byte_bpe(spark, sf).join(queries.table(spark, sf, "documents"), "doc_id")
    for r in found.select("text", "decoded_sha256").limit(20).collect():
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.decoded_sha256

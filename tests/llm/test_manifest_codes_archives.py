"""Merkle manifest, vector codes and archives against brute force, with every case their docstrings define."""

import gzip
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabspark.llm import merkle, metric_tree, queries, vector_codes, warc
from vocabspark.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, path string, tree long, key int"


def saved(spark, tmp_path, name, df):
    df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


# --- Merkle manifest ------------------------------------------------------------------------------


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(digests):
    """Root of a list of leaves, and the siblings (before, after) of each leaf by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for path, i in zip(paths, at):
            run = digests[i // 8 * 8 : i // 8 * 8 + 8]
            path.append((run[: i % 8], run[i % 8 + 1 :]))
        at = [i // 8 for i in at]
        digests = [h("".join(digests[i : i + 8])) for i in range(0, len(digests), 8)]
    return digests[0], paths


def manifest(rows):
    """Rows of the contract, by definition."""
    leaf = lambda r, text: h("".join(map(told, (r[0], r[3], r[2], r[4], text))))
    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = [grown([leaf(r, r[1]) for r in langs[lang]]) for lang in order]
    root, tops = grown([subroot for subroot, _ in trees])
    out = []
    for lang, (subroot, paths), top in zip(order, trees, tops):
        for r, path in zip(langs[lang], paths):
            own = x = leaf(r, r[1])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                x = leaf(r, r[1] and r[1].translate(LOWER))
            for before, after in path + top:
                x = h("".join([*before, x, *after]))
            proof = h("".join("".join(a + b) for a, b in path + top))
            out.append((r[0], own, subroot, root, proof, x, x == root))
    return Counter(out)


def odd_rows(n, langs, seed=1):
    rnd = random.Random(seed)
    rows = [(i, f"Text {i} gámma", rnd.choice(langs), "s", i, "d", "p", 3, 4) for i in range(n)]
    rows += [(None, "No id", "en", None, None, None, None, None, None), (None, None, "en", "s", 0, "d", "p", 1, 2)]
    rows += [(3, "", "de", "s", 0, "d", "p", 1, 2), (7, "A" * 200_000 + "é", "zz", "s", 9, "d", "p", 1, 2)]
    rows += [(9, "Same ROW", "fr", "s", 1, "d", "p", 1, 2)] * 3 + [(9, "same row", "fr", "s", 1, "d", "p", 1, 2)]
    return rows


@pytest.mark.parametrize("n, langs, block", [(0, ["en"], 100), (90, ["en", "é", "", None], 7), (700, ["en"], 100), (40, [f"l{i}" for i in range(30)], 3)])
def test_manifest(spark, tmp_path, monkeypatch, n, langs, block):
    monkeypatch.setattr(merkle, "BLOCK_ROWS", block)
    rows = odd_rows(n, langs)
    folder = saved(spark, tmp_path, "documents", spark.createDataFrame(rows, DOCS).repartition(3))
    got = Counter(map(tuple, queries.op11_merkle_manifest(spark, folder).collect()))
    assert got == manifest(rows)


def test_manifest_of_one_row_and_of_none(spark, tmp_path):
    one = [(5, "ABC", None, "s", 3, "d", "p", 1, 2)]
    folder = saved(spark, tmp_path, "documents", spark.createDataFrame(one, DOCS))
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, folder).collect()]
    assert Counter(got) == manifest(one) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")
    none = saved(spark, tmp_path / "none", "documents", spark.createDataFrame([], DOCS))
    assert queries.op11_merkle_manifest(spark, none).collect() == []


# --- vector codes ---------------------------------------------------------------------------------


def coded(rows):
    """(vec_id, code, error, label_error) rows and codebooks, by comparing every part with every entry."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    divided = [r for r in good if r[1] and len(r[1]) % 8 == 0]
    length = len(divided[0][1]) if divided else -1
    kept = [r for r in good if len(r[1]) == length]
    x = np.floor(np.array([r[1] for r in kept], float).reshape(len(kept), max(length, 0)) * 4096).astype(np.int64)
    parts = x.reshape(len(kept), 8, -1)
    books = parts[:16].transpose(1, 0, 2).copy()

    def near():
        d = ((parts[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(6 if kept else 0):
        best, _ = near()
        for p in range(8):
            for e in range(books.shape[1]):
                if (best[:, p] == e).any():
                    books[p, e] = parts[best[:, p] == e, p].sum(0) // (best[:, p] == e).sum()
    out, total = [], Counter()
    if kept:
        best, d = near()
        for r, b, e in zip(kept, best, d.sum(1).tolist()):
            total[r[2]] += e
        out = [(r[0], "".join(f"{i:02x}" for i in b), e, total[r[2]]) for r, b, e in zip(kept, best, d.sum(1).tolist())]
    out += [(r[0], None, None, None) for r in good if len(r[1]) != length]
    listed = ",".join(map(str, books.ravel().tolist()))
    return Counter((*r, hashlib.sha256(listed.encode()).hexdigest()) for r in out)


def vectors(n, width, seed=3):
    rnd = np.random.default_rng(seed)
    middles = rnd.normal(size=(7, width))
    rows = [
        (i, [float(v) for v in np.float32(middles[i % 7] * 0.3 + rnd.normal(size=width) * rnd.choice([0.0, 0.01, 0.3]))], int(i % 5), "e")
        for i in range(n)
    ]
    return rows


ODD_VECTORS = [
    (None, [0.5] * 16, None, "e"), (4, [0.25] * 16, None, "e"), (4, [0.25] * 16, 1, "e"), (200, None, 1, "e"), (201, [], 1, "e"),
    (202, [math.nan] + [0.0] * 15, 1, "e"), (203, [math.inf] * 16, 2, "e"), (204, [None] + [0.0] * 15, 2, "e"), (205, [0.1] * 24, 2, "e"),
]
VECTORS = "vec_id long, embedding array<float>, label int, chunk string"


@pytest.mark.parametrize("n, leaf", [(0, 48), (5, 48), (400, 1), (400, 6), (400, 48), (1500, 48)])
def test_vector_codes(spark, tmp_path, monkeypatch, n, leaf):
    monkeypatch.setattr(metric_tree, "LEAF_POINTS", leaf)
    monkeypatch.setattr(vector_codes, "CHUNK_ROWS", 333)
    rows = [*vectors(n, 16), *ODD_VECTORS]
    rows += [(1000 + i, rows[0][1], 0, "e") for i in range(300)]  # one very common vector
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    folder = saved(spark, tmp_path, "embeddings", df)
    exact = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = Counter(map(tuple, queries.op12_vector_codes(spark, folder).collect()))
    assert got == coded(exact)


def test_vector_codes_without_vectors(spark, tmp_path):
    for name, rows in (("none", []), ("bad", [(1, None, 1, "e"), (2, [math.nan] * 8, 1, "e")])):
        folder = saved(spark, tmp_path / name, "embeddings", spark.createDataFrame(rows, VECTORS))
        assert queries.op12_vector_codes(spark, folder).collect() == []


def test_too_large_components_are_an_error():
    with pytest.raises(ValueError, match="62 bits"):
        vector_codes.whole_numbers(np.full((2, 16), 1e12), 4096)


def test_tree_holds_every_point_once_inside_its_balls():
    rnd = np.random.default_rng(5)
    points = np.concatenate([rnd.integers(-999, 999, (700, 3)), np.zeros((300, 3), int), np.arange(900).reshape(300, 3)])
    tree = metric_tree.build(points)
    assert sorted(tree.order.tolist()) == list(range(1300)) and (points[tree.order] == tree.points).all()
    for f, n, c, r, s, left, right in zip(tree.first, tree.count, tree.centre, tree.radius, tree.sums, tree.left, tree.right):
        own = tree.points[f : f + n]
        assert (own.sum(0) == s).all() and np.sqrt(((own - c) ** 2).sum(1)).max() <= r * (1 + 1e-12)
        if left >= 0:
            assert tree.first[left] == f and tree.count[left] + tree.count[right] == n


def test_balls_are_owned_whole():
    """Far apart heaps are handed out as balls: hardly any point is compared."""
    rnd = np.random.default_rng(6)
    heaps = rnd.integers(-100_000, 100_000, (16, 4))
    points = np.repeat(heaps, 250, axis=0) + rnd.integers(-50, 50, (4000, 4))
    compared = []
    metric_tree.assign(metric_tree.build(points), heaps, lambda *_: None, lambda places, _: compared.extend(places))
    assert len(compared) < 100


# --- archives -------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, member string, same string"


def pages():
    long, other = "<p>größe " + "x" * 2000, "<p>" + "y" * 997
    rows = [(i, f"http://h/{i}", f"<p>page {i}" * (i % 40), "m", "s") for i in range(120)]
    rows += [(200 + i, f"http://c/{i}", long, "m", "s") for i in range(30)]
    rows += [(300, None, other, "m", "s"), (301, "", other, None, None), (301, "http://t", other, "m", "s"), (302, "http://a b\r\nx: y", other[:-1], "m", "s")]
    rows += [(400, "u", None, "m", "s"), (401, "u", "", "m", "s"), (402, "u", "é" * 499, "m", "s"), (403, "u", "é" * 499, "m", "s")]
    rows += [(None, "u", long, "m", "s"), (None, "v", "z" * 1500, "m", "s"), (None, "v", "z" * 1500, "m", "s")]
    rows += [(500, "big", "".join(map(str, range(300_000))), "m", "s"), (501, "u", "\0nul\r\n\r\nWARC/1.1\r\n", "m", "s")]
    return rows


def expected(rows):
    held = {}
    for page, _, html, *_ in rows:
        p = (html or "").encode()
        if len(p) >= 1000:
            held[p] = max(held.get(p, -math.inf), -math.inf if page is None else page)
    out = Counter()
    for page, _, html, *_ in rows:
        p = (html or "").encode()
        holder = held.get(p, -math.inf)
        revisit = holder != -math.inf and holder != page
        out[(page, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", holder if revisit else None)] += 1
    return out


def test_archives_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 13)
    folder = saved(spark, tmp_path, "pages", spark.createDataFrame(pages(), PAGES).repartition(3))
    assert Counter(map(tuple, queries.op13_warc(spark, folder).collect())) == expected(pages())


def test_empty_pages(spark, tmp_path):
    folder = saved(spark, tmp_path, "pages", spark.createDataFrame([], PAGES))
    assert queries.op13_warc(spark, folder).collect() == []


def test_archives_are_plain_gzip_members(spark):
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame(pages(), PAGES).repartition(2), path)
    files = spark.read.format("binaryFile").load(path).collect()
    text = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(pages())
    found = warc.read(spark, path).collect()
    assert {r.kind for r in found} == {"record"}
    urls = Counter(r.target_uri for r in found)
    assert urls["http://a%20b%0D%0Ax:%20y"] == 1 and urls[None] == 1 and urls[""] == 1
    stored = Counter(bytes(r.payload) for r in found if r.type == "response")
    assert set(stored) == {(html or "").encode() for _, _, html, *_ in pages()}
    assert all(r.payload is None for r in found if r.type == "revisit")


def archive(packed=True, n=40):
    """Records of an archive and where each begins."""
    parts = []
    for i in range(n):
        payload = f"<p>{i} ".encode() * (i * 7 + 1)
        whole = warc.record("response", i, f"http://x/{i}", hashlib.sha1(payload).digest(), warc.http_head(len(payload)) + payload, [], warc.NO_DATE)
        parts.append(gzip.compress(whole) if packed else whole)
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    return b"".join(parts), starts


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    data, starts = archive(packed)
    whole = list(warc.salvage(data))
    assert [(r["start"], r["end"]) for r in whole] == list(zip(starts, starts[1:]))
    rnd = random.Random(8)
    # Uncompressed, no digest covers the header: there, payloads are hit.
    places = range(len(data)) if packed else [e - 4 - rnd.randrange(1, r["payload_bytes"] + 1) for r, e in zip(whole, starts[1:])]
    for _ in range(60):
        hurt = bytearray(data)
        hit = sorted(rnd.sample(places, 3))
        for at in hit:
            hurt[at] ^= 1 << rnd.randrange(8)
        broken = {np.searchsorted(starts, at, "right") - 1 for at in hit}
        found = list(warc.salvage(bytes(hurt)))
        names = {int(r["record_id"][10:-1]) for r in found if r["kind"] == "record"}
        # A flipped bit that nothing checks (the time in a gzip header) leaves a record readable.
        assert names >= set(range(40)) - broken and (packed or names == set(range(40)) - broken)
        edges = [x for r in found for x in (r["start"], r["end"])]
        assert edges[0] == 0 and edges[-1] == len(data) and edges[1:-1:2] == edges[2::2]
        for r in found:
            if r["kind"] == "gap":
                assert any(r["start"] <= at < r["end"] for at in hit) and r["reason"]
            else:
                assert r["payload"] == f"<p>{int(r['target_uri'][9:])} ".encode() * (int(r["target_uri"][9:]) * 7 + 1)


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_of_cut_and_foreign_bytes(packed):
    data, starts = archive(packed, 5)
    ids = lambda d: [r.get("record_id") or (r["start"], r["end"]) for r in warc.salvage(d)]
    name = warc.record_name
    assert ids(data[: starts[3] + 9]) == [name(0), name(1), name(2), (starts[3], starts[3] + 9)]
    assert ids(data[: starts[1]] + b"\0" * 9 + data[starts[1] :]) == [*map(name, range(5))]
    junk = b"junk \x1f\x8b\x08 WARC/1.1\r\nContent-Length: 99999999\r\n\r\n"
    assert ids(junk + data) == [(0, len(junk)), *map(name, range(5))]
    assert ids(data[: starts[2]] + junk + data[starts[2] :]) == [name(0), name(1), (starts[2], starts[2] + len(junk)), name(2), name(3), name(4)]
    assert ids(b"") == [] and ids(b"\0\0") == [] and ids(b"x") == [(0, 1)]


def test_quarantine_log(spark, tmp_path):
    data, starts = archive(True, 6)
    hurt = bytearray(data)
    hurt[starts[2] + 30] ^= 255
    (tmp_path / "a.warc.gz").write_bytes(bytes(hurt))
    (tmp_path / "b.warc").write_bytes(archive(False, 3)[0])
    (tmp_path / "c.warc.gz").write_bytes(b"")
    found = warc.read(spark, str(tmp_path))
    assert sorted(r.page_id for r in warc.records(found).collect()) == [0, 0, 1, 1, 2, 3, 4, 5]
    log = warc.quarantine(found, scratch_path(spark, "gaps")).collect()
    assert [(r.start, r.end) for r in log] == [(starts[2], starts[3])] and log[0].path.endswith("a.warc.gz")


def test_foreign_digests_and_plain_records():
    block = b"software: x\r\n"
    plain = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Block-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    good = plain % (hashlib.sha1(block).hexdigest().upper().encode(), len(block), block)
    bad = plain % (b"0" * 40, len(block), block)
    kinds = [(r["kind"], r.get("reason")) for r in warc.salvage(good + bad + good)]
    assert kinds == [("record", None), ("gap", "block digest differs"), ("record", None)]
    assert next(warc.salvage(good))["payload"] == block


def test_columns_of_the_contract(spark, sf):
    names = {
        "op11_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        "op12_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
        "op13_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    }
    for name, columns in names.items():
        df = queries.QUERIES[name](spark, sf)
        assert df.columns == columns and df.where(F.col(columns[1]).isNull()).count() == 0

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabspark.llm import katz


def test_small_counts_in_one_number():
    """Counts that do not fit are dealt over several entries of one key; sums and lists stay."""
    rnd = np.random.default_rng(2)
    n = 60
    counts = {name: rnd.integers(0, 3, n) for name in katz._COUNTED}
    counts["h1"][5], counts["known"][5], counts["lost"][9], counts["far"][9] = 1000, 127, 300, 128
    target, key = np.sort(rnd.integers(0, 4, n)), np.arange(n) * 7 - 100
    value, base = rnd.random(n), rnd.random(n)
    lost = np.arange(counts["lost"].sum())
    far = np.arange(counts["far"].sum() * katz._SHAPE, dtype=float)
    table = katz._packed(target, key, counts, value, base, lost, far)
    assert table["target"].to_pylist() == sorted(set(target.tolist()))
    flat = {c: table[c].combine_chunks().flatten().to_numpy() for c in ("key", "counts", "value", "base", "lost", "far")}
    told = katz._counts_of(flat["counts"])
    place = np.searchsorted(key, flat["key"])
    for name, found in told.items():
        assert np.bincount(place, found, n).astype(int).tolist() == counts[name].tolist()
    assert np.allclose(np.bincount(place, flat["value"], n), value) and np.allclose(np.bincount(place, flat["base"], n), base)
    assert flat["lost"].tolist() == lost.tolist() and flat["far"].tolist() == far.tolist()
    assert np.repeat(place, told["lost"]).tolist() == np.repeat(np.arange(n), counts["lost"]).tolist()
    sizes = [sum(told["lost"][np.isin(flat["key"], row)]) for row in table["key"].to_pylist()]
    assert [len(row) for row in table["lost"].to_pylist()] == sizes


@pytest.mark.parametrize("bucket", [3, 1_000_000])
def test_many_buckets_give_the_same_scores(spark, monkeypatch, bucket):
    """Nearly a bucket a token, or one for all, with words beyond the table: the same scores, from one narrow row a target."""
    rnd = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in rnd.zipf(1.4, 40) % 50) for _ in range(40)] + ["long word " * 400, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = []
    stored = katz.stored

    def watched(df, name):
        names.append((name, df.columns))
        return stored(df, name)

    monkeypatch.setattr(katz, "stored", watched)
    learns = F.col("doc_id") % 5 != 0
    want = {r.doc_id: r for r in katz.score(docs, learns).collect()}
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
    monkeypatch.setattr(katz, "TABLE_WORDS", 8)
    got = {r.doc_id: r for r in katz.score(docs, learns).collect()}
    for n, row in want.items():
        assert (got[n].n_tokens, got[n].n_known) == (row.n_tokens, row.n_known)
        assert got[n].score == pytest.approx(row.score, abs=1e-9) and got[n].base_score == pytest.approx(row.base_score, abs=1e-9)
    parts = dict(names)["sums"]
    assert parts[: parts.index("context")] == ["target", "key", "counts", "value", "base", "lost", "far"]

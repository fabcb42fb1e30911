import random

import pytest
from pyspark.sql import functions as F

from vocabspark.llm import links, ngram_join, tables


@pytest.mark.parametrize("most", [1 << 27, 1 << 16])
def test_sieve_loses_nothing_that_is_wanted(spark, monkeypatch, most):
    """All wanted rows pass and nearly no others; a map that is too small lets more pass."""
    monkeypatch.setattr(tables, "MOST_SIEVE_BITS", most)
    rows = spark.range(-30_000, 30_000).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), F.lit("x").alias("text"))
    wanted = spark.range(-30_000, 30_000, 3).select(F.col("id").alias("key"))
    found = tables.sieved(rows, "id", wanted)
    assert found.schema == rows.schema
    assert found.join(wanted, found.id == wanted.key).count() == 20_000 - (7 in range(-30_000, 30_000, 3))
    assert found.where("id is null").count() == 0
    assert found.count() < (25_000 if most > 1 << 20 else 60_000)
    assert tables.sieved(rows, "id", wanted.limit(0)).count() == 0


def test_texts_that_meet_nothing_are_not_shuffled(spark, monkeypatch):
    """Two near copies among 300 documents of their own words: the others' texts and keys stay where they are read."""
    rnd = random.Random(4)
    words = [[f"w{rnd.randrange(10**9)}" for _ in range(60)] for _ in range(300)]
    words[1] = [*words[0][:-1], "other"]
    docs = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(words)], "doc_id long, text string")
    passed = []
    sieve = tables.sieved

    def watched(df, column, wanted):
        found = tables.stored(sieve(df, column, wanted), "watched")
        passed.append((df.columns, df.count(), found.count()))
        return found

    monkeypatch.setattr(ngram_join, "sieved", watched, raising=False)
    monkeypatch.setattr(links, "sieved", watched, raising=False)
    found = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.join(docs, k=3, num=8, den=10).collect()}
    assert found == {n: (0, 1) if n < 2 else (n, 0) for n in range(300)}
    assert [columns for columns, *_ in passed] == [["key", "id", "n"], ["id", "probe", "least"], ["id", "text"]]
    assert all(0 < kept <= total // 10 for _, total, kept in passed)


def test_links_of_repeated_rows(spark):
    """Copies of a set bring its keys again: they are one holder."""
    sets = {1: [1, 2, 3, 4], 2: [1, 2, 3, 4, 5], 3: [7, 8]}
    rows = [(key, n, len(s)) for n, s in sets.items() for key in s[:2] for _ in range(40)]
    keys = spark.createDataFrame(rows, "key long, id long, n long")
    whole = spark.createDataFrame([(n, len(s), 1, s) for n, s in sets.items()], "id long, n long, weight long, tokens array<long>")
    edges, degrees = links.links(keys, lambda ids: whole.join(ids, "id").select(whole.columns), 8, 10)
    assert [tuple(r) for r in edges.collect()] == [(1, 2)]
    assert {tuple(r) for r in degrees.collect()} == {(1, 1), (2, 1)}

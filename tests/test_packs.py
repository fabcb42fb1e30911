"""Packs of array elements: what is joined with a large table are a pack's different elements."""

import pyarrow as pa
from conftest import rows
from pyspark.sql import functions as F

from vocabspark.operators import encode as en
from vocabspark.operators import packs as pk
from vocabspark.operators.pretokenize import SplitSpec


def test_stretches_are_bounded_and_whole():
    lists = pa.array([[1, 2], None, [3], [4] * 9, [], [5, 6]])
    found = list(pk.stretches(lists, 3))
    assert [a for a, _ in found] == [0, *[b for _, b in found[:-1]]] and found[-1][1] == len(lists)
    assert found == [(0, 3), (3, 4), (4, 6)]
    assert list(pk.stretches(pa.array([], pa.list_(pa.int32())), 3)) == []


def test_a_pack_holds_each_element_once(spark):
    made = [(n, ["a", "b", "a"] * 50 if n % 3 else None if n % 2 else []) for n in range(60)]
    df = spark.createDataFrame(made, "_row long, words array<string>").coalesce(1)
    packs = pk.packed(df, F.col("words"))
    assert packs.keys().count() == 2 * packs.table.where("size(different) > 0").count() <= 2 * 60
    table = spark.createDataFrame([("a", [1]), ("b", [2, 3])], "key string, ids array<int>")
    got = {r._row: r.ids for r in pk.unpacked(packs, table, "ids", F.flatten).collect()}
    number = {"a": [1], "b": [2, 3]}
    assert got == {n: None if w is None else [i for x in w for i in number[x]] for n, w in made}


def test_large_vocabulary_is_joined_by_packs(spark, monkeypatch):
    """Places of pieces are never joined: a thousand equal words are one row, whatever the sizes of the packs."""
    rules = [(0, "a", "b", "ab"), (1, "ab", "c", "abc"), (2, "Ġ", "abc", "Ġabc")]
    merges = spark.createDataFrame(rules, "rank int, left string, right string, token string")
    names = ["a", "b", "c", "Ġ", "ab", "abc", "Ġabc"]
    tokens = [("<|s|>", 100, "special"), *[(t, i, "merge" if len(t) > 1 else "alphabet") for i, t in enumerate(names)]]
    vocab = en.Vocabulary(spark.createDataFrame(tokens, "token string, id int, kind string"), merges, SplitSpec())
    texts = [(1, " abc" * 1000), (1, "<|s|>cab ba<|s|>"), (None, "a" * 300 + "bc"), (2, ""), (3, None), (4, "x abc")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    joined = []
    join = en.skew_join
    monkeypatch.setattr(pk, "skew_join", lambda many, *rest: joined.append(many.count()) or join(many, *rest))
    near = rows(en.encode(docs, vocab).select("doc_id", "ids"))
    for pieces, substrings in ((4000, 200_000), (1, 10)):
        monkeypatch.setattr(en, "PACKED_PIECES", pieces)
        monkeypatch.setattr(en, "PACKED_TOKENS", substrings)
        assert rows(en.encode(docs, vocab, max_broadcast_rows=0).select("doc_id", "ids")) == near
    assert joined and max(joined) < 20


def test_dropout_by_stretches(spark, monkeypatch):
    """A piece none of whose merges is skipped is not merged again; rows are handled a few at a time."""
    merges = spark.createDataFrame([(0, "a", "b", "ab"), (1, "ab", "c", "abc")], "rank int, left string, right string, token string")
    tokens = [(t, i, "merge" if len(t) > 1 else "alphabet") for i, t in enumerate(["a", "b", "c", "Ġ", "ab", "abc"])]
    vocab = en.Vocabulary(spark.createDataFrame(tokens, "token string, id int, kind string"), merges)
    docs = spark.createDataFrame([(n, "abc" + " abc ab cab" * n if n else None) for n in range(9)], "doc_id long, text string")
    ranks = {("a", "b"): 0, ("ab", "c"): 1}
    ids = {t: i for t, i, _ in tokens}
    pieces = {n: ["abc", *["Ġabc", "Ġab", "Ġcab"] * n] for n in range(1, 9)}
    want = {
        n: [ids[t] for pos, p in enumerate(own) for t in en.merge_piece(list(p), ranks, en.draws(f"7:{n}:{pos}", 0.4))]
        for n, own in pieces.items()
    }
    got = {r.doc_id: r.ids for r in en.encode(docs.coalesce(1), vocab, dropout=0.4, seed=7).collect()}
    assert got == {0: None, **want}
    assert len({tuple(x) for x in want.values()}) == 8


def test_decoding_by_join_sends_a_pack_its_different_ids_once(spark, monkeypatch):
    tokens = spark.createDataFrame([("a", 0, "alphabet"), ("ê°", 1, "merge"), ("¤", 2, "alphabet")], "token string, id int, kind string")
    vocab = en.Vocabulary(tokens, spark.createDataFrame([], "rank int, left string, right string, token string"))
    lists = [(1, [0, 1, 2] * 500), (1, [None, 9, 1]), (None, []), (2, None)]
    docs = spark.createDataFrame(lists, "doc_id long, ids array<int>").coalesce(1)
    joined, join = [], pk.skew_join
    monkeypatch.setattr(pk, "skew_join", lambda many, *rest: joined.append(many.count()) or join(many, *rest))
    want = [(1, "a갤" * 500), (1, "�" * 3), (None, ""), (2, None)]
    for bound in (None, 0):
        got = rows(en.decode(docs, vocab, max_broadcast_rows=bound).select("doc_id", "decoded"))
        assert got == sorted(want, key=repr)
    assert joined == [5]


def test_places_of_a_pack_are_compressed(spark):
    """Lists of places come back as they were, nulls and empty ones too, and take a fraction of four bytes a place."""
    lists = pa.array([[0, 1, 2], None, [], [2] * 5000], pa.list_(pa.int32()))
    raw = pk.shut(lists)
    assert isinstance(raw, bytes) and len(raw) < 500
    assert pk.places(pa.array([raw, pk.shut(lists.slice(0, 1))], pa.binary())).to_pylist() == [lists.to_pylist(), [[0, 1, 2]]]
    assert pk.places(pa.array([], pa.binary())).to_pylist() == []
    df = spark.range(3).selectExpr("id as _row", "array(string(id), 'x') words")
    assert dict(pk.packed(df, F.col("words")).table.dtypes)["codes"] == "binary"


def test_rows_are_written_compressed(spark):
    """Rows get numbers and are stored once, as columns of which a join reads what it needs; odd tables are checkpointed."""
    df = spark.range(4).selectExpr("id", "repeat('text ', 1000) text")
    made = en._with_row(df)
    assert "FileScan parquet" in made.select("id")._jdf.queryExecution().toString()
    assert sorted(r.id for r in made.collect()) == [0, 1, 2, 3] and made.select("_row").distinct().count() == 4
    odd = en._with_row(df.selectExpr("id", "null nothing"))
    assert odd.count() == 4 and odd.columns == ["id", "nothing", "_row"]


def test_a_pack_reaches_over_batches(spark):
    """Small batches of one task share a pack, so that an element of all of them is joined once."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        df = spark.range(60, numPartitions=1).selectExpr("id as _row", "array('x', string(id % 3)) words")
        packs = pk.packed(df, F.col("words"))
        assert packs.table.count() == 1 and packs.keys().count() == 4
        table = spark.createDataFrame([(k, k * 2) for k in "x012"], "key string, twice string")
        got = {r._row: r.twice for r in pk.unpacked(packs, table, "twice", lambda c: F.array_join(c, "-")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {n: f"xx-{n % 3}{n % 3}" for n in range(60)}

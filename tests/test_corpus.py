import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vocabspark.operators import corpus
from vocabspark.operators.order import first_rows, with_running_index


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def test_blank(spark):
    df = texts(spark, ["", " \t\n", "　", None, "a", " a "])
    assert [r.doc_id for r in corpus.filter_blank(df).orderBy("doc_id").collect()] == [4, 5]


def test_length(spark):
    df = texts(spark, ["x" * 4095, "x" * 4096, "x" * 4097, None])
    assert corpus.filter_max_length(df).count() == 2
    assert corpus.filter_max_length(df, max_length=0).count() == 4


@pytest.mark.parametrize("by_threshold", [False, True])
def test_prefix_takes_the_whole_part(spark, by_threshold):
    df = spark.range(7).withColumnRenamed("id", "doc_id").repartition(3)
    bound = 0 if by_threshold else 100
    got = corpus.sample_prefix(df, 50, ["doc_id"], bound)
    assert [r[0] for r in got.orderBy("doc_id").collect()] == [0, 1, 2]
    assert corpus.sample_prefix(df, 0, ["doc_id"], bound).count() == 0
    assert corpus.sample_prefix(df, 100, ["doc_id"], bound).count() == 7


def test_threshold_on_two_keys(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"), F.lit("t").alias("t"))
    for k in (1, 50, 99, 100, 200):
        assert rows(first_rows(df, k, ["a", "b"], 0)) == rows(first_rows(df, k, ["a", "b"]))


def test_ties_and_nulls_at_any_threshold(spark):
    made = [(None, 1, "x"), (None, 2, "x"), (None, None, "b"), (1, None, "x"), (1, 2, "a"), (1, 2, "b"), (1, 2, "a"), (1, 2, None), (2, 0, "x")]
    made += [(3, 3, "same")] * 20 + [(3, None, "same"), (4, 4, "z")]
    first = lambda v: (v is not None, v or "") if isinstance(v, str) or v is None else (True, v)
    made.sort(key=lambda r: [(v is not None, v if v is not None else 0) for v in r[:2]] + [first(r[2])])
    df = spark.createDataFrame(random.Random(1).sample(made, len(made)), "a long, b long, c string").repartition(4)
    for k in (0, 1, 2, 5, 6, 7, 8, 9, 20, 29, 30, 31, 40):
        want = sorted(map(repr, made[:k]))
        for bound in (-1, 100):
            if k or bound > 0:
                assert sorted(repr(tuple(r)) for r in first_rows(df, k, ["a", "b"], bound).collect()) == want
    for k in (3, 12, 25):
        by_threshold = sorted(repr(tuple(r)) for r in first_rows(df, k, ["a"], -1).collect())
        assert by_threshold == sorted(repr(tuple(r)) for r in first_rows(df, k, ["a"]).collect())


def test_first_rows_with_a_map_and_a_nan(spark):
    df = spark.sql("SELECT id % 3 AS a, map('k', id) AS m, CASE WHEN id = 4 THEN double('NaN') ELSE double(id) END AS x FROM range(9)")
    for k in (2, 4, 5, 8):
        near, far = (sorted((r.a, repr(r.x)) for r in first_rows(df, k, ["a", "x"], b).collect()) for b in (100, -1))
        assert near == far and len(near) == k


def test_seeded_sample_does_not_depend_on_partitions(spark):
    df = spark.range(200).withColumnRenamed("id", "doc_id")
    one = rows(corpus.sample_shuffled(df.repartition(1), 20, 7, ["doc_id"]))
    many = rows(corpus.sample_shuffled(df.repartition(17), 20, 7, ["doc_id"], 0))
    other = rows(corpus.sample_shuffled(df, 20, 8, ["doc_id"]))
    assert one == many and len(one) == 40
    assert one != other and one != [(i,) for i in range(40)]


def test_shuffle_seed_zero_keeps_the_order(spark):
    df = spark.range(20).withColumnRenamed("id", "doc_id")
    assert corpus.shuffle(df, 0, ["doc_id"]) is df
    placed = corpus.shuffle(df.repartition(3), 3, ["doc_id"], "at").collect()
    assert [r.at for r in placed] == list(range(20)) and corpus.shuffle(df, 0, ["doc_id"], "at").first().at == 0
    assert [r.doc_id for r in placed] == [r[0] for r in corpus.shuffle(df, 3, ["doc_id"]).collect()]
    shuffled = [r[0] for r in corpus.shuffle(df, 3, ["doc_id"]).collect()]
    assert shuffled != list(range(20)) and sorted(shuffled) == list(range(20))


def test_take_and_profile(spark):
    df = texts(spark, ["b", "", "x" * 5000])
    assert [r.doc_id for r in corpus.take(df, 2, ["doc_id"]).collect()] == [0, 1]
    row = corpus.corpus_profile(df).first()
    assert (row.n_rows, row.n_short, row.n_not_blank, row.n_kept, row.chars_kept) == (3, 2, 2, 1, 1)


@pytest.mark.parametrize("parts", [1, 5])
def test_running_index(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(parts)
    got = with_running_index(df, [F.desc("v")], "pos", 10).collect()
    assert all(r.pos == 10 + 999 - r.v for r in got) and len(got) == 1000

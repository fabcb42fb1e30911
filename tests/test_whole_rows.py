"""Rows that share an id or have none go the same way whatever the size of the vocabulary or the sample."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vocabspark.operators import encode as en
from vocabspark.operators.order import first_rows
from vocabspark.plans.train import TrainOptions, train_vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(1, "one red hen"), (1, "two red hens"), (1, "two red hens"), (1, ""), (None, "no id here"), (None, "none here"), (2, None), (None, None)]
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def vocab(docs):
    return train_vocabulary(docs, TrainOptions(vocab_size=42 + 4 + 256 + 10 + 3, n_buffer=4, whitespace_reservation=4))


@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_encode_and_decode_by_row(docs, vocab, dropout):
    near = en.encode(docs, vocab, dropout=dropout, seed=5)
    far = en.encode(docs, vocab, dropout=dropout, seed=5, max_broadcast_rows=0)
    assert near.columns == far.columns
    assert rows(far) == rows(near)
    back = en.decode(near, vocab, max_broadcast_rows=0)
    assert rows(back) == rows(en.decode(near, vocab))
    assert back.where("not decoded <=> text").count() == 0


def test_first_rows_keep_null_keys_by_threshold(spark):
    made = [(None, 1), (None, 2), (1, None), (1, 2), (2, 0), (3, None)]
    df = spark.createDataFrame(made, "a long, b long").withColumn("c", F.lit("x"))
    for k in (4, 5):
        assert rows(first_rows(df, k, ["a", "b"], 0)) == rows(first_rows(df, k, ["a", "b"]))

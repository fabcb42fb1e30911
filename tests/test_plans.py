"""The physical plans are the ones meant: native text work, top-k, broadcast of fixed tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vocabspark.functions.splits import STEPS, apply_steps
from vocabspark.operators import corpus
from vocabspark.operators import pretokenize as pt
from vocabspark.operators import vocab as vo
from vocabspark.plans import queries as q


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", sorted(STEPS))
def test_steps_stay_out_of_python(spark, sf, step):
    df = q.documents(spark, sf).select(apply_steps(F.col("text"), [step]))
    assert "Python" not in plan(df) and "ArrowEval" not in plan(df)


def test_filters_reach_the_scan_and_columns_are_pruned(spark, sf):
    df = corpus.filter_blank(corpus.filter_max_length(q.documents(spark, sf))).select("text")
    text = plan(df)
    assert "Python" not in text
    assert "PushedFilters: [IsNotNull(text)" in text
    assert "ReadSchema: struct<text:string>" in text


def test_threshold_sample_pushes_its_key(spark, sf):
    df = corpus.sample_prefix(q.documents(spark, sf), 50, ["doc_id"], take_ordered_rows=0)
    assert "LessThanOrEqual(doc_id" in plan(df)


def test_piece_count_has_one_shuffle_after_partial_counts(spark, sf):
    text = plan(pt.count_pretokens(q.documents(spark, sf), ["byte_level"]))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_top_pieces_are_cut_before_the_window_shuffle(spark, sf):
    text = plan(q.top_pieces_by_lang(spark, sf))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_k_and_broadcast(spark):
    vocab = spark.createDataFrame([("a", -1.0)], "token string, logprob double")
    assert "TakeOrderedAndProject" in plan(vo.top_by_score(vocab, 5))
    assert "BroadcastHashJoin" in plan(vo.floor_bytes(vocab))


@pytest.mark.parametrize("name", ["pretoken_counts", "bpe_pair_counts", "order_by_length", "shuffle"])
def test_partitioning_does_not_change_results(spark, sf, name):
    seen, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = q.QUERIES[name](spark, sf)
            seen.append(rows(df.select(sorted(df.columns))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]

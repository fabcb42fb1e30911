"""Tokens of a list in texts, with a pattern and with hashes; no character is reserved."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vocabspark.functions import splits
from vocabspark.operators import encode as en
from vocabspark.operators import inventory as inv
from vocabspark.operators import matching as ma
from vocabspark.plans.train import TrainOptions, train_vocabulary

MARKED = ["a\ufdd0b c", "\ufdd0", "\ufdd0\ufdd0<|s|>\ufdd0", "x <|s|>\ufdd0<|s|> y", "\u0002a\u0003", ""]


def by_regex(text, tokens):
    pattern = "|".join(map(re.escape, sorted(tokens, key=lambda t: (-len(t), t))))
    out, at = [], 0
    for m in re.finditer(pattern, text):
        out += [(False, text[at : m.start()])] * (m.start() > at) + [(True, m[0])]
        at = m.end()
    return out + [(False, text[at:])] * (at < len(text))


@pytest.mark.parametrize("window", [3, 1 << 16])
@pytest.mark.parametrize("most", [0, 1000])
def test_leftmost_longest(spark, monkeypatch, most, window):
    monkeypatch.setattr(ma, "MATCH_WINDOW", window)
    rng = random.Random(4)
    tokens = sorted({"".join(rng.choice("ab.é😣") for _ in range(rng.randint(1, 5))) for _ in range(25)} | {"", "(a|b)*", "\ufdd0"})
    texts = ["".join(rng.choice("ab.é😣c\n") for _ in range(rng.randint(0, 40))) for _ in range(60)] + MARKED + ["(a|b)*" * 3]
    listed = spark.createDataFrame([(t,) for t in tokens], "token string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r.i: r.s for r in df.select("i", ma.segments(F.col("t"), listed, most).alias("s")).collect()}
    for i, text in enumerate(texts):
        assert [(s.added, s.text) for s in got[i]] in (by_regex(text, [t for t in tokens if t]), [(False, text)] if not text else [])
    assert got[len(texts)] is None


def test_a_million_tokens(spark):
    tokens = spark.range(1_000_000).select(F.concat(F.lit("<k"), F.col("id").cast("string"), F.lit(">")).alias("token"))
    text = "so <k7><k77> and <k999999><k1000000> or <k12"
    row = spark.createDataFrame([(text,)], "t string").select(ma.segments(F.col("t"), tokens).alias("s")).first()
    assert [s.text for s in row.s if s.added] == ["<k7>", "<k77>", "<k999999>"] and "".join(s.text for s in row.s) == text


def test_usage_with_hashes_equals_the_pattern(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = docs.select(F.explode(F.split("text", " ")).alias("token")).where("length(token) > 3").distinct().limit(300).persist()
    by_pattern = rows(inv.token_usage(docs, words))
    monkeypatch.setattr(ma, "PATTERN_TOKENS", 0)
    assert rows(inv.token_usage(docs, words)) == by_pattern


def test_long_gaps_and_matches_need_no_stack(spark):
    text = "é " * 400_000 + "!" * 400_000 + "word " * 200_000
    df = spark.createDataFrame([(text,)], "t string")
    for step in ("word_with_space", "scripts", "punctuation"):
        row = df.select(F.concat_ws("", splits.STEPS[step](F.col("t"))).alias("t")).first()
        assert row.t == text


@pytest.mark.parametrize("model, most", [("bpe", 1000), ("bpe", 0), ("unigram", 1000)])
def test_reserved_characters_come_back(spark, monkeypatch, model, most):
    monkeypatch.setattr(ma, "PATTERN_TOKENS", most)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(MARKED * 3)], "doc_id long, text string")
    size = 42 + 4 + 256 + 6 if model == "bpe" else 42 + 4 + 256 + 10
    vocab = train_vocabulary(docs, TrainOptions(model=model, vocab_size=size, n_buffer=4))
    near = en.encode(docs, vocab)
    assert rows(near) == rows(en.encode(docs, vocab, max_broadcast_rows=0))
    for bound in (None, 0):
        assert en.decode(near, vocab, max_broadcast_rows=bound).where("not decoded <=> text").count() == 0
    s_id = vocab.tokens.where("token = '<|s|>'").first().id
    assert near.where(F.array_contains("ids", s_id)).count() == 6


def test_word_with_space_keeps_every_character(spark):
    df = spark.createDataFrame([(t,) for t in MARKED], "t string")
    got = df.select("t", splits.split_word_with_space(F.col("t")).alias("p")).collect()
    assert all("".join(r.p) == r.t for r in got) and {r.t: r.p for r in got}["a\ufdd0b c"] == ["a", "\ufdd0", "b", " c"]


def test_draws_depend_on_key_and_step_only():
    one, two = en.draws("7:1:0", 0.5), en.draws("7:1:0", 0.5)
    assert [one() for _ in range(50)] == [two() for _ in range(50)]
    share = sum(map(lambda k: en.draws(str(k), 0.1)(), range(20_000))) / 20_000
    assert share == pytest.approx(0.1, abs=0.01)

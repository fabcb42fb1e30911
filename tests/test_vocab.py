import pytest
from conftest import rows
from pyspark.sql import functions as F

from vocabspark.operators import inventory as inv
from vocabspark.operators import vocab as vo
from vocabspark.plans.merge import merge_bpe, merge_unigram, trim_unigram


def uvocab(spark, **scores):
    return spark.createDataFrame(list(scores.items()), "token string, logprob double")


def tokens(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "token string")


def merges(spark, *rules):
    listed = [(i, left, right, left + right) for i, (left, right) in enumerate(rules)]
    return spark.createDataFrame(listed, "rank int, left string, right string, token string")


def scores(df):
    return {r.token: r.logprob for r in df.collect()}


def test_union_modes(spark):
    base, plus = uvocab(spark, x=-2.0), uvocab(spark, x=-4.0, y=-3.0)
    assert scores(vo.union_unigram(base, plus, "mean")) == {"x": -3.0, "y": -3.0}
    assert scores(vo.union_unigram(base, plus, "min")) == {"x": -4.0, "y": -3.0}
    assert scores(vo.union_unigram(base, plus, "max")) == {"x": -2.0 + 1e-7, "y": -3.0}
    assert scores(vo.union_unigram(uvocab(spark, x=0.0), uvocab(spark, x=-1.0))) == {"x": 0.0}
    with pytest.raises(ValueError):
        vo.union_unigram(base, plus, "sum")


def test_union_with_itself_changes_nothing(spark):
    base = uvocab(spark, x=-2.0, y=-3.0)
    assert scores(vo.union_unigram(base, base, "mean")) == scores(base)
    rules = merges(spark, ("a", "b"), ("ab", "c"))
    union = vo.order_union(vo.union_bpe(rules, rules), 10)
    assert rows(union.select("token", "id")) == [("ab", 10), ("abc", 11)]


def test_trim_keeps_the_likeliest_and_all_essentials(spark):
    vocab = spark.createDataFrame(
        [("a", -1.0), ("b", -2.0), ("c", -3.0), ("d", -4.0), ("<|s|>", -9.0)], "token string, logprob double"
    )
    kept = vo.trim_vocab(vocab, tokens(spark, "d"), 3)
    assert set(scores(kept)) == {"a", "d", "<|s|>"}
    assert set(scores(vo.trim_vocab(vocab, tokens(spark, "d"), 1))) == {"d", "<|s|>"}
    assert vo.trim_vocab(vocab, tokens(spark, "d"), 99).count() == 5


def test_rescore(spark):
    vocab = uvocab(spark, abc=-1.0, z=-9.0)
    got = scores(vo.rescore_essentials(vocab, tokens(spark, "abc")))
    assert got["abc"] == pytest.approx(-9 - 2e-7, abs=1e-12) and got["z"] == -9.0


def test_add_essentials_at_the_lowest_score(spark):
    got = scores(vo.add_essentials(uvocab(spark, a=-1.0, b=-5.0), tokens(spark, "a", "q", "q")))
    assert got == {"a": -1.0, "b": -5.0, "q": -5.0}


def test_repair_replaces_the_unlikeliest(spark):
    names = [f"tok{i:03d}" for i in range(400)]
    listed = [(n, -float(i)) for i, n in enumerate(names)] + [("a", -0.5)]
    vocab = spark.createDataFrame(listed, "token string, logprob double")
    got = scores(vo.repair_bytes(vocab))
    assert len(got) == len(listed)
    assert set(names) & set(got) == set(names[: 400 - 255])
    floor = -399.0 - 1e-7
    assert sum(1 for s in got.values() if s == pytest.approx(floor, abs=1e-12)) == 256
    protected = scores(vo.repair_bytes(vocab, tokens(spark, "tok399")))
    assert "tok399" in protected and len(protected) == len(listed)
    assert scores(vo.floor_bytes(vocab))["a"] == pytest.approx(floor, abs=1e-12)


def test_misaligned(spark):
    vocab = spark.createDataFrame([("ab", 5), ("xx", 6)], "token string, id int")
    bad = vo.merge_misaligned(vocab, merges(spark, ("a", "b"), ("c", "d")), 5)
    assert [(r.id, r.token) for r in bad.collect()] == [(6, "xx")]
    paired = vo.merge_by_token(vocab, merges(spark, ("a", "b")), 5).collect()
    assert [(r.token, r.left, r.right) for r in paired] == [("ab", "a", "b")]


def test_duplicates(spark):
    listed = spark.createDataFrame(
        [(0, "a", -1.0), (1, "b", -3.0), (2, "a", -2.0)], "pos int, token string, logprob double"
    )
    assert rows(vo.duplicate_tokens(listed)) == [("a", 2)]
    assert scores(vo.dedupe_vocab(listed)) == {"a": -2.0, "b": -3.0}
    assert not vo.check_size(listed, 3).first().matches
    sized = listed.withColumn("kind", F.lit("token"))
    assert vo.intermediate_size(sized, 10).first().intermediate_size == 9


def test_length_order_puts_parts_before_wholes(spark):
    base = merges(spark, ("a", "b"), ("ab", "c"), ("abc", "d"))
    plus = merges(spark, ("d", "e"), ("a", "b"), ("ab", "de"))
    union = vo.order_union(vo.union_bpe(base, plus), 100).orderBy("id").collect()
    seen = set("abcde")
    for row in union:
        assert row.left in seen and row.right in seen and row.left + row.right == row.token
        seen.add(row.token)
    assert len(union) == 5
    assert vo.budget_deficit(vo.union_bpe(base, plus), 7).first().deficit == 2


def test_last_rule_of_a_token_wins(spark):
    base = merges(spark, ("a", "bc"), ("ab", "c"))
    row = vo.union_bpe(base, merges(spark, ("x", "y"))).where("token = 'abc'").first()
    assert (row.left, row.right, row.base_rank) == ("ab", "c", 1)


def test_merge_job(spark):
    from vocabspark.operators.encode import Vocabulary
    from vocabspark.operators.ids import assign_ids

    alphabet, white = tokens(spark, *"abcde"), inv.whitespace_tokens(spark, 3)
    sides = [merges(spark, ("a", "b"), ("ab", "c")), merges(spark, ("d", "e"), ("a", "b"))]
    base, plus = (
        Vocabulary(assign_ids(tokens(spark, "<|unk|>"), alphabet, m, white), m) for m in sides
    )
    merged = merge_bpe(base, plus)
    listed = [(r.id, r.token) for r in merged.tokens.orderBy("id").collect()]
    assert listed == list(enumerate(["<|unk|>", *"abcde", "ab", "de", "abc", "   ", "  "]))
    assert vo.merge_misaligned(merged.tokens, merged.merges, 6).count() == 0
    assert merge_bpe(base, plus, limit=1).merges.count() == 1
    assert vo.vocab_counts(merged.tokens, merged.merges).first().adds_up


def test_unigram_jobs(spark):
    essentials = vo.essential_tokens(spark, tokens(spark, "가")).persist()
    assert essentials.count() == 256 + 1 + 4
    base = spark.createDataFrame([(f"t{i:03d}", -float(i + 1)) for i in range(300)], "token string, logprob double")
    trimmed = trim_unigram(base, essentials, 300)
    assert trimmed.count() == 300
    assert trimmed.join(essentials, "token").count() == 261
    assert trimmed.where("token = 't000'").first().pos == 0
    merged = merge_unigram(base, trimmed.drop("pos"), essentials, "max", 300)
    assert merged.count() == 300 and merged.join(essentials, "token").count() == 261


def test_exemplar_coverage(spark):
    sets = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "t")], "token string, set string")
    got = rows(vo.exemplar_coverage(tokens(spark, "a", "c", "c"), sets))
    assert got == [("s", 2, 1), ("t", 1, 1)]


def test_inventories(spark):
    special = [r.token for r in inv.special_tokens(spark, ["<|sep|>", "<|mask|>"]).collect()]
    assert len(special) == 42 and special == sorted(special)
    assert [r.token for r in inv.buffer_tokens(spark, 2).collect()] == ["<|unused00|>", "<|unused01|>"]
    assert inv.buffer_tokens(spark, 1, padded=False).first().token == "<|unused0|>"
    lengths = lambda *a, **k: [len(r.token) for r in inv.whitespace_tokens(spark, *a, **k).collect()]
    assert lengths(4) == [4, 3, 2]
    assert lengths(4, "exp") == [16, 8, 4, 2]
    assert lengths(0, "fixed", single=True) == [2, 4, 8, 16, 1]
    assert lengths(0) == [] and lengths(0, "exp") == []
    with pytest.raises(ValueError):
        inv.whitespace_tokens(spark, 2, "other")
    fallback = inv.fallback_tokens(spark).orderBy("byte").collect()
    assert fallback[0].token == "<0x00>" and fallback[255].token == "<0xFF>"


def test_budget_and_roles(spark):
    alphabet = tokens(spark, *"abc")
    row = inv.vocab_budget(
        1000, inv.whitespace_tokens(spark, 3), inv.added_tokens(spark, 8, byte_fallback=True), alphabet
    ).first()
    assert (row.trainer_size, row.n_added, row.n_alphabet) == (742, 50, 3)
    assert row.n_learned == 742 - 50 - 3
    roles = inv.assign_roles(inv.added_tokens(spark, 2))
    assert roles.where("named_role is not null").count() == 6
    assert roles.where("token = '<|pad|>'").first().named_role == "pad_token"


def test_usage_is_leftmost_then_longest(spark):
    corpus = spark.createDataFrame([("a     b   c <|s|><|sep|>",)], "text string")
    used = {r.token: r.n for r in inv.token_usage(corpus, inv.whitespace_tokens(spark, 4)).collect()}
    assert used == {"    ": 1, "   ": 1, "  ": 0}
    special = inv.token_usage(corpus, inv.special_tokens(spark)).where("n > 0")
    assert rows(special) == [("<|sep|>", 1), ("<|s|>", 1)]

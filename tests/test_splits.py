import itertools
import random

import pytest
from pyspark.sql import functions as F

from vocabspark.functions import bytelevel as bl
from vocabspark.functions import splits
from vocabspark.functions.normalize import normalize
from vocabspark.operators import pretokenize as pt


def split(spark, step, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(splits.STEPS[step](F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "step, text, pieces",
    [
        ("scripts", "foo漢字かなカナ아", ["foo", "漢字かなカナ", "아"]),
        ("scripts", "カーふ!ー", ["カーふ", "!", "ー"]),
        ("scripts", "  ab, c д", ["  ab", ", ", "c ", "д"]),
        ("scripts", "éx ́", ["éx ́"]),
        ("scripts", "   ", ["   "]),
        ("punctuation", "a!!b", ["a", "!", "!", "b"]),
        ("punctuation", "«$x»", ["«", "$", "x", "»"]),
        ("digits", "a12", ["a", "1", "2"]),
        ("longspace", "a" + " " * 16 + "b", ["a" + " " * 16 + "b"]),
        ("longspace", "a" + " " * 17 + "b", ["a", "b"]),
        ("longspace", "a" + "\t" * 20, ["a"]),
        ("camel", "camelCaseWordABc", ["camel", "Case", "Word", "ABc"]),
        ("byte_level", "it's  a 12 tEst!!   x ",
         ["it", "'s", " ", " a", " 12", " tEst", "!!", "  ", " x", " "]),
        ("whitespace", "it's  a-b ", ["it", "'", "s", "a", "-", "b"]),
        ("word_with_space", "a  b!! c\n", ["a", "  b", "!!", " c", "\n"]),
        ("byte_level", "", []),
    ],
)
def test_step(spark, step, text, pieces):
    assert split(spark, step, text) == pieces


KEEPING = ["scripts", "punctuation", "digits", "camel", "word_with_space", "byte_level"]
MIXED = "아!@ ㈝12 miXed   ws\tTab\nльв 漢字カナー 'tis it's 😣é́  "


@pytest.mark.parametrize("step", KEEPING)
def test_joined_pieces_give_the_text(spark, sf, step):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    texts = docs.union(spark.createDataFrame([(MIXED,)], "text string"))
    joined = F.array_join(splits.STEPS[step](F.col("text")), "")
    assert texts.where(joined != F.col("text")).count() == 0


def test_whole_training_split_joins_back(spark):
    df = spark.createDataFrame([(MIXED,)], "text string")
    pieces = pt.pretokenize(df, pt.SplitSpec().train()).first().pieces
    assert "".join(pieces) == MIXED


def test_whitespace_policy():
    assert pt.SplitSpec().train()[0] == "scripts"
    policy = pt.SplitSpec(preserve_whitespace="inference", remove_longspace=True)
    assert policy.train() == [
        "whitespace", "scripts", "punctuation", "digits", "longspace", "camel", "byte_level"
    ]
    assert policy.inference() == ["scripts", "punctuation", "digits", "byte_level"]
    assert pt.SplitSpec(preserve_whitespace="no").inference()[0] == "whitespace"
    assert pt.SplitSpec(byte_fallback=True).train()[-1] == "word_with_space"
    with pytest.raises(ValueError):
        pt.SplitSpec(preserve_whitespace="maybe")


@pytest.mark.parametrize(
    "form, text, result",
    [
        ("NFC", "e\u0301", "\u00e9"),
        ("NFC", "plain", "plain"),
        ("NFC", None, None),
        ("NFC", "e\u0301\n", "\u00e9\n"),
        ("NFKC", "㈎ﬁ", "(가)fi"),
        (None, "e\u0301", "e\u0301"),
    ],
)
def test_normal_forms(spark, form, text, result):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(normalize(F.col("t"), form)).first()[0] == result


def test_unknown_normal_form():
    with pytest.raises(ValueError):
        normalize(None, "NFX")


def test_byte_alphabet(spark):
    rows = bl.byte_alphabet(spark).collect()
    assert len({r.ch for r in rows}) == 256
    assert {r.byte for r in rows} == set(range(256))
    back = bl.byte_alphabet(spark).select("byte", bl.byte_of(F.col("ch")).alias("again"))
    assert back.where("byte <> again").count() == 0


@pytest.mark.parametrize(
    "text, shown", [("갤", "ê°¤"), (" a\n", "ĠaĊ"), ("\n", "Ċ"), ("", ""), ("!~", "!~")]
)
def test_byte_form(spark, text, shown):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(bl.to_byte_chars(F.col("t")).alias("s")).withColumn(
        "back", bl.from_byte_chars(F.col("s"))
    ).first()
    assert (row.s, row.back) == (shown, text)


def test_count_pretokens(spark):
    df = spark.createDataFrame([("a a b",), ("a",)], "text string")
    got = {r.piece: r.n for r in pt.count_pretokens(df, ["byte_level"]).collect()}
    assert got == {"a": 2, " a": 1, " b": 1}


@pytest.mark.parametrize("steps", splits.JOINT)
def test_joint_steps_give_the_pieces_of_single_steps(spark, steps):
    """All short texts of characters of every kind, and random longer ones, in one pass and step by step."""
    kinds = "aé1٣½ .,'$_«€́　\n\x1c\x85\U0001f600​漢"
    texts = ["".join(t) for n in range(4) for t in itertools.product(kinds, repeat=n)]
    rnd = random.Random(3)
    texts += ["".join(rnd.choices(kinds + "    '''streveldm", k=rnd.randint(4, 40))) for _ in range(5000)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    single = splits.STEPS[steps[0]](F.col("text"))
    for name in steps[1:]:
        single = F.flatten(F.transform(single, splits.STEPS[name]))
    both = df.select("text", single.alias("single"), splits.apply_steps(F.col("text"), list(steps)).alias("joint"))
    assert both.where(~F.col("single").eqNullSafe(F.col("joint"))).limit(5).collect() == []


def test_steps_that_follow_each_other_are_one_pass():
    steps = pt.SplitSpec(isolate_camelcase=False).train()
    assert len(splits._passes(steps)) == 2 and len(splits._passes(pt.SplitSpec(remove_longspace=True).train())) == 5

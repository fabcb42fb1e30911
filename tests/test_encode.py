import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vocabspark.operators import encode as en
from vocabspark.operators import evaluate as ev
from vocabspark.operators.pretokenize import SplitSpec
from vocabspark.plans.train import TrainOptions, train_vocabulary
from vocabspark.session import checkpoint
from vocabspark.sources import vocab as vsrc

MIXED = "아!@ ㈝12 miXed   ws     \tTab\nльв 漢字カナー 'tis it's 😣e\u0301  <|s|>x<|unused01|>"


@pytest.fixture(scope="module")
def docs(spark, sf):
    docs = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("doc_id"), "text")
    extra = spark.createDataFrame([(-1, MIXED), (-2, ""), (-3, None)], "doc_id long, text string")
    return docs.unionByName(extra).persist()


def options(**changes):
    fixed = dict(vocab_size=42 + 4 + 256 + 30 + 3, n_buffer=4, whitespace_reservation=4)
    return TrainOptions(**{**fixed, **changes})


@pytest.fixture(scope="module")
def bpe(docs):
    return train_vocabulary(docs, options())


@pytest.fixture(scope="module")
def unigram(docs):
    return train_vocabulary(docs, options(model="unigram", vocab_size=600, max_token_length=6))


@pytest.fixture(scope="module", params=["bpe", "unigram"])
def vocab(request):
    return request.getfixturevalue(request.param)


def test_layout(bpe):
    kinds = [r.kind for r in bpe.tokens.orderBy("id").collect()]
    assert kinds == ["special"] * 46 + ["alphabet"] * 256 + ["merge"] * 30 + ["whitespace"] * 3
    assert [r.id for r in bpe.tokens.orderBy("id").collect()] == list(range(335))


def test_unigram_size(unigram):
    assert unigram.tokens.count() == 600
    scores = [r.logprob for r in unigram.tokens.where("kind='token'").orderBy("id").collect()]
    assert scores == sorted(scores, reverse=True)


def test_text_comes_back_in_normal_form(docs, vocab):
    back = en.decode(en.encode(docs, vocab), vocab)
    row = back.where("doc_id = -1").first()
    assert row.decoded == MIXED.replace("e\u0301", "\u00e9")
    assert back.where("doc_id >= -2 and doc_id <> -1 and decoded <> text").count() == 0
    assert back.where("doc_id = -3 and ids is null and decoded is null").count() == 1


def test_added_tokens_are_one_id(docs, bpe):
    ids = {r.token: r.id for r in bpe.tokens.collect()}
    row = en.encode(docs, bpe).where("doc_id = -1").first()
    assert ids["<|s|>"] in row.ids and ids["<|unused01|>"] in row.ids and ids["    "] in row.ids


def test_large_vocabulary_route_gives_the_same(docs, vocab):
    near = checkpoint(en.encode(docs, vocab))
    far = en.encode(docs, vocab, max_broadcast_rows=0)
    assert rows(near.select("doc_id", "ids")) == rows(far.select("doc_id", "ids"))
    back = en.decode(near, vocab, max_broadcast_rows=0)
    assert rows(back.select("doc_id", "decoded")) == rows(en.decode(near, vocab).select("doc_id", "decoded"))
    parts = [en.encode_pieces(docs, vocab, max_broadcast_rows=n) for n in (None, 0)]
    used = [rows(ev.token_frequency(p, weight="n").select("id", "n")) for p in parts]
    assert used[0] == used[1] == rows(ev.token_frequency(near).select("id", "n"))


def test_dropout(docs, bpe):
    plain = en.encode(docs, bpe)
    one = checkpoint(en.encode(docs.repartition(1), bpe, dropout=0.3, seed=5))
    many = en.encode(docs.repartition(9), bpe, dropout=0.3, seed=5, max_broadcast_rows=0)
    other = en.encode(docs, bpe, dropout=0.3, seed=6)
    assert rows(one.select("doc_id", "ids")) == rows(many.select("doc_id", "ids"))
    assert rows(one.select("doc_id", "ids")) != rows(other.select("doc_id", "ids"))
    size = F.sum(F.size("ids"))
    assert one.agg(size).first()[0] > plain.agg(size).first()[0]
    everything = en.encode(docs, bpe, dropout=1.0).where("doc_id = 0").first()
    alphabet = {r.id for r in bpe.tokens.where("kind = 'alphabet'").collect()}
    assert set(everything.ids) <= alphabet
    assert en.decode(one, bpe).where("doc_id >= 0 and decoded <> text").count() == 0


def test_dropout_is_for_bpe(docs, unigram):
    with pytest.raises(ValueError):
        en.encode(docs, unigram, dropout=0.1)


def test_lowest_rank_then_leftmost():
    ranks = {("a", "b"): 0, ("ab", "a"): 2, ("b", "a"): 1, ("a", "a"): 3}
    assert en.merge_piece(list("aba"), ranks) == ["aba"]
    assert en.merge_piece(list("baab"), ranks) == ["ba", "ab"]
    assert en.merge_piece(list("aaa"), ranks) == ["aa", "a"]
    assert en.merge_piece([], ranks) == []


def test_encoding_training_words_gives_the_training_state(docs, bpe):
    known = {r.token for r in bpe.tokens.collect()}
    table = {r.id: r.token for r in bpe.tokens.collect()}
    row = en.encode(docs, bpe).where("doc_id = 0").first()
    assert all(table[i] in known for i in row.ids)
    shown = "".join(table[i] for i in row.ids)
    assert "Ġ" in shown and len(row.ids) < len(row.text.encode())


def test_byte_fallback(docs):
    spec = SplitSpec(byte_fallback=True)
    vocab = train_vocabulary(docs.where("doc_id >= 0"), options(vocab_size=700, spec=spec))
    back = en.decode(en.encode(docs, vocab), vocab)
    assert back.where("doc_id = -1").first().decoded == MIXED.replace("e\u0301", "\u00e9")
    table = {r.id: r.token for r in vocab.tokens.collect()}
    used = {table[i] for i in back.where("doc_id = -1").first().ids}
    assert {"<0xEC>", "<0x95>", "<0x84>"} <= used
    made = vsrc.make_artifact(vocab)
    assert made.meta.first().byte_fallback
    assert made.added.where("token like '<0x%' and special").count() == 0
    assert made.added.where("token like '<0x%'").count() == 256


def test_component_mode(docs):
    vocab = train_vocabulary(docs, options(model="unigram", vocab_size=300, component_mode=True))
    assert vocab.tokens.where("kind = 'special'").count() == 0
    with pytest.raises(ValueError):
        options(component_mode=True)


def test_unknown_characters(spark, docs):
    vocab = train_vocabulary(
        docs.where("doc_id >= 0"), options(model="unigram", vocab_size=300, component_mode=True)
    )
    text = spark.createDataFrame([(1, "漢")], "doc_id long, text string")
    ids = en.encode(text, vocab).first().ids
    assert len(ids) == 3 and ids[0] is None
    for rows_ in (None, 0):
        back = en.decode(en.encode(text, vocab), vocab, max_broadcast_rows=rows_).first()
        assert back.decoded == "\ufffd" * 3


def test_vocab_roundtrip(vocab):
    assert en.vocab_roundtrip(vocab).where("not same").count() == 0


def test_fallback_is_one_replacement_character(spark):
    rows_ = [("ê°", 0, "merge"), ("°¤", 1, "merge"), ("ê°¤", 2, "merge"), ("aê", 3, "merge"),
             ("ê", 4, "alphabet"), ("<|s|>", 5, "special")]
    tokens = spark.createDataFrame(rows_, "token string, id int, kind string")
    merges = spark.createDataFrame([], "rank int, left string, right string, token string")
    vocab = en.Vocabulary(tokens, merges)
    got = {r.id: (r.decoded, r.is_fallback, r.has_fallback) for r in ev.token_decode_table(vocab).collect()}
    assert got[0] == ("�", True, True)
    assert got[1] == ("��", False, True)
    assert got[2] == ("갤", False, False)
    assert got[3] == ("a�", False, True)
    assert got[4] == ("�", True, True)
    assert got[5] == ("<|s|>", False, False)
    encoded = spark.createDataFrame([(1, [0, 1, 2, 4])], "doc_id long, ids array<int>")
    row = ev.fallback_portion(encoded, vocab).first()
    assert (row.n_tokens, row.n_fallback, row.n_holding, row.portion) == (4, 2, 3, 0.5)
    shown = [r.shown for r in ev.reconstruction(encoded, vocab).orderBy("pos").collect()]
    assert shown == ["|ufb|", "��", "갤", "|ufb|"]
    # Bytes first: EA B0 B0 is a character, A4 is left over.
    assert en.decode(encoded, vocab).first().decoded == "\uac30\ufffd갤\ufffd"


def test_reports(docs, bpe):
    encoded = checkpoint(en.encode(docs, bpe))
    row = ev.invertibility(encoded.where("doc_id <> -3"), bpe).first()
    assert row.n_docs == row.n_invertible_normal == row.n_invertible + 1
    stats = ev.length_stats(encoded).first()
    assert stats.chars_per_token == round(stats.chars / stats.tokens, 6)
    assert ev.token_frequency(encoded).agg(F.sum("n")).first()[0] == stats.tokens


def test_artifact_loads_again(docs, vocab, tmp_path):
    made = vsrc.write_vocab(vocab, str(tmp_path / "v"))
    again = vsrc.read_vocab(docs.sparkSession, str(tmp_path / "v")).vocabulary()
    assert again.spec == vocab.spec and again.model == vocab.model
    assert rows(en.encode(docs, again).select("ids")) == rows(en.encode(docs, vocab).select("ids"))
    unk = vocab.tokens.where("token = '<|unk|>'").first().id
    assert made.meta.first().unk_id == unk


@pytest.fixture(scope="module")
def fallback(docs):
    return train_vocabulary(docs.where("doc_id >= 0"), options(vocab_size=700, spec=SplitSpec(byte_fallback=True)))


def test_json_keeps_flags_and_fallback_tokens(docs, fallback, tmp_path):
    spark, made = docs.sparkSession, vsrc.make_artifact(fallback)
    vsrc.write_vocab_json(made, str(tmp_path / "parts"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "parts").glob("part-*")))
    whole = json.loads(text)["model"]
    assert whole["byte_fallback"] and whole["unk_id"] == made.meta.first().unk_id and whole["type"] == "bpe"
    (tmp_path / "vocab.json").write_text(text)
    for again in (vsrc.read_vocab_json_parts(spark, str(tmp_path / "parts")), vsrc.read_vocab_json(spark, str(tmp_path / "vocab.json"))):
        assert again.spec.byte_fallback
        assert rows(again.tokens.select("token", "id", "kind")) == rows(fallback.tokens.select("token", "id", "kind"))
        assert vsrc.make_artifact(again).added.where("not special and token like '<0x%'").count() == 256


@pytest.mark.parametrize("in_parts", [False, True])
def test_json_export_loads_again(docs, vocab, tmp_path, in_parts):
    path, made = tmp_path / "vocab.json", vsrc.make_artifact(vocab)
    if in_parts:
        vsrc.write_vocab_json(made, str(path))
        again = vsrc.read_vocab_json_parts(docs.sparkSession, str(path), vocab.spec)
    else:
        path.write_text(vsrc.vocab_json(made).first().json)
        again = vsrc.read_vocab_json(docs.sparkSession, str(path), vocab.spec)
    assert again.model == vocab.model
    assert rows(again.added().select("token", "id")) == rows(vocab.added().select("token", "id"))
    if vocab.model == "bpe":
        assert rows(again.tokens.select("token", "id", "kind")) == rows(vocab.tokens)
        fields = ["rank", "left", "right", "token"]
        assert rows(again.merges.select(fields)) == rows(vocab.merges.select(fields))
    else:
        scored = "logprob is not null"
        assert rows(again.tokens.where(scored).select("token", "logprob")) == rows(
            vocab.tokens.where(scored).select("token", "logprob")
        )

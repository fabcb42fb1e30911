import random
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest

from vocabspark.operators import dropout as dr
from vocabspark.operators import encode as en


def test_draws_of_many_pieces_at_once():
    """Hashes side by side equal hashlib's one by one, for keys that fit one block and for longer ones."""
    rnd = random.Random(3)
    keys = ["7:1", "", "7:é漢", "x" * 33, "y" * 34, "z" * 120]
    places = [(rnd.randrange(len(keys)), rnd.randrange(10 ** rnd.randint(1, 9)), rnd.randrange(10 ** rnd.randint(1, 4))) for _ in range(3000)]
    drawn = dr.Draws(keys, 0.4).skip(*np.array(places).T)
    heads = [int.from_bytes(md5(f"{keys[r]}:{p}:{s}".encode()).digest()[:4], "big") for r, p, s in places]
    assert drawn.tolist() == [head < 0.4 * 2**32 for head in heads]


@pytest.mark.parametrize("chance", [0.0, 0.3, 1.0])
def test_merges_of_many_pieces_at_once(chance):
    """Random rules and pieces of 0 to 90 characters, some without rules: equal to one piece at a time."""
    rnd = random.Random(5)
    for _ in range(30):
        made, ranks = list("abc"), {}
        for rank in range(rnd.randint(1, 25)):
            pair = rnd.choice(made), rnd.choice(made)
            ranks.setdefault(pair, rank)
            made.append("".join(pair))
        texts = list({"".join(rnd.choice("aabbcé") for _ in range(rnd.choice((0, 1, 2, 5, 9, 20, 90)))) for _ in range(40)})
        which = np.array([rnd.randrange(len(texts)) for _ in range(120)])
        chances = dr.Draws(["k"], chance)
        counts, symbols, names = dr.Merges(ranks).pieces(
            texts,
            which,
            (lambda items, step: chances.skip(np.zeros(len(items), np.int64), items, np.full(len(items), step))) if chance else None,
            lambda item: en.merge_piece(list(texts[which[item]]), ranks, en.draws(f"k:{item}", chance) if chance else None),
        )
        ends = np.cumsum(counts).tolist()
        got = [[names[k] for k in symbols[a:b].tolist()] for a, b in zip([0, *ends], ends)]
        want = [en.merge_piece(list(texts[k]), ranks, en.draws(f"k:{i}", chance)) for i, k in enumerate(which.tolist())]
        assert got == want


@pytest.mark.parametrize("dropout", [0.0, 0.1])
def test_encoding_a_batch_merges_no_short_piece_alone(spark, monkeypatch, dropout):
    """The pieces of a batch are merged together; one by one, with a hash of Python a merge, took most of the time."""
    merges = spark.createDataFrame([("a", "b", 0, "ab"), ("ab", "c", 1, "abc")], "left string, right string, rank int, token string")
    tokens = [(t, i, "merge" if len(t) > 1 else "alphabet") for i, t in enumerate(["a", "b", "c", "Ġ", "ab", "abc"])]
    vocab = en.Vocabulary(spark.createDataFrame(tokens, "token string, id int, kind string"), merges)
    encode = en._broadcast_encoder(vocab, dropout).func
    texts = pa.array([["abc", " abcab", "cab"] * 40, None, [], ["b"]])
    flags = pa.array([[False] * 120, None, [], [False]])
    keys = pa.array([f"7:{n}" for n in range(4)])
    ids = {t: i for t, i, _ in tokens}
    ranks = {("a", "b"): 0, ("ab", "c"): 1}
    want = [
        None if row is None else [
            ids[s]
            for pos, piece in enumerate(row)
            for s in en.merge_piece(list(piece.replace(" ", "Ġ")), ranks, en.draws(f"7:{n}:{pos}", dropout))
        ]
        for n, row in enumerate(texts.to_pylist())
    ]

    def alone(*_):
        raise AssertionError("a short piece was merged alone")

    monkeypatch.setattr(en, "merge_piece", alone)
    assert pa.concat_arrays(list(encode(iter([(texts, flags, keys)])))).to_pylist() == want


def test_decoding_what_dropout_left_whole(spark):
    """Every character comes back whatever was skipped, also from pieces that are merged beside others and alone."""
    merges = [("a", "b", 0, "ab"), ("ab", "ab", 1, "abab"), ("abab", "c", 2, "ababc")]
    merges = spark.createDataFrame(merges, "left string, right string, rank int, token string")
    tokens = [(t, i, "merge" if len(t) > 1 else "alphabet") for i, t in enumerate(["a", "b", "c", "Ġ", "ab", "abab", "ababc"])]
    vocab = en.Vocabulary(spark.createDataFrame(tokens, "token string, id int, kind string"), merges)
    docs = spark.createDataFrame([(n, "ababc " * n + "ab" * 50 * n) for n in range(8)], "doc_id long, text string")
    encoded = en.encode(docs, vocab, dropout=0.3, seed=7)
    back = en.decode(encoded, vocab)
    assert back.where("decoded <> text or decoded is null").count() == 0
    longest = back.where("doc_id = 7").selectExpr("size(ids)").first()[0]
    whole = en.encode(docs, vocab).where("doc_id = 7").selectExpr("size(ids)").first()[0]
    assert longest > whole

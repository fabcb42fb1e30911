import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabspark.operators import lattice as la
from vocabspark.operators import unigram as un
from vocabspark.operators.order import with_running_index

SCORES = {"a": -1.0, "b": -2.0, "c": -3.0, "ab": -1.5, "bc": -1.25, "abc": -4.0}


def lexicon(scores=SCORES):
    tokens = list(scores)
    keys = np.empty(len(tokens), np.uint64)
    for rows, points in la.by_length(tokens):
        *_, whole = la.hashes(points, points.shape[1])
        keys[rows] = whole[:, 0]
    order = np.argsort(keys)
    return {
        "keys": keys[order], "numbers": order.astype(np.int32), "scores": np.array(list(scores.values())),
        "longest": max(map(len, tokens)), "salt": 0,
    }


def paths(text):
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        tokens = [text[i:j] for i, j in zip(at, at[1:])]
        if all(t in SCORES for t in tokens):
            yield tokens, sum(SCORES[t] for t in tokens)


@pytest.mark.parametrize("window", [1, 2, 3, 100])
def test_paths_against_all_paths(monkeypatch, window):
    monkeypatch.setattr(la, "WINDOW", window)
    texts = ["a", "abc", "abcabc", "ccab", "babcab", "bacaabcb", "cab", "b"]
    found = lexicon()
    total, want = np.zeros(len(SCORES)), np.zeros(len(SCORES))
    for rows, points in la.by_length(texts, 7):
        n = (rows + 1).astype(float)
        la.add_expected_counts(points, n, found, total)
        sums = la.path_scores(points, found)
        for row, score in zip(rows.tolist(), sums):
            every = list(paths(texts[row]))
            whole = sum(math.exp(s) for _, s in every)
            assert score == pytest.approx(math.log(whole))
            best = la.best_path(texts[row], SCORES, 3, -99.0)
            assert sum(SCORES[t] for t in best) == pytest.approx(max(s for _, s in every)) and "".join(best) == texts[row]
            for k, token in enumerate(SCORES):
                want[k] += (row + 1) * sum(math.exp(s) * t.count(token) for t, s in every) / whole
    assert total == pytest.approx(want)


def test_seed_counts_of_batches_equal_those_of_all(spark):
    """Prefixes that cross the borders of batches and partitions, characters of any plane, NUL and pieces that repeat."""
    rnd = random.Random(5)
    pieces = ["".join(rnd.choices("ab\0\u00e9\U0001f600", k=rnd.randint(0, 9))) for _ in range(400)]
    want = {}
    for n, piece in enumerate(pieces):
        for i in range(len(piece)):
            for j in range(i + 1, min(i + 4, len(piece)) + 1):
                want[piece[i:j]] = want.get(piece[i:j], 0) + n
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for size in ("1", "7", "10000"):
            spark.conf.set(key, size)
            counts = spark.createDataFrame(list(enumerate(pieces)), "n long, piece string")
            got = un.unigram_seed(counts, 4)
            assert sorted((r.token, r.n) for r in got.collect()) == sorted(want.items())
            # Prefixes of a batch are summed in its task: only those at its borders are grouped again.
            assert "border" in got._jdf.queryExecution().toString()
    finally:
        spark.conf.set(key, before)


def test_short_pieces_as_probabilities_equal_logarithms(monkeypatch):
    """Also pieces too unlikely to be summed as probabilities, and pieces without a path."""
    scores = SCORES | {"d": -300.0}
    texts = ["abcabc", "ddd", "dab", "cabd", "xbc", "ddab", "a" * 64, "c" * 65]
    found, totals = lexicon(scores), []
    for short in (64, 0):
        monkeypatch.setattr(la, "SHORT", short)
        totals.append(np.zeros(len(scores)))
        for rows, points in la.by_length(texts):
            la.add_expected_counts(points, (rows + 1).astype(float), found, totals[-1])
    assert totals[0] == pytest.approx(totals[1], rel=1e-12) and totals[0][-1] == pytest.approx(6 + 3 + 4 + 12)


def test_tokens_found_by_slots_equal_all_substrings():
    """Also where keys share the first bits of their hashes."""
    tokens = sorted({"".join(p) for n in (1, 2, 3) for p in itertools.product("abc", repeat=n)} - {"b", "cab"})
    found = lexicon(dict.fromkeys(tokens, -1.0))
    crowded = found | {"slots": (np.zeros(2, np.int32), np.ones(2, bool), np.uint64(63))}
    (_, points), = la.by_length(["abcabcbba"])
    for lex in (found, crowded):
        got = {("abcabcbba"[s : s + n], int(k)) for n, (_, starts, numbers) in enumerate(la.places(points, lex), 1) for s, k in zip(starts, numbers)}
        assert got == {(t, k) for k, t in enumerate(tokens) if t in "abcabcbba"}


def test_best_scores_without_the_token_itself():
    texts = ["ab", "bc", "abc"]
    for rows, points in la.by_length(texts):
        for row, score in zip(rows.tolist(), la.best_scores_without(points, lexicon())):
            assert score == pytest.approx(max(s for t, s in paths(texts[row]) if len(t) > 1))


def test_no_path_and_unknown_characters():
    some = lexicon({"a": -1.0, "bc": -1.0})
    total = np.zeros(2)
    (_, points), = la.by_length(["ab"])
    la.add_expected_counts(points, np.ones(1), some, total)
    assert total.tolist() == [0.0, 0.0] and la.path_scores(points, some)[0] == -np.inf
    assert la.best_path("xbcy", {"a": -1.0, "bc": -1.0}, 2, -9.0) == ["x", "bc", "y"]
    assert la.best_path("", {}, 2, -9.0) == [] and la.best_path("aa", {"a": -1.0, "aa": -2.0}, 2, -9.0) == ["aa"]


def test_a_very_long_piece(monkeypatch):
    """Windows give what one stretch gives; and memory is by window."""
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abc"), 150_000))
    found, total, whole = lexicon(), np.zeros(len(SCORES)), np.zeros(len(SCORES))
    (_, points), = la.by_length([text])
    la.add_expected_counts(points, np.ones(1), found, total)
    monkeypatch.setattr(la, "WINDOW", 2_000_000)
    la.add_expected_counts(points, np.ones(1), found, whole)
    assert total == pytest.approx(whole)
    assert (total * [len(t) for t in SCORES]).sum() == pytest.approx(len(text))
    path = la.best_path(text, SCORES, 3, -99.0)
    assert "".join(path) == text and set(path) <= set(SCORES)


@pytest.mark.parametrize("width", [1, 3, 4096])
def test_windows_give_every_substring_once(spark, monkeypatch, width):
    words = ["abab", "b", "", "xyzxyzxyz", "é漢\U0001f600" * 4]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    cut = df.select("i", F.explode(la.windows(F.col("w"), 2, width)["text"]).alias("t"))
    got = cut.select("i", F.explode(la.substrings(F.col("t"), 3, width)).alias("s")).collect()
    want = [(k, w[i:j]) for k, w in enumerate(words) for i in range(len(w)) for j in range(i + 1, min(len(w), i + 3) + 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_seed_counts_every_substring(spark):
    words = {"abab": 2, "b": 5, "": 1}
    want = {}
    for word, n in words.items():
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + 3) + 1):
                want[word[i:j]] = want.get(word[i:j], 0) + n
    counts = spark.createDataFrame(list(words.items()), "piece string, n long")
    assert {r.token: r.n for r in un.unigram_seed(counts, 3).collect()} == want


@pytest.fixture(scope="module")
def counts(spark, sf):
    from vocabspark.operators import pretokenize as pt

    docs = spark.read.parquet(f"{sf}/benchmark.parquet")
    return pt.byte_pieces(pt.count_pretokens(docs, ["byte_level"])).persist()


def test_likelihood_does_not_fall_without_pruning(spark, counts):
    tokens = with_running_index(un.seed_vocab(counts, 6, 400), ["token"], "id").persist()
    race = un.Race(tokens)
    seen = [un.log_likelihood(counts, race)]
    for _ in range(3):
        un.maximize(counts, race)
        seen.append(un.log_likelihood(counts, race))
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(seen, seen[1:]))
    assert np.exp(race.scores).sum() == pytest.approx(1.0)


def test_training_keeps_characters_and_meets_the_budget(spark, counts):
    characters = {
        r[0] for r in counts.select(F.explode(F.split("piece", ""))).distinct().collect() if r[0]
    }
    learned = un.train_unigram(counts, 150, max_piece_length=5).collect()
    tokens = {r.token for r in learned}
    assert len(learned) == len(tokens) == 150
    assert characters <= tokens and max(map(len, tokens)) <= 5
    again = un.train_unigram(counts.repartition(7), 150, max_piece_length=5).collect()
    assert {r.token for r in again} == tokens


@pytest.mark.parametrize("budget", [102_400, 256_000])
def test_the_largest_vocabularies_are_not_refused(spark, budget):
    counts = spark.createDataFrame([("low", 5), ("lower", 2), ("newest", 6), ("", 1), ("w" * 5000, 1)], "piece string, n long")
    learned = {r.token: r.logprob for r in un.train_unigram(counts, budget).collect()}
    assert set("lowernst") <= set(learned) and "lowe" in learned and "w" * 16 in learned
    assert sum(math.exp(x) for x in learned.values()) == pytest.approx(1.0)


def test_no_pieces(spark):
    assert un.train_unigram(spark.createDataFrame([("", 3)], "piece string, n long"), 10).count() == 0


def by_definition(words, budget, longest, seeds, rounds=2, ratio=0.75):
    """The training, one piece and one path sum at a time."""
    seen = {}
    for w, n in words.items():
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + longest) + 1):
                seen[w[i:j]] = seen.get(w[i:j], 0) + n
    longer = sorted((t for t in seen if len(t) > 1 and seen[t] > 1), key=lambda t: (-seen[t] * len(t), t))
    chosen = sorted([t for t in seen if len(t) == 1] + longer[:seeds])
    total = sum(seen[t] * len(t) for t in chosen)
    score = {t: math.log(seen[t] * len(t) / total) for t in chosen}
    while True:
        for _ in range(rounds):
            c = dict.fromkeys(score, 0.0)
            for w, n in words.items():
                a, b = [0.0] * (len(w) + 1), [0.0] * (len(w) + 1)
                a[0] = b[-1] = 1.0
                spans = [(i, j) for j in range(1, len(w) + 1) for i in range(max(0, j - longest), j) if w[i:j] in score]
                for i, j in spans:
                    a[j] += a[i] * math.exp(score[w[i:j]])
                for i, j in sorted(spans, reverse=True):
                    b[i] += b[j] * math.exp(score[w[i:j]])
                for i, j in spans:
                    c[w[i:j]] += n * a[i] * math.exp(score[w[i:j]]) * b[j] / a[-1]
            c = {t: max(round(x, 9), 1e-9) for t, x in c.items()}
            score = {t: math.log(x / sum(c.values())) for t, x in c.items()}
        if len(score) <= budget:
            return score
        lost = {t: round(c[t] * (score[t] - sum(score[x] for x in la.best_path(t, {k: v for k, v in score.items() if k != t}, longest, -99))), 9) for t in score if len(t) > 1}
        room = max(budget, int(len(score) * ratio)) - sum(len(t) == 1 for t in score)
        stay = set(sorted(lost, key=lambda t: (-lost[t], t))[: max(room, 0)]) | {t for t in score if len(t) == 1}
        if len(stay) == len(score):
            return score
        score = {t: x for t, x in score.items() if t in stay}


@pytest.mark.parametrize("seed", range(3))
def test_training_by_definition(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcdé") for _ in range(rng.randint(1, 12))): rng.randint(1, 30) for _ in range(60)}
    want = by_definition(words, 30, 5, 200)
    counts = spark.createDataFrame(list(words.items()), "piece string, n long").repartition(3)
    got = {r.token: r.logprob for r in un.train_unigram(counts, 30, 5, seed_size=200).collect()}
    assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t], abs=1e-8) for t in want)


@pytest.mark.parametrize("parts", ["1", "4", "64"])
def test_skew_join_with_a_hot_key(spark, parts):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), "id")
    table = many.select("k").distinct().withColumn("v", F.length("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = la.skew_join(many, table.where("k <> 'k7'"), "k", F.col("id"))
        want = many.join(table.where("k <> 'k7'"), "k")
        assert sorted(got.select("k", "id", "v").collect()) == sorted(want.select("k", "id", "v").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

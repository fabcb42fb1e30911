import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

from vocabspark.operators import bpe


def one_at_a_time(words, n, min_frequency=0, max_length=16):
    words, out = [(list(w), c) for w, c in words.items()], []
    while len(out) < n:
        counts = {}
        for symbols, c in words:
            for pair in zip(symbols, symbols[1:]):
                if len(pair[0]) + len(pair[1]) <= max_length:
                    counts[pair] = counts.get(pair, 0) + c
        best = min(counts.items(), key=lambda kv: (-kv[1], kv[0]), default=None)
        if best is None or best[1] < max(min_frequency, 1):
            break
        (left, right), count = best
        out.append((left, right, count))
        words = [(merge(symbols, left, right), c) for symbols, c in words]
    return out


def merge(symbols, left, right):
    out, i = [], 0
    while i < len(symbols):
        if symbols[i : i + 2] == [left, right]:
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def learned(spark, words, n, **options):
    counts = spark.createDataFrame(list(words.items()), "piece string, n long")
    merges = bpe.train_bpe(counts, n, **options).orderBy("rank").collect()
    assert all(m.token == m.left + m.right for m in merges)
    assert [m.rank for m in merges] == list(range(len(merges)))
    return [(m.left, m.right, m.n) for m in merges]


def test_overlap(spark):
    words = {"aaa": 1, "aaaa": 1}
    assert learned(spark, words, 3) == one_at_a_time(words, 3)
    df = bpe.to_words(spark.createDataFrame([("aaa", 1), ("aaaa", 1), ("ba", 1)], "piece string, n long"))
    got = [r[0] for r in df.select(bpe.merge_pairs(df.word, [("a", "a")])).collect()]
    assert got == [["aa", "a"], ["aa", "aa"], ["b", "a"]]


def test_tie_goes_to_the_smaller_pair(spark):
    assert learned(spark, {"cd": 1, "ab": 1}, 2) == [("a", "b", 1), ("c", "d", 1)]


def test_token_built_in_two_ways(spark):
    words = {"abc": 5, "xab": 9, "ybc": 8, "abcz": 4, "bcbc": 3, "zabcab": 2}
    assert learned(spark, words, 12) == one_at_a_time(words, 12)


def test_new_pair_overtakes_the_batch(spark):
    words = {"abx": 90, "ab": 10, "cd": 60, "ef": 50, "gh": 40}
    assert learned(spark, words, 6) == one_at_a_time(words, 6)


def random_words(rng):
    letters = "abcdefghijklmnopqrstuvwxyzé漢\ufdd0\U0001f600"[: rng.choice([1, 2, 3, 5, 8, 30])]
    words = {}
    for _ in range(rng.randint(1, 60)):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
        words[word] = rng.choice([1, rng.randint(1, 50)])
    return words


@pytest.mark.parametrize("seed", range(3))
def test_rounds_equal_one_at_a_time(spark, seed):
    rng = random.Random(seed)
    words = random_words(rng)
    options = {"min_frequency": rng.choice([0, 8])}
    longest = rng.randint(2, 16)
    want = one_at_a_time(words, 25, max_length=longest, **options)
    got = learned(
        spark, words, 25, first_head=rng.choice([1, 2, 5, 50]), most_run_symbols=rng.choice([1, 9, 1000]),
        max_token_length=longest, **options,
    )
    assert got == want


def in_rounds(words, n, sizes, min_frequency, longest):
    """What ``train_bpe`` does, with a head of the given size in each round, on one batch of words."""
    pieces = pa.RecordBatch.from_pydict({"piece": list(words), "n": pa.array(words.values(), pa.int64())})
    batch = next(bpe._symbol_numbers([pieces]))
    table, out, rounds = bpe._Symbols(), [], 0
    least = max(min_frequency, 1)
    while len(out) < n:
        full = pa.RecordBatch.from_arrays([*batch.columns, pa.array([[]] * batch.num_rows, batch.column(0).type)], names=["ids", "n", "was"])
        rows = [r for b in bpe._pair_changer(table.names)([full]) for r in b.to_pylist()]
        rows = [r for r in rows if len(r["l"]) + len(r["r"]) <= longest and r["n"] >= least]
        size = next(sizes)
        best = [Row(**r) for r in sorted(rows, key=lambda r: (-r["n"], r["l"], r["r"]))[: size + 1]]
        if not best:
            break
        rounds += 1
        head, last = bpe._cut(best, size)
        keys = bpe._head_keys([(table.number(r.l), table.number(r.r)) for r in head])
        runs = [(np.frombuffer(r["run"], np.int32).tolist(), r["n"]) for b in bpe._run_counter(keys)([batch]) for r in b.to_pylist()]
        found = bpe.next_merges(runs, table.name, set(table.numbers), last, n - len(out), min_frequency, longest, bpe.FIRST_MERGE + len(table.numbers))
        rules = {}
        for left, right, _, count in found:
            out.append((table.name(left), table.name(right), count))
            rules[left, right] = (len(rules), table.add(table.name(left) + table.name(right)))
        batch = next(bpe._merger(keys, rules)([batch])).select(["ids", "n"])
    return out, rounds


@pytest.mark.parametrize("seed", range(200))
def test_any_head_gives_the_same_merges(seed):
    rng = random.Random(1000 + seed)
    words, longest, least = random_words(rng), rng.randint(2, 16), rng.choice([0, 0, 8])
    sizes = iter(lambda: rng.choice([1, 2, 3, 7, 40, 1000]), None)
    got, _ = in_rounds(words, 40, sizes, least, longest)
    assert got == one_at_a_time(words, 40, least, longest)


def test_a_round_finds_many_merges():
    rng = random.Random(3)
    stems = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    words = {a + b: rng.randint(1, 10_000) for a in stems for b in rng.sample(stems, 4)}
    got, rounds = in_rounds(words, 300, iter(lambda: 400, None), 0, 16)
    assert got == one_at_a_time(words, 300) and rounds <= 12


def test_pair_counts_of_short_words(spark):
    counts = spark.createDataFrame([("a", 3), ("ab", 2)], "piece string, n long")
    rows = bpe.bpe_pair_counts(bpe.to_words(counts)).collect()
    assert [(r.l, r.r, r.n) for r in rows] == [("a", "b", 2)]
    assert bpe.bpe_pair_counts(bpe.to_words(counts), min_frequency=3).count() == 0


def test_nothing_to_learn(spark):
    assert learned(spark, {"a": 3}, 5) == []

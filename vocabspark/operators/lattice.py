"""Tokens that stand in pieces: substrings as columns, their join with a token table, and path sums.

The path sums (forward and backward scores, best path scores, expected counts) run inside tasks, on many pieces of
one length at a time. A token is looked up by a 64-bit hash of its characters. Pieces of any length
are read a window at a time, with the windows' borders handed on in the scores of the positions, so that
memory beside the piece itself does not grow with its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.session import checkpoint

# Positions of a piece, or of pieces of one length together, that are looked up at once.
WINDOW = 16_384
# Characters of a text whose substrings are made in one row.
WINDOW_CHARS = 4096
# Characters of a piece whose paths are summed as probabilities, and the probability below which they are not.
SHORT, LEAST_CHANCE = 64, 1e-200


def windows(piece: Column, overlap: int, width: int = WINDOW_CHARS) -> Column:
    """Array of ``(at, text)``: the piece in windows of ``width`` characters, each with the ``overlap`` that follow."""
    starts = F.when(F.length(piece) > 0, F.sequence(F.lit(0), F.length(piece) - 1, F.lit(width)))
    cut = F.transform(
        starts, lambda at: F.struct(at.alias("at"), F.substring(piece, at + 1, F.lit(width + overlap)).alias("text"))
    )
    return F.coalesce(cut, F.array())


def substrings(text: Column, max_length: int, starts: int = WINDOW_CHARS) -> Column:
    """Array of all substrings up to ``max_length`` characters that begin among the first ``starts``."""
    begins = F.when(
        F.length(text) > 0, F.sequence(F.lit(0), F.least(F.length(text), F.lit(starts)) - 1)
    )

    def from_start(start: Column) -> Column:
        longest = F.least(F.lit(max_length), F.length(text) - start)
        return F.transform(F.sequence(F.lit(1), longest), lambda n: F.substring(text, start + 1, n))

    return F.coalesce(F.flatten(F.transform(begins, from_start)), F.array())


def counted_substrings(pieces: DataFrame, piece: Column, max_length: int, n: str) -> DataFrame:
    """``(token, n)``: every substring of up to ``max_length`` characters, with the sum of ``n`` over its places.

    What begins at each character is cut to ``max_length`` and summed first, since many pieces share these tails. In the
    order of the tails, those with one prefix stand together: each task sums its own, and only prefixes at the border of
    a batch, ``2 * max_length`` a batch, are shuffled again. Written out, since both kinds are read from it.
    """
    cut = pieces.select(n, F.explode(windows(piece, max_length - 1)["text"]).alias("_text"))
    begins = F.sequence(F.lit(1), F.least(F.length("_text"), F.lit(WINDOW_CHARS)))
    tails = F.transform(begins, lambda at: F.substring(F.col("_text"), at, F.lit(max_length)))
    summed = cut.select(n, F.explode(tails).alias("tail")).groupBy("tail").agg(F.sum(n).cast("long").alias("n"))
    ranged = summed.repartitionByRange("tail").sortWithinPartitions("tail")
    found = checkpoint(ranged.mapInArrow(_prefix_sums(max_length), "token string, n long, border boolean"))
    border = found.where("border").groupBy("token").agg(F.sum("n").alias("n"))
    return found.where("not border").select("token", F.col("n").alias(n)).unionByName(border.select("token", F.col("n").alias(n)))


def _prefix_sums(longest: int):
    """Sorted ``(tail, n)`` to the prefixes of each batch, and whether the batches beside it may have one too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails, n = batch.column("tail"), batch.column("n").to_numpy()
            texts = tails.to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            points = np.full((len(texts), longest), -1, np.int32)
            points[np.arange(longest) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32)
            new = np.ones(points.shape, bool)
            new[1:] = np.logical_or.accumulate(points[1:] != points[:-1], axis=1)
            for size in range(1, longest + 1):
                held = sizes >= size
                begins = np.flatnonzero(held & new[:, size - 1])
                if len(begins):
                    # Tails between two prefixes that are shorter than this do not count.
                    sums = np.add.reduceat(np.where(held, n, 0), begins)
                    border = np.zeros(len(begins), bool)
                    border[[0, -1]] = True
                    tokens = pc.utf8_slice_codeunits(tails.take(pa.array(begins)), 0, size)
                    yield pa.RecordBatch.from_arrays([tokens, pa.array(sums), pa.array(border)], names=["token", "n", "border"])

    return run


def skew_join(many: DataFrame, table: DataFrame, key: str, spread: Column) -> DataFrame:
    """Inner join of many rows with a table of one row per key; hot keys are split.

    A key with more rows than an average task is cut into as many slices as it has average
    tasks, and its table row is repeated for each slice. There are at most as many hot keys,
    and at most twice as many slices, as shuffle partitions, so the list of them is small
    whatever the data. ``spread`` decides the slice of a row. The table is never broadcast: a few compressed megabytes
    of a shuffle may hold rows that fill the driver.
    """
    tasks = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    slices = F.ceil(F.col("_n") * tasks / total).cast("int").alias("_slices")
    hot = F.broadcast(counts.where(F.col("_n") * tasks > total).select(key, slices))
    number = F.coalesce("_slices", F.lit(1))
    slice_of_row = F.pmod(F.xxhash64(spread), number).cast("int")
    left = many.join(hot, key, "left").withColumn("_slice", slice_of_row).drop("_slices")
    every_slice = F.explode(F.sequence(F.lit(0), number - 1))
    right = table.join(hot, key, "left").withColumn("_slice", every_slice).drop("_slices")
    return left.join(right.hint("merge"), [key, "_slice"]).drop("_slice")


# --- tokens in pieces, inside tasks -------------------------------------------------------------------

# A lexicon is a plain dictionary, so that a broadcast needs no class of this package: "keys" (sorted hashes of the
# tokens), "numbers" (their numbers, in that order), "scores" (by number) and "longest" (characters).


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(points: np.ndarray, longest: int, salt: int = 0) -> Iterator[np.ndarray]:
    """Hashes of all substrings of 1, 2, ... ``longest`` characters of texts of one length, by start."""
    base = np.uint64(0x9E3779B97F4A7C15)
    codes = _mixed((points.astype(np.uint64) + np.uint64(1 + (salt << 32))) * base)
    state = codes
    for length in range(1, min(longest, points.shape[1]) + 1):
        if length > 1:
            state = state[:, :-1] * base + codes[:, length - 1 :]
        yield _mixed(state + np.uint64(length))


def by_length(texts: list[str], most: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts of one length at a time, ``most`` characters or one text together: their places and code points."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(sizes, kind="stable")
    order = order[np.searchsorted(sizes[order], 1) :]
    while len(order):
        size = int(sizes[order[0]])
        many = min(int(np.searchsorted(sizes[order], size, "right")), max(1, most // size))
        rows, order = order[:many], order[many:]
        joined = "".join([texts[i] for i in rows.tolist()]).encode("utf-32-le")
        yield rows, np.frombuffer(joined, np.uint32).reshape(many, size)


def _slots(lexicon: dict) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """By the first bits of a hash: the place of a key that begins so, and whether more keys do; and how many bits are not first.

    Made once a lexicon, with sixteen slots a key or more, so that few keys share one and need a search.
    """
    if "slots" not in lexicon:
        keys = lexicon["keys"]
        width = max(len(keys), 1).bit_length() + 4
        shift = np.uint64(64 - width)
        first = (keys >> shift).view(np.int64)
        place = np.zeros(1 << width, np.int32)
        place[first] = np.arange(len(keys))
        shared = np.zeros(1 << width, bool)
        shared[first[1:][np.diff(first) == 0]] = True
        lexicon["slots"] = place, shared, shift
    return lexicon["slots"]


def places(points: np.ndarray, lexicon: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, starts and numbers of the tokens of 1, 2, ... characters that stand in texts of one length."""
    keys, numbers = lexicon["keys"], lexicon["numbers"]
    place, shared, shift = _slots(lexicon)
    for own in hashes(points, lexicon["longest"], lexicon["salt"]):
        first = (own >> shift).view(np.int64)
        at = place[first]
        search = shared[first]
        at[search] = np.minimum(np.searchsorted(keys, own[search]), len(keys) - 1)
        same = keys[at] == own
        yield *np.nonzero(same), numbers[at[same]]


def lookup(points: np.ndarray, lexicon: dict) -> np.ndarray:
    """Number of the token of each length at each start; -1 where there is none."""
    out = np.full((*points.shape, lexicon["longest"]), -1, np.int32)
    for size, (rows, starts, numbers) in enumerate(places(points, lexicon)):
        out[rows, starts, size] = numbers
    return out


class _Window:
    """Tokens and scores by start, in a stretch of the pieces that reaches ``longest - 1`` over both ends."""

    def __init__(self, points: np.ndarray, lexicon: dict, at: int):
        reach = lexicon["longest"] - 1
        self.start = max(0, at - reach)
        self.stop = min(points.shape[1], at + WINDOW)
        self.tokens = lookup(points[:, self.start : self.stop + reach], lexicon)
        scores = lexicon["scores"]
        self.scores = np.where(self.tokens >= 0, scores[self.tokens], -np.inf)


def _windows(points: np.ndarray, lexicon: dict) -> Callable[[bool], Iterator[tuple[int, _Window]]]:
    """The windows of some pieces, forwards or backwards; one that is the only one is made once."""
    starts = range(0, points.shape[1], WINDOW)
    only = _Window(points, lexicon, 0) if len(starts) == 1 else None

    def each(backwards: bool) -> Iterator[tuple[int, _Window]]:
        for at in reversed(starts) if backwards else starts:
            yield at, only or _Window(points, lexicon, at)

    return each


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(x - top[:, None]).sum(1))


def _best(x: np.ndarray) -> np.ndarray:
    return x.max(1)


def _forward(shape: tuple[int, int], each: Callable, longest: int, reduce: Callable) -> np.ndarray:
    """Score of all paths (or of the best one) from the start to each position."""
    many, size = shape
    out = np.full((many, size + 1), -np.inf)
    out[:, 0] = 0.0
    for at, window in each(False):
        for end in range(at + 1, window.stop + 1):
            width = min(longest, end)
            begins = np.arange(end - 1, end - 1 - width, -1)
            edges = window.scores[:, begins - window.start, np.arange(width)]
            out[:, end] = reduce(out[:, begins] + edges)
    return out


def path_scores(points: np.ndarray, lexicon: dict) -> np.ndarray:
    """Log of the probability of each piece: the sum over all its paths."""
    return _forward(points.shape, _windows(points, lexicon), lexicon["longest"], _log_sum)[:, -1]


def best_scores_without(points: np.ndarray, lexicon: dict) -> np.ndarray:
    """Score of the best path of each piece that does not take it as one token."""
    size = points.shape[1]
    window = _Window(points, lexicon, 0)
    window.scores[:, 0, size - 1 :] = -np.inf
    return _forward(points.shape, lambda _: [(0, window)], lexicon["longest"], _best)[:, -1]


def add_expected_counts(points: np.ndarray, n: np.ndarray, lexicon: dict, total: np.ndarray) -> None:
    """Add to ``total``, by token number, how often each token is expected in pieces that occur ``n`` times.

    Short pieces are summed as probabilities; those too unlikely for that, and long ones, as logarithms.
    """
    if points.shape[1] <= min(SHORT, WINDOW):
        left = _add_short(points, n, lexicon, total)
        points, n = points[left], n[left]
    if len(points):
        _add_by_logs(points, n, lexicon, total)


def _add_short(points: np.ndarray, n: np.ndarray, lexicon: dict, total: np.ndarray) -> np.ndarray:
    """Adds the pieces that have a path of a probability far from the smallest number; whether each is left."""
    many, size = points.shape
    chances = np.exp(lexicon["scores"])
    found = [(rows, starts, numbers, chances[numbers]) for rows, starts, numbers in places(points, lexicon)]
    edges = []
    for length, (rows, starts, _, chance) in enumerate(found, start=1):
        edges.append(np.zeros((size - length + 1, many)))
        edges[-1][starts, rows] = chance
    forward, backward = np.zeros((size + 1, many)), np.zeros((size + 1, many))
    forward[0] = backward[size] = 1.0
    for end in range(1, size + 1):
        for length in range(1, min(len(edges), end) + 1):
            forward[end] += forward[end - length] * edges[length - 1][end - length]
    for begin in range(size - 1, -1, -1):
        for length in range(1, min(len(edges), size - begin) + 1):
            backward[begin] += edges[length - 1][begin] * backward[begin + length]
    whole = forward[size]
    left = ~(whole > LEAST_CHANCE)
    weight = np.where(left, 0.0, n / np.where(left, 1.0, whole))
    for length, (rows, starts, numbers, chance) in enumerate(found, start=1):
        np.add.at(total, numbers, forward[starts, rows] * chance * backward[starts + length, rows] * weight[rows])
    return left


def _add_by_logs(points: np.ndarray, n: np.ndarray, lexicon: dict, total: np.ndarray) -> None:
    size, longest = points.shape[1], lexicon["longest"]
    each = _windows(points, lexicon)
    forward = _forward(points.shape, each, longest, _log_sum)
    whole = forward[:, -1:]
    with np.errstate(invalid="ignore"):
        forward = np.where(np.isfinite(whole), forward - whole, -np.inf)
    backward = np.full(forward.shape, -np.inf)
    backward[:, size] = 0.0
    for at, window in each(True):
        for begin in range(window.stop - 1, at - 1, -1):
            width = min(longest, size - begin)
            edges = window.scores[:, begin - window.start, :width]
            backward[:, begin] = _log_sum(backward[:, begin + 1 : begin + 1 + width] + edges)
        for length in range(1, min(longest, size) + 1):
            stop = min(window.stop, size - length + 1)
            if stop <= at:
                break
            own = slice(at - window.start, stop - window.start)
            tokens = window.tokens[:, own, length - 1]
            share = np.exp(
                forward[:, at:stop] + window.scores[:, own, length - 1] + backward[:, at + length : stop + length]
            )
            used = (tokens >= 0) & (share > 0)
            np.add.at(total, tokens[used], (share * n[:, None])[used])


def best_path(piece: str, scores: dict[str, float], longest: int, unknown: float) -> list[str]:
    """Tokens of the best-scoring path; ties go to the longer last token.

    A character that is no token may stand alone at the score ``unknown``. Memory is two numbers a character.
    """
    best, begin = [0.0], [0]
    for end in range(1, len(piece) + 1):
        top, at = -np.inf, end - 1
        for start in range(max(0, end - longest), end):
            score = scores.get(piece[start:end])
            if score is None:
                if start < end - 1:
                    continue
                score = unknown
            if best[start] + score > top:
                top, at = best[start] + score, start
        best.append(top)
        begin.append(at)
    path, end = [], len(piece)
    while end > 0:
        path.append(piece[begin[end] : end])
        end = begin[end]
    return path[::-1]

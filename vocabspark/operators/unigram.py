"""Learn a unigram vocabulary: seed substrings, expectation-maximization, pruning.

A round reads the distinct pieces, finds the tokens that stand in them and adds up expected token counts
inside the tasks, for many pieces of one length at a time; at most one row per token and task is shuffled. Nothing is
kept per place of a token, so the pieces are all that is stored. What is sent to the tasks and held by the
driver are 24 bytes per token that is still in the race: it grows with the vocabulary asked for, never with
the corpus (25 MB for a seed of 1,024,000 tokens).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.operators.lattice import (
    add_expected_counts,
    best_scores_without,
    by_length,
    counted_substrings,
    hashes,
    path_scores,
)
from vocabspark.operators.order import first_rows, with_running_index
from vocabspark.session import checkpoint, task_count

SEED_FACTOR = 10
PIECES_PER_TASK = 50_000
# A longer substring must be seen as often as this to be a seed.
MIN_SEED_COUNT = 2


def unigram_seed(counts: DataFrame, max_length: int = 16) -> DataFrame:
    """``(token, n)``: every substring up to ``max_length``, weighted by its pieces' counts."""
    return counted_substrings(counts, F.col("piece"), max_length, "n")


def seed_vocab(
    counts: DataFrame, max_length: int, seed_size: int, min_count: int = MIN_SEED_COUNT
) -> DataFrame:
    """Start vocabulary ``(token, logprob)``.

    All characters, and the ``seed_size`` longer substrings that cover most text, of those seen ``min_count`` times.
    """
    frequent = (F.col("n") >= min_count) | (F.length("token") == 1)
    seeds = unigram_seed(counts, max_length).where(frequent)
    seeds = checkpoint(seeds.withColumn("cover", F.col("n") * F.length("token")))
    single = seeds.where(F.length("token") == 1)
    longer = seeds.where(F.length("token") > 1).withColumn("_less", -F.col("cover"))
    chosen = single.unionByName(first_rows(longer, seed_size, ["_less", "token"]).drop("_less"))
    total = chosen.agg(F.sum("cover")).scalar()
    return chosen.select("token", F.log(F.col("cover") / total).alias("logprob"))


# --- the lexicon --------------------------------------------------------------------------------------


def _token_hashes(salt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for rows, points in by_length(batch.column("token").to_pylist()):
                *_, whole = hashes(points, points.shape[1], salt)
                out[rows] = whole[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out.view(np.int64))], names=["id", "hash"])

    return run


class Race:
    """Tokens still in the race, by number: scores in the driver, and the lexicon that tasks read."""

    def __init__(self, tokens: DataFrame):
        """``tokens``: ``(id, token, logprob)`` with ids 0, 1, ... in the order of the tokens."""
        table = tokens.select("id", "logprob", F.length("token").cast("int").alias("length")).toArrow()
        order = np.argsort(table["id"].to_numpy())
        self.scores = table["logprob"].to_numpy()[order].astype(float)
        self.lengths = table["length"].to_numpy()[order]
        self.alive = np.arange(len(order))
        self.salt, self.hashes = 0, np.zeros(0, np.uint64)
        # Two tokens of one hash (one chance in a million for a million tokens): hash all anew.
        while True:
            made = tokens.select("id", "token").mapInArrow(_token_hashes(self.salt), "id long, hash long").toArrow()
            self.hashes = np.empty(len(order), np.uint64)
            self.hashes[made["id"].to_numpy()] = made["hash"].to_numpy().view(np.uint64)
            if len(np.unique(self.hashes)) == len(order):
                return
            self.salt += 1

    def lexicon(self) -> dict:
        """Tokens still in the race, as plain arrays; their numbers count only these."""
        keys = self.hashes[self.alive]
        by_key = np.argsort(keys)
        return {
            "keys": keys[by_key],
            "numbers": by_key.astype(np.int32),
            "scores": self.scores[self.alive],
            "longest": int(self.lengths[self.alive].max(initial=1)),
            "salt": self.salt,
        }


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


# --- rounds -------------------------------------------------------------------------------------------


def expected_counts(pieces: DataFrame, lexicon: dict) -> np.ndarray:
    """How often each token is expected in ``(piece, n)``, by number.

    Each task adds up its own pieces, so at most one row per token leaves a task.
    """
    shared = pieces.sparkSession.sparkContext.broadcast(lexicon)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        total = np.zeros(len(lexicon["scores"]))
        for batch in batches:
            n = _column(batch, "n").astype(float)
            for rows, points in by_length(batch.column("piece").to_pylist()):
                add_expected_counts(points, n[rows], lexicon, total)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "c"])

    counted = pieces.select("piece", "n").mapInArrow(count, "id long, c double")
    table = counted.groupBy("id").agg(F.sum("c").alias("c")).toArrow()
    shared.unpersist()
    out = np.zeros(len(lexicon["scores"]))
    out[table["id"].to_numpy()] = np.round(table["c"].to_numpy(), 9)
    return out


def maximize(pieces: DataFrame, race: Race) -> np.ndarray:
    """One round: expected counts under the scores, then scores from the counts, which are returned."""
    counts = np.maximum(expected_counts(pieces, race.lexicon()), 1e-9)
    race.scores[race.alive] = np.log(counts / counts.sum())
    return counts


def log_likelihood(pieces: DataFrame, race: Race) -> float:
    """Log likelihood of the pieces under the scores."""
    shared = pieces.sparkSession.sparkContext.broadcast(race.lexicon())

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = _column(batch, "n"), 0.0
            for rows, points in by_length(batch.column("piece").to_pylist()):
                total += float((n[rows] * path_scores(points, shared.value)).sum())
            yield pa.RecordBatch.from_pydict({"ll": [total]})

    return float(pieces.select("piece", "n").mapInArrow(add_up, "ll double").agg(F.sum("ll")).first()[0])


def losses(tokens: DataFrame, race: Race, used: np.ndarray) -> np.ndarray:
    """What dropping each token still in the race costs; 0 for characters, which are never dropped.

    The loss is how often the token is expected times what its best other segmentation costs.
    """
    place = np.full(len(race.scores), -1, np.int32)
    place[race.alive] = np.arange(len(race.alive), dtype=np.int32)
    shared = tokens.sparkSession.sparkContext.broadcast((race.lexicon(), used, place))

    def lose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, used, place = shared.value
        for batch in batches:
            own = place[_column(batch, "id")]
            texts = [t if k >= 0 else "" for t, k in zip(batch.column("token").to_pylist(), own.tolist())]
            out = np.zeros(batch.num_rows)
            for rows, points in by_length(texts):
                if points.shape[1] > 1:
                    number = own[rows]
                    other = best_scores_without(points, lexicon)
                    out[rows] = np.round(used[number] * (lexicon["scores"][number] - other), 9)
            yield pa.RecordBatch.from_arrays([pa.array(own[own >= 0]), pa.array(out[own >= 0])], names=["id", "loss"])

    table = tokens.select("id", "token").mapInArrow(lose, "id int, loss double").toArrow()
    shared.unpersist()
    found = np.zeros(len(race.alive))
    found[table["id"].to_numpy()] = table["loss"].to_numpy()
    return found


def prune(race: Race, lost: np.ndarray, room: int) -> None:
    """Keep all characters and the ``room`` longer tokens with the greatest losses; ties go to the smaller token."""
    single = race.lengths[race.alive] == 1
    longer = np.flatnonzero(~single)
    ranked = longer[np.argsort(-lost[longer], kind="stable")]
    race.alive = race.alive[np.sort(np.concatenate((np.flatnonzero(single), ranked[: max(room, 0)])))]


def train_unigram(
    counts: DataFrame,
    budget: int,
    max_piece_length: int = 16,
    em_rounds: int = 2,
    keep_ratio: float = 0.75,
    seed_size: int | None = None,
    min_seed_count: int = MIN_SEED_COUNT,
) -> DataFrame:
    """Vocabulary ``(token, logprob)`` of at most ``budget`` tokens, from ``(piece, n)``.

    Characters are never pruned, so a corpus with more characters than ``budget`` gives
    more tokens.
    """
    seed_size = SEED_FACTOR * budget if seed_size is None else seed_size
    counts = checkpoint(counts.where(F.length("piece") > 0))
    seeds = seed_vocab(counts, max_piece_length, seed_size, min_seed_count)
    tokens = checkpoint(with_running_index(seeds, ["token"], "id"))
    if not tokens.count():
        return tokens.select("token", "logprob")
    # In the order of their lengths, so that a batch holds many pieces of one length.
    pieces = counts.repartition(task_count(counts, PIECES_PER_TASK)).sortWithinPartitions(F.length("piece"))
    pieces = checkpoint(pieces)
    race = Race(tokens)
    while True:
        for _ in range(em_rounds):
            used = maximize(pieces, race)
        alive = len(race.alive)
        if alive <= budget:
            break
        room = max(budget, int(alive * keep_ratio)) - int((race.lengths[race.alive] == 1).sum())
        prune(race, losses(tokens, race, used), room)
        if len(race.alive) == alive:
            break
    kept = pa.table({"id": race.alive, "logprob": np.round(race.scores[race.alive], 9)})
    scored = tokens.sparkSession.createDataFrame(kept)
    return tokens.select("token", "id").join(scored, "id").select("token", "logprob")

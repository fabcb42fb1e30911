"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are words (runs of letters, digits and non-ASCII characters, A-Z lower-cased) in chains of
one line each. A token is labelled from the documents' labels: in a toxic document, a word or
a word beginning that toxic documents of the sample hold far more often than others marks its token
as toxic; all other tokens, and all tokens of other documents, are not. Features of a token are the
word, its first three to six bytes, its last three, and the words beside it, hashed into a fixed
table. The field is fitted on a bounded sample of labelled rows; every document is scored
whole: forward and backward passes give each token's marginal probability, their sum and maximum are
turned into a score by a logistic curve fitted on the same sample, and tokens above one half are the
offending offsets. Scoring is narrow: what goes to the tasks is the table of weights, whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.tables import by_chunk, fields_of, freed, tidy
from vocabspark.llm.words import NOT_ALNUM, Words, chunks, mix, text_buffer, words_of

# Labelled rows of each class that are fitted on, and the most bytes one of them may have.
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 20_000
# Bytes of text whose tokens a task holds at once: some 100 bytes for each token.
CHUNK_BYTES = 512 << 10
# Weights of the field: hashed features.
TABLE_BITS = 20
KINDS = 8
# A word marks toxic tokens if it is in so many toxic documents and so many times likelier there.
MARK_DOCS = 3
MARK_RATIO = 20.0
EPOCHS = 25
RATE = 0.5
PENALTY = 1e-4


@dataclass
class Model:
    """A fitted field: feature weights, transition scores between (other, toxic), and the score curve."""

    weights: np.ndarray
    moves: np.ndarray  # 2 x 2
    curve: np.ndarray  # of (1, log1p(sum of marginals), largest marginal)


@dataclass
class Chains:
    """Tokens of a chunk of texts in chains, chain by chain."""

    features: np.ndarray  # KINDS x tokens, places in the table
    words: Words
    bounds: np.ndarray  # token where each chain begins, one more than chains


def chains(column: pa.Array) -> Chains:
    """Tokens, their features, and their chains: the lines of each text."""
    data, offsets = text_buffer(column)
    found = words_of(column, NOT_ALNUM)
    n = len(found.hashes)
    if not n:
        return Chains(np.zeros((KINDS, 0), np.int32), found, np.zeros(1, np.int64))
    lines = np.flatnonzero(data == 0x0A)
    line = np.searchsorted(lines, found.starts) + found.docs()
    bounds = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    bounds = np.append(bounds, n)
    folded = np.arange(256, dtype=np.uint64)
    folded[0x41:0x5B] += np.uint64(32)
    table = np.empty((KINDS, n), np.int32)
    rows = iter(range(KINDS))

    def put(values: np.ndarray) -> None:
        """Places in the table of the next kind of feature."""
        at = next(rows)
        salt = np.uint64(0xA24BAED4963EE407 * (at + 1) & (2**64 - 1))
        table[at] = mix(values ^ salt) >> np.uint64(64 - TABLE_BITS)

    put(found.hashes)
    length = found.ends - found.starts
    head = np.zeros(n, np.uint64)
    for j in range(6):
        at = np.minimum(found.starts + j, len(data) - 1)
        head = head * np.uint64(257) + np.where(j < length, folded[data[at]] + np.uint64(1), np.uint64(0))
        if j >= 2:
            put(head)
    tail = np.zeros(n, np.uint64)
    for j in range(3):
        tail = tail * np.uint64(257) + np.where(j < length, folded[data[np.maximum(found.ends - 1 - j, 0)]], np.uint64(0))
    put(tail)
    beside = np.zeros(n, np.uint64)
    beside[1:] = found.hashes[:-1]
    beside[bounds[:-1]] = 1
    put(beside)
    beside[:-1] = found.hashes[1:]
    beside[bounds[1:] - 1] = 2
    put(beside)
    return Chains(table, found, bounds)


def _by_length(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains from the longest to the shortest, and how many have a token at each place."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max()) if len(sizes) else 0
    alive = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(1, longest + 1), "left")
    return bounds[:-1][order], sizes[order], alive


def marginals(emission: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability that each token is toxic, expected moves, and the log partition sum.

    ``emission`` is the score of toxic over other. All chains advance together, one place at a
    time; the passes are rescaled at each place, so their length does not matter.
    """
    starts, sizes, alive = _by_length(bounds)
    n = len(emission)
    odds = np.exp(np.clip(emission, -30, 30))
    step = np.exp(moves)
    forward0, forward1 = np.empty(n), np.empty(n)
    log_z = 0.0
    for t, k in enumerate(alive):
        at = starts[:k] + t
        if t:
            p0, p1 = forward0[at - 1], forward1[at - 1]
            f0 = p0 * step[0, 0] + p1 * step[1, 0]
            f1 = (p0 * step[0, 1] + p1 * step[1, 1]) * odds[at]
        else:
            f0, f1 = np.ones(k), odds[at].copy()
        total = f0 + f1
        log_z += float(np.log(total).sum())
        forward0[at], forward1[at] = f0 / total, f1 / total
    toxic = np.empty(n)
    expected = np.zeros((2, 2))
    back0 = back1 = np.zeros(0)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = starts[:k] + t
        b0, b1 = np.ones(k), np.ones(k)
        if t + 1 < len(alive):
            m = alive[t + 1]
            e1 = odds[at[:m] + 1] * back1
            b0[:m] = step[0, 0] * back0 + step[0, 1] * e1
            b1[:m] = step[1, 0] * back0 + step[1, 1] * e1
            f0, f1 = forward0[at[:m]], forward1[at[:m]]
            joint = np.stack([f0 * step[0, 0] * back0, f0 * step[0, 1] * e1, f1 * step[1, 0] * back0, f1 * step[1, 1] * e1])
            expected += (joint / joint.sum(0)).sum(1).reshape(2, 2)
            total = b0[:m] + b1[:m]
            b0[:m] /= total
            b1[:m] /= total
        f0, f1 = forward0[at] * b0, forward1[at] * b1
        toxic[at] = f1 / (f0 + f1)
        back0, back1 = b0, b1
    return toxic, expected, log_z


def emissions(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of toxic over other of each token: the sum of its features' weights, added kind by kind."""
    total = np.zeros(features.shape[1])
    for row in features:
        total += weights[row]
    return total


def _marked(one: Chains, doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Labels of tokens from labels of documents: the word and its first four to six bytes tell."""
    size = 1 << TABLE_BITS
    marked = np.zeros(len(doc), bool)
    n_toxic, n_other = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    for kind in (0, 2, 3, 4):
        pair = np.unique(one.features[kind].astype(np.int64) * len(toxic) + doc)
        place, owner = pair // len(toxic), pair % len(toxic)
        with_it = np.bincount(place[toxic[owner]], minlength=size)
        without = np.bincount(place[~toxic[owner]], minlength=size)
        ratio = (with_it + 0.5) / n_toxic / ((without + 0.5) / n_other)
        telling = (with_it >= MARK_DOCS) & (ratio >= MARK_RATIO)
        marked |= telling[one.features[kind]]
    return marked & toxic[doc]


def fit(texts: list[str], toxic: list[bool]) -> Model:
    """The field and the score curve from a bounded sample; runs on the driver."""
    label = np.array(toxic, bool)
    model = Model(np.zeros(1 << TABLE_BITS, np.float32), np.zeros((2, 2)), np.array([np.log((label.sum() + 0.5) / ((~label).sum() + 0.5)), 0.0, 0.0]))
    if not label.any() or label.all():
        return model
    one = chains(pa.array(texts, pa.large_string()))
    doc = one.words.docs()
    gold = _marked(one, doc, label)
    if not gold.any():
        return model
    inner = np.ones(len(gold), bool)
    inner[one.bounds[:-1]] = False  # tokens with one before them in the chain
    pair = 2 * gold[np.flatnonzero(inner) - 1].astype(int) + gold[inner]
    seen_moves = np.bincount(pair, minlength=4).reshape(2, 2).astype(float)
    weights, moves = np.zeros(1 << TABLE_BITS), np.zeros((2, 2))
    past, past_moves = np.full(len(weights), 1e-8), np.full((2, 2), 1e-8)
    count = len(gold)
    for _ in range(EPOCHS):
        p, expected, _ = marginals(emissions(one.features, weights), moves, one.bounds)
        missed = gold - p
        change = sum(np.bincount(row, missed, len(weights)) for row in one.features) / count - PENALTY * weights / KINDS
        past += change**2
        weights += RATE * change / np.sqrt(past)
        change = (seen_moves - expected) / count
        past_moves += change**2
        moves += RATE * change / np.sqrt(past_moves)
    p, _, _ = marginals(emissions(one.features, weights), moves, one.bounds)
    model.weights, model.moves = weights.astype(np.float32), moves
    x = _summary(p, one.words.bounds)
    y = label.astype(float)
    curve = np.zeros(3)
    for _ in range(30):  # Newton's steps with a small penalty
        q = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (y - q) - 0.05 * curve
        curve = curve + np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(3), slope)
    model.curve = curve
    return model


def _summary(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """What the score is made of, text by text."""
    before = np.append(0, np.cumsum(p))
    total = before[bounds[1:]] - before[bounds[:-1]]
    most = np.zeros(len(bounds) - 1)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        most[full] = np.maximum.reduceat(p, bounds[:-1][full])
    return np.stack([np.ones(len(most)), np.log1p(np.maximum(total, 0)), most], 1)


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most ``rows`` labelled documents of each class, chosen by a hash of the id.

    Labels that are null are not used; of several for one id the highest counts. Documents above
    ``SAMPLE_BYTES`` are not fitted on. Without labelled documents of both classes every score is the
    share of toxic labels.
    """
    known = labels.where("toxic is not null").groupBy(F.col(id).cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    drawn = F.xxhash64("id")
    chosen = known.where("toxic > 0").orderBy(drawn, "id").limit(rows).unionByName(known.where("toxic <= 0").orderBy(drawn, "id").limit(rows))
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    sample = texts.join(F.broadcast(chosen), "id").select("id", "text", "toxic").toArrow()
    sample = sample.sort_by([("id", "ascending"), ("text", "ascending")])
    return freed(fit(sample["text"].to_pylist(), [toxic > 0 for toxic in sample["toxic"].to_pylist()]))


def _scores(column: pa.Array, model: Model) -> tuple[np.ndarray, Chains, np.ndarray]:
    one = chains(column)
    p, _, _ = marginals(emissions(one.features, model.weights), model.moves, one.bounds)
    score = 1 / (1 + np.exp(-np.clip(_summary(p, one.words.bounds) @ model.curve, -700, 700)))
    return score, one, p


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score, spans)`` for every row: a score from 0 to 1, and offending tokens.

    Spans are ``(start, end, p)`` in code points, end exclusive, of tokens with a marginal above
    one half. A null or empty text has no token and the score that the curve gives to none. Rows
    with a null or repeated id are scored like any other; other columns are not read; an empty table
    gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fields_of(model))

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        column = part.column("text")
        scores, found, p = _scores(column, Model(*sent.value))
        spans: list[list] = [[] for _ in range(part.num_rows)]
        hot = np.flatnonzero(p > 0.5)
        if len(hot):
            data, offsets = text_buffer(column)
            chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            owner = np.searchsorted(found.words.bounds, hot, "right") - 1
            base = chars[offsets[owner]]
            begin, end = chars[found.words.starts[hot]] - base, chars[found.words.ends[hot]] - base
            for d, s, e, q in zip(owner.tolist(), begin.tolist(), end.tolist(), p[hot].tolist()):
                spans[d].append({"start": s, "end": e, "p": q})
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        return pa.record_batch({"id": part.column("id"), "score": scores, "spans": pa.array(spans, kind)})

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, score double, spans array<struct<start:int,end:int,p:double>>"
    return rows.mapInArrow(by_chunk(one, "text", CHUNK_BYTES), schema).withColumnRenamed("id", id)


def accepted(docs: DataFrame, model: Model, reject_from: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below ``reject_from``; narrow.

    Only the text goes to Python; the other columns stay where they are. A null or empty text has the
    score that the curve gives to none; rows that repeat go or stay alike; an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fields_of(model))

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(*sent.value)
        for column in columns:
            batch = pa.record_batch({"text": column})
            parts = [_scores(part.column("text"), model)[0] for part in chunks(batch, "text", CHUNK_BYTES)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
            del batch, column, parts
            pa.default_memory_pool().release_unused()
        tidy()

    return docs.where(scored(F.col(text)) < reject_from)

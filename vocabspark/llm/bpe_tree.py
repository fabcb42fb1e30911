"""Byte-level BPE as a monoid: encode halves, join neighbours at a growing boundary window.

Byte strings under concatenation are a monoid, and so are their encodings under this join: the
tokens of ``xy`` are those of ``x`` and ``y`` but for a window around the seam. A token sequence is the
encoding of its bytes if and only if every two neighbouring tokens are the encoding of their own
concatenation. So the window's tokens are final once its outermost pairs pass that test on both sides:
inside the window they are an encoding, outside it the pairs are unchanged. Until then the window grows
on the side that failed. Decoding concatenates the bytes of the tokens up the same tree.

A text is cut by a pattern first and every match is encoded on its own, so texts are independent and
the whole job is narrow: no shuffle, and a task holds the vocabulary and one Arrow batch.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.llm.tables import by_chunk
from vocabspark.llm.words import list_column

# Pieces of up to so many bytes are leaves of the tree.
LEAF_BYTES = 32
# Encodings of pieces and tests of token pairs that a task remembers; then it forgets them all.
REMEMBERED = 250_000
# Tokens that are decoded at once.
DECODED_TOKENS = 1 << 18
_NEVER = np.iinfo(np.int32).max


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line. Read by the driver, which sends it on."""
    if "://" in path:
        lines = [row[0].encode() for row in spark.read.text(path).collect()]
    else:
        with open(path, "rb") as file:
            lines = file.read().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens of a short byte string: the lowest-ranked neighbours merge, leftmost first."""
    if len(piece) > 4 * LEAF_BYTES:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    rank_of = ranks.get
    never = 1 << 62
    pairs = [rank_of(a + b, never) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == never:
            break
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = rank_of(parts[at] + parts[at + 1], never)
        if at:
            pairs[at - 1] = rank_of(parts[at - 1] + parts[at], never)
    return parts


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same by a heap over a linked list: n log n."""
    n = len(piece)
    end = list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(piece[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if end[i] != middle:
            continue
        j = after[i]
        if j >= n or j != middle or end[j] != stop:
            continue
        end[i], end[j] = stop, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(piece[i : end[i]])
        i = after[i]
    return out


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``which`` names, one after another, and where each begins and the last ends."""
    wide = sizes[which]
    at = np.append(0, np.cumsum(wide))
    return flat[np.repeat(starts[which] - at[:-1], wide) + np.arange(at[-1])], at


def mergeable(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens whose concatenation is a token of at most a leaf's length, sorted, and that token."""
    found = {}
    for token, rank in ranks.items():
        if len(token) <= LEAF_BYTES:
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
    keys = np.fromiter(found, np.int64, len(found))
    order = np.argsort(keys)
    return keys[order], np.fromiter(found.values(), np.int32, len(found))[order]


class Encoder:
    """Encodes with one vocabulary; lives in a task. ``merges`` are the vocabulary's mergeable pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, merges: tuple[np.ndarray, np.ndarray]) -> None:
        self.ranks = ranks
        self.cut = regex.compile(pattern)
        self.pieces: dict[str, list[int]] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.keys, self.merged = merges
        self.alphabet = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        every = np.arange(256)
        self.first = self.rank_of(self.alphabet[np.repeat(every, 256)], self.alphabet[np.tile(every, 256)])
        self.passing: list[str] = []  # long pieces, remembered for one chunk only

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of concatenations of tokens; the highest number where they are no token."""
        if not len(self.keys):
            return np.full(len(left), _NEVER, np.int32)
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.merged[at], _NEVER)

    def leaves(self, texts: list[str], raws: list[bytes]) -> None:
        """Encodes many leaves side by side: in each round every unfinished one does its next merge.

        A merge shortens a leaf by one token, so leaves of one width stay together, and those of the next
        width join them.
        """
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        data = np.frombuffer(b"".join(raws), np.uint8)
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        widths = sizes[order]
        who, tokens, ranks = np.zeros(0, np.int64), None, None
        for width in range(int(widths[0]) if len(widths) else 0, 0, -1):
            fresh = order[np.searchsorted(-widths, -width, "left") : np.searchsorted(-widths, -width, "right")]
            if len(fresh):
                raw = data[starts[fresh][:, None] + np.arange(width)]
                begun = self.first[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]]
                own = self.alphabet[raw]
                tokens = own if tokens is None else np.concatenate([tokens, own])
                ranks = begun if ranks is None else np.concatenate([ranks, begun])
                who = np.concatenate([who, fresh])
            if not len(who):
                tokens = ranks = None
                continue
            at = ranks.argmin(1) if width > 1 else np.zeros(len(who), np.int64)
            best = ranks[np.arange(len(who)), at] if width > 1 else np.full(len(who), _NEVER, np.int32)
            done = best == _NEVER
            for i, ids in zip(who[done].tolist(), tokens[done].tolist()):
                self.pieces[texts[i]] = ids
            more = ~done
            who, at, best, tokens, ranks = who[more], at[more], best[more], tokens[more], ranks[more]
            rows = np.arange(len(who))
            tokens[rows, at] = best
            place = np.arange(width - 1)
            tokens = np.take_along_axis(tokens, place + (place > at[:, None]), 1)
            place = place[: width - 2] if width > 1 else place
            ranks = np.take_along_axis(ranks, place + (place >= at[:, None]), 1)
            for shift in (0, 1):
                side = at - shift
                has = rows[(side >= 0) & (side < width - 2)]
                ranks[has, side[has]] = self.rank_of(tokens[has, side[has]], tokens[has, side[has] + 1])

    def learn(self, wanted: Iterable[str]) -> None:
        """Remembers the ids of all different matches of a chunk; a match that is a token is that token."""
        for text in self.passing:
            self.pieces.pop(text, None)
        wanted = set(wanted)
        new = wanted.difference(self.pieces)
        if len(self.pieces) + len(new) > REMEMBERED:
            self.pieces.clear()
            new = wanted
        self.passing = [text for text in new if len(text) > 4 * LEAF_BYTES]
        texts, raws = [], []
        for text in new:
            raw = text.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.pieces[text] = [whole]
            elif len(raw) <= LEAF_BYTES:
                texts.append(text)
                raws.append(raw)
            else:
                self.pieces[text] = [self.ranks[t] for t in self.reduce(raw)]
        self.leaves(texts, raws)

    def settled(self, left: bytes, right: bytes) -> bool:
        """Whether two neighbouring tokens are the encoding of their concatenation."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[left, right] = merge_bytes(left + right, self.ranks) == [left, right]
        return known

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """Tokens of the concatenation of two encoded strings."""
        a = b = 1
        while True:
            i, j = max(0, len(left) - a), min(len(right), b)
            window = merge_bytes(b"".join(left[i:] + right[:j]), self.ranks)
            left_done = i == 0 or self.settled(left[i - 1], window[0])
            right_done = j == len(right) or self.settled(window[-1], right[j])
            if left_done and right_done:
                return left[:i] + window + right[j:]
            a, b = a if left_done else 2 * a, b if right_done else 2 * b

    def reduce(self, piece: bytes) -> list[bytes]:
        """Encode halves, join them."""
        if len(piece) <= LEAF_BYTES:
            return merge_bytes(piece, self.ranks)
        half = len(piece) // 2
        return self.join(self.reduce(piece[:half]), self.reduce(piece[half:]))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text of a chunk; each different match is looked up once."""
        found = [self.cut.findall(text) if text else [] for text in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        every = pa.array(chain.from_iterable(found), pa.large_string(), size=int(counts.sum())).dictionary_encode()
        different = every.dictionary.to_pylist()
        self.learn(different)
        known = [self.pieces[text] for text in different]
        sizes = np.fromiter(map(len, known), np.int64, len(known))
        ids, at = gathered(np.fromiter(chain.from_iterable(known), np.int32), np.cumsum(sizes) - sizes, sizes, every.indices.to_numpy())
        at = at[np.append(0, np.cumsum(counts))].tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` for every row, special tokens taken as ordinary text.

    A null or empty text has no tokens. Rows with a null or repeated id are encoded like any other;
    other columns are not read; an empty table gives an empty table. Every byte must have a rank. Every
    match of the pattern is encoded on its own, so the pattern must match every character.
    """
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern, mergeable(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*sent.value)

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            ids = encoder.encode(part.column("text").to_pylist())
            return pa.record_batch({"id": part.column("id"), "ids": list_column(ids, pa.int32())})

        yield from by_chunk(one, "text")(batches)

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for; no ids, or null, give no bytes. An unknown id is an error.

    The other columns of ``encoded`` pass through; ``name`` replaces a column of that name.
    """
    encoded = encoded.drop(name)
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = max(sent.value.values(), default=-1) + 1
        known = np.zeros(top, bool)
        known[list(sent.value.values())] = True
        sizes, starts = np.zeros(top, np.int64), np.zeros(top, np.int64)
        ranks = np.fromiter(sent.value.values(), np.int64, len(sent.value))
        sizes[ranks] = np.fromiter(map(len, sent.value), np.int64, len(ranks))
        starts[ranks] = np.cumsum(sizes[ranks]) - sizes[ranks]
        letters = np.frombuffer(b"".join(sent.value), np.uint8)

        def joined(tokens: np.ndarray) -> bytes:
            return gathered(letters, starts, sizes, tokens)[0].tobytes()

        for batch in batches:
            column = batch.column(ids)
            if not isinstance(column, pa.ListArray):
                column = column.cast(pa.list_(pa.int32()))
            for start in range(0, batch.num_rows, 256):
                part, own = batch.slice(start, 256), column.slice(start, 256)
                flat = own.flatten()
                if flat.null_count:
                    raise ValueError("an id is null")
                flat = flat.to_numpy()
                strange = flat[(flat < 0) | (flat >= top) | ~known[np.clip(flat, 0, top - 1)]] if top else flat
                if len(strange):
                    raise ValueError(f"unknown id {strange[0]}")
                whole = b"".join([joined(flat[i : i + DECODED_TOKENS]) for i in range(0, len(flat), DECODED_TOKENS)])
                ends = np.cumsum(pa.compute.fill_null(own.value_lengths(), 0).to_numpy())
                at = [0, *np.append(0, np.cumsum(sizes[flat]))[ends].tolist()]
                raw = [whole[a:b] for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, name]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, `{name}` binary")

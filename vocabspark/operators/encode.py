"""Encode a corpus with a vocabulary and decode it back.

Text is cut into pieces by native expressions. What is left for Python is one Arrow-batched
function from pieces to ids, which remembers the pieces it has seen. With a vocabulary that
fits a checked bound this is a narrow job without any shuffle. A larger one is never sent
whole: each distinct piece is joined with the tokens that stand in it.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.functions.bytelevel import BYTE_TO_CHAR, CHAR_TO_BYTE, to_byte_chars
from vocabspark.functions.normalize import normalize_segments
from vocabspark.functions.splits import apply_steps
from vocabspark.operators.dropout import Draws, Merges
from vocabspark.operators.inventory import UNKNOWN_TOKEN
from vocabspark.operators.lattice import best_path, skew_join, substrings, windows
from vocabspark.operators.matching import segments
from vocabspark.operators.packs import dictionary, flat_numbers, gathered, list_array, packed, sizes_of, stretches, unpacked
from vocabspark.operators.pretokenize import SplitSpec, count_pieces
from vocabspark.session import checkpoint, fits_broadcast, written

PIECES_REMEMBERED = 200_000
# Different pieces that are joined together with their tokens, and their substrings in one row.
PACKED_PIECES = 4_000
PACKED_TOKENS = 200_000
UNKNOWN_PENALTY = 10.0
NOT_IN_MODEL = ("special", "whitespace")
FALLBACK = "^<0x[0-9A-F]{2}>$"
# What decoding shows for a piece of text that has no id.
NO_ID_BYTES = "\ufffd".encode()

_BYTE_TABLE = dict(enumerate(BYTE_TO_CHAR))


@dataclass(frozen=True)
class Vocabulary:
    """A finished vocabulary: ``tokens(token, id, kind[, logprob])`` and, for BPE, ``merges``."""

    tokens: DataFrame
    merges: DataFrame | None = None
    spec: SplitSpec = field(default_factory=SplitSpec)

    @property
    def model(self) -> str:
        return "unigram" if self.merges is None else "bpe"

    def added(self) -> DataFrame:
        """Tokens cut out of the text before anything else; fallback tokens stand for bytes."""
        fallback = F.col("token").rlike(FALLBACK) & F.lit(self.spec.byte_fallback)
        return self.tokens.where(F.col("kind").isin(*NOT_IN_MODEL) & ~fallback)

    def unknown_score(self) -> float:
        """Score of a character outside the vocabulary: well below the unlikeliest token."""
        if self.model == "bpe":
            return 0.0
        return (self.tokens.agg(F.min("logprob")).first()[0] or 0.0) - UNKNOWN_PENALTY

    def lexicon(self) -> DataFrame:
        """One row per token that may stand in a piece: ``(token, id, logprob, rules)``."""
        model = self.tokens.where(~F.col("kind").isin(*NOT_IN_MODEL))
        if self.merges is None:
            rules = F.array().cast("array<struct<left:string,right:string,rank:int>>")
            return model.select("token", "id", "logprob", rules.alias("rules"))
        rules = self.merges.groupBy("token").agg(
            F.collect_list(F.struct("left", "right", "rank")).alias("rules")
        )
        return model.join(rules, "token", "left").select(
            "token", "id", F.lit(None).cast("double").alias("logprob"), "rules"
        )


def _lookup(tokens, ids, logprobs, rules, unknown: float) -> dict:
    """Lookup tables for pieces, from the columns of :meth:`Vocabulary.lexicon`.

    Plain dictionaries, so that a broadcast needs no class of this package. ``unknown`` is
    the score of a character that no token covers.
    """
    tokens = list(tokens)
    ranks = {
        (rule["left"], rule["right"]): rule["rank"]
        for some in rules
        if some is not None
        for rule in some
    }
    return {
        "ids": dict(zip(tokens, ids)),
        "scores": dict(zip(tokens, logprobs)),
        "ranks": ranks,
        "longest": max(map(len, tokens), default=1),
        "unknown": unknown,
    }


def draws(key: str, dropout: float) -> Callable[[], bool]:
    """Whether to skip, step by step: draw ``k`` is from the first 32 bits of ``md5(key:k)``.

    A draw depends on nothing but its key and step, so any engine can repeat it.
    """
    steps, limit = itertools.count(), dropout * 2**32
    return lambda: int.from_bytes(md5(f"{key}:{next(steps)}".encode()).digest()[:4], "big") < limit


def merge_piece(symbols: list[str], ranks: dict, skip: Callable[[], bool] | None = None) -> list[str]:
    """Apply merge rules to one piece: lowest rank first, then leftmost.

    A merge that comes up when ``skip`` says so is left out and tried again after the next merge is made.
    """
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    queue: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(symbols):
            rank = ranks.get((symbols[i], symbols[after[i]]))
            if rank is not None:
                heapq.heappush(queue, (rank, i, symbols[i], symbols[after[i]]))

    for i in range(len(symbols) - 1):
        offer(i)
    skipped = []
    while queue:
        rule = heapq.heappop(queue)
        _, i, left, right = rule
        if symbols[i] != left or after[i] >= len(symbols) or symbols[after[i]] != right:
            continue
        if skip is not None and skip():
            skipped.append(rule)
            continue
        gone = after[i]
        symbols[i], symbols[gone] = left + right, None
        after[i] = after[gone]
        if after[i] < len(symbols):
            before[after[i]] = i
        for again in skipped:
            heapq.heappush(queue, again)
        skipped.clear()
        offer(before[i])
        offer(i)
    return [s for s in symbols if s is not None]


def to_byte_text(piece: str) -> str:
    """The bytes of a piece, a character of the byte alphabet each."""
    return piece.encode().decode("latin-1").translate(_BYTE_TABLE)


def token_ids(token: str, lexicon: dict, fixed: dict, fallback: bool) -> list[int | None]:
    """The id of a token, or those of what stands for it where the vocabulary has none."""
    found = lexicon["ids"].get(token)
    if found is not None:
        return [found]
    if fallback:
        return [fixed[f"<0x{b:02X}>"] for b in token.encode()]
    return [fixed.get(UNKNOWN_TOKEN)]


def _segment(piece: str, lexicon: dict, model: str, skip: Callable[[], bool] | None) -> list[str]:
    if model == "bpe":
        return merge_piece(list(piece), lexicon["ranks"], skip)
    return best_path(piece, lexicon["scores"], lexicon["longest"], lexicon["unknown"])


def _piece_ids(
    piece: str, lexicon: dict, fixed: dict, model: str, fallback: bool, skip: Callable[[], bool] | None = None
) -> list[int | None]:
    """Ids of one piece; ``fixed`` holds the unknown and the fallback tokens.

    What no token covers is the unknown token, or no id where there is none.
    """
    return _ids_and_steps(piece, lexicon, fixed, model, fallback, skip)[0]


def _ids_and_steps(
    piece: str, lexicon: dict, fixed: dict, model: str, fallback: bool, skip: Callable[[], bool] | None = None
) -> tuple[list[int | None], int]:
    """Ids of one piece, and how many merges made them."""
    if not fallback:
        piece = to_byte_text(piece)
    ids: list[int | None] = []
    tokens = _segment(piece, lexicon, model, skip)
    for token in tokens:
        found = lexicon["ids"].get(token)
        if found is not None:
            ids.append(found)
        else:
            ids += token_ids(token, lexicon, fixed, fallback)
    return ids, len(piece) - len(tokens)


def text_pieces(key: str, vocab: Vocabulary) -> Column:
    """Pieces ``(added, text)`` of the text as the vocabulary's inference steps cut it.

    Added tokens are cut out first, before normalization, and stay whole.
    """
    text, steps, form = F.col(key), vocab.spec.inference(), vocab.spec.normal_form

    def cut(segment: Column) -> Column:
        plain = F.transform(
            apply_steps(segment["text"], steps), lambda p: F.struct(F.lit(False).alias("added"), p.alias("text"))
        )
        return F.when(segment["added"], F.array(segment)).otherwise(plain)

    return F.flatten(F.transform(normalize_segments(segments(text, vocab.added()), text, form), cut))


def _ids_of(tokens: DataFrame) -> dict[str, int]:
    return {row.token: row.id for row in tokens.select("token", "id").collect()}


def _fixed_ids(vocab: Vocabulary) -> dict[str, int]:
    """Ids of the unknown token and of the 256 fallback tokens."""
    fixed = (F.col("token") == UNKNOWN_TOKEN) | F.col("token").rlike(FALLBACK)
    return _ids_of(vocab.tokens.where(F.col("kind").isin(*NOT_IN_MODEL) & fixed))


def encode(
    df: DataFrame,
    vocab: Vocabulary,
    key: str = "text",
    ids: Sequence[str] = ("doc_id",),
    dropout: float = 0.0,
    seed: int = 0,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Add ``ids``, the token ids of ``key``.

    ``ids`` names the columns that identify a row. They seed the dropout draws, so a result
    does not depend on partitioning; rows that share them, or have nulls there, are encoded like
    any other.
    """
    if dropout and vocab.model != "bpe":
        raise ValueError("dropout applies to BPE only")
    if fits_broadcast(vocab.tokens, max_broadcast_rows):
        pieces = df.withColumn("_pieces", text_pieces(key, vocab))
        encoder = _broadcast_encoder(vocab, dropout)
        drawn = _row_key(ids, seed) if dropout else F.lit("")
        return pieces.withColumn("ids", encoder("_pieces.text", "_pieces.added", drawn)).drop("_pieces")
    return _encode_by_join(df, vocab, key, list(ids), dropout, seed)


def _row_key(ids: Sequence[str], seed: int) -> Column:
    """What a row's dropout draws start from."""
    return F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])


def _with_row(df: DataFrame) -> DataFrame:
    """Adds ``_row``, a number of its own for each row, written out before it is used twice."""
    return written(df.withColumn("_row", F.monotonically_increasing_id()))


def _broadcast_encoder(vocab: Vocabulary, dropout: float):
    rows = vocab.lexicon().toPandas()
    columns = (rows[c] for c in ("token", "id", "logprob", "rules"))
    lexicon = _lookup(*columns, vocab.unknown_score())
    added = _ids_of(vocab.added())
    shared = vocab.tokens.sparkSession.sparkContext.broadcast((lexicon, added, _fixed_ids(vocab)))
    model, fallback = vocab.model, vocab.spec.byte_fallback

    @F.arrow_udf("array<int>")
    def encode_batch(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lexicon, added, fixed = shared.value
        seen: dict[str, tuple[list[int | None], int]] = {}
        rules = Merges(lexicon["ranks"]) if model == "bpe" else None

        def plain(pieces: list[str]) -> list[tuple[list[int | None], int]]:
            """Ids of different pieces without dropout, and how many merges made them."""
            found = [seen.get(piece) for piece in pieces]
            new = [k for k, known in enumerate(found) if known is None]
            if rules is None:
                made = [_ids_and_steps(pieces[k], lexicon, fixed, model, fallback) for k in new]
            else:
                shown = [pieces[k] if fallback else to_byte_text(pieces[k]) for k in new]
                counts, entries, names = rules.pieces(
                    shown, np.arange(len(shown)), None, lambda k: merge_piece(list(shown[k]), lexicon["ranks"])
                )
                ids = [token_ids(name, lexicon, fixed, fallback) for name in names]
                ends, entries = np.cumsum(counts).tolist(), entries.tolist()
                made = [
                    ([i for e in entries[start:end] for i in ids[e]], len(text) - (end - start))
                    for text, start, end in zip(shown, [0, *ends], ends)
                ]
            for k, known in zip(new, made):
                found[k] = known
                if len(seen) < PIECES_REMEMBERED:
                    seen[pieces[k]] = known
            return found

        def redrawn(pieces: list[tuple], codes: np.ndarray, bounds: np.ndarray, keys: list[str]) -> tuple[np.ndarray, list[tuple], np.ndarray]:
            """A piece none of whose merges is skipped is the plain one: only the others are merged again.

            Gives back the entries that stand at all places, one after another: pieces, or symbols of what was merged
            again; the entries beyond ``pieces``; and where the entries of each place begin and the last end.
            """
            chances = Draws(keys, dropout)
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            pos = np.arange(len(codes)) - bounds[row]
            steps = np.fromiter((n for _, n, _ in pieces), np.int64, len(pieces))[codes]
            first = np.cumsum(steps) - steps
            of = np.repeat(np.arange(len(codes)), steps)
            drawn = chances.skip(row[of], pos[of], np.arange(len(of)) - first[of])
            again = np.unique(of[drawn])

            def skip(items: np.ndarray, step: int) -> np.ndarray:
                at = again[items]
                known = step < steps[at]
                out = np.zeros(len(at), bool)
                out[known] = drawn[first[at[known]] + step]
                at = at[~known]
                out[~known] = chances.skip(row[at], pos[at], np.full(len(at), step))
                return out

            def alone(item: int) -> list[str]:
                at = again[item]
                return merge_piece(list(shown[which[item]]), lexicon["ranks"], draws(f"{keys[row[at]]}:{pos[at]}", dropout))

            different, which = np.unique(codes[again], return_inverse=True)
            texts = [pieces[c][2] for c in different.tolist()]
            shown = texts if fallback else list(map(to_byte_text, texts))
            sizes, symbols, names = rules.pieces(shown, which, skip, alone)
            counts = np.ones(len(codes), np.int64)
            counts[again] = sizes
            place = np.append(0, np.cumsum(counts))
            entries = np.repeat(codes, counts)
            entries[gathered(place[:-1], counts, again)[0]] = symbols + len(pieces)
            return entries, [(token_ids(name, lexicon, fixed, fallback),) for name in names], place

        def some(texts: pa.Array, flags: pa.Array, keys: pa.Array) -> pa.Array:
            """Each different piece is encoded once; a piece that is an added token has no merges."""
            sizes = sizes_of(texts)
            marks = flags.flatten().to_numpy(zero_copy_only=False)
            codes, words = dictionary(texts.flatten())
            codes = codes * 2 + marks
            used = np.zeros(2 * len(words), bool)
            used[codes] = True
            present = np.flatnonzero(used).tolist()
            found = iter(plain([words[c >> 1] for c in present if not c & 1]))
            pieces = [([added[words[c >> 1]]], 0, "") if c & 1 else (*next(found), words[c >> 1]) for c in present]
            codes = (np.cumsum(used) - 1)[codes]
            bounds = np.append(0, np.cumsum(sizes))
            if dropout:
                codes, more, at = redrawn(pieces, codes, bounds, keys.to_pylist())
                pieces, bounds = pieces + more, at[bounds]
            widths = np.fromiter((len(ids) for ids, *_ in pieces), np.int64, len(pieces))
            ids = pa.array(itertools.chain.from_iterable(ids for ids, *_ in pieces), pa.int32())
            place, at = gathered(np.cumsum(widths) - widths, widths, codes)
            return list_array(ids.take(pa.array(place)), np.diff(at[bounds]), texts)

        for texts, flags, keys in batches:
            parts = [some(*(c.slice(a, b - a) for c in (texts, flags, keys))) for a, b in stretches(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    # The result is fixed by the input. Without this mark, the optimizer repeats the whole
    # function in the filters it derives from an explode of the ids.
    return encode_batch.asNondeterministic()


def encode_pieces(
    df: DataFrame,
    vocab: Vocabulary,
    key: str = "text",
    by: Sequence[str] = (),
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """``(by..., piece, added, n, ids)``: each distinct piece per group, counted and encoded once.

    Enough for every report that adds up over tokens, and far less work than encoding whole
    texts: pieces are cut and counted natively, before anything is shuffled or sent to Python.
    """
    counts = count_pieces(df.select(*by, F.explode(text_pieces(key, vocab)).alias("piece")), by)
    if fits_broadcast(vocab.tokens, max_broadcast_rows):
        encoder = _broadcast_encoder(vocab, 0.0)
        done = counts.withColumn("ids", encoder(F.array("piece.text"), F.array("piece.added"), F.lit("")))
    else:
        distinct = _encode_distinct(counts.select("piece").distinct(), vocab)
        done = skew_join(counts, distinct.withColumnRenamed("piece_ids", "ids"), "piece", F.struct(*by, "piece"))
    return done.select(*by, F.col("piece.text").alias("piece"), F.col("piece.added").alias("added"), "n", "ids")


def _local_lexicons(distinct: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``(piece, local)``: for each piece, the lexicon rows of the tokens that stand in it.

    Pieces go by a number, and long ones are cut in windows, so that no row repeats a piece for each of its substrings.
    """
    lexicon = vocab.lexicon()
    longest = lexicon.agg(F.max(F.length("token"))).first()[0] or 1
    text = F.col("piece.text")
    in_model = text if vocab.spec.byte_fallback else to_byte_chars(text)
    numbered = _with_row(distinct)
    cut = numbered.select("_row", F.explode(windows(in_model, longest - 1)["text"]).alias("_text"))
    # A token may come twice where two windows of one piece hold it; looking it up twice changes nothing.
    parts = cut.select("_row", F.explode(F.array_distinct(substrings(F.col("_text"), longest))).alias("token"))
    rows = F.collect_list(F.struct("token", "id", "logprob", "rules"))
    found = skew_join(parts, lexicon, "token", F.col("_row")).groupBy("_row").agg(rows.alias("local"))
    return numbered.join(found.hint("merge"), "_row", "left").drop("_row")


def _local_encoder(vocab: Vocabulary, dropout: float):
    """Function from a piece, its local lexicon and the key of its draws to ids."""
    model, fallback, fixed = vocab.model, vocab.spec.byte_fallback, _fixed_ids(vocab)
    unknown = vocab.unknown_score()

    @F.pandas_udf("array<int>")
    def encode_batch(pieces: pd.Series, locals_: pd.Series, keys: pd.Series) -> pd.Series:
        def one(piece, rows, key):
            rows = [] if rows is None else list(rows)
            columns = ([r[c] for r in rows] for c in ("token", "id", "logprob", "rules"))
            lexicon = _lookup(*columns, unknown)
            skip = draws(key, dropout) if dropout else None
            return _piece_ids(piece, lexicon, fixed, model, fallback, skip)

        return pd.Series([one(*row) for row in zip(pieces, locals_, keys)])

    return encode_batch.asNondeterministic()


def _added_pieces(distinct: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``(piece, piece_ids)`` of the pieces that are added tokens."""
    ids = vocab.added().select(F.col("token").alias("_token"), F.array("id").alias("piece_ids"))
    of = distinct.where("piece.added").join(ids, F.col("piece.text") == F.col("_token"))
    return of.select("piece", "piece_ids")


def _substring_packs(pieces: DataFrame, longest: int) -> DataFrame:
    """``(_pack, pieces, tokens)`` from ``(text, shown)``: some texts, and the different substrings of what shows them.

    Substrings beyond a bound go to further rows of the pack, without texts. Written out: packs are parts of batches.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33

        def row(texts: list[str] | None, tokens: set[str]) -> pa.RecordBatch:
            strings = pa.list_(pa.string())
            columns = [pa.array([number]), pa.array([texts], strings), pa.array([list(tokens)], strings)]
            return pa.RecordBatch.from_arrays(columns, names=["_pack", "pieces", "tokens"])

        for batch in batches:
            texts, shown = batch.column("text").to_pylist(), batch.column("shown").to_pylist()
            for at in range(0, len(texts), PACKED_PIECES):
                tokens: set[str] = set()
                for piece in shown[at : at + PACKED_PIECES]:
                    for i in range(len(piece)):
                        tokens.update(piece[i:j] for j in range(i + 1, min(i + longest, len(piece)) + 1))
                        if len(tokens) > PACKED_TOKENS:
                            yield row(None, tokens)
                            tokens = set()
                yield row(texts[at : at + PACKED_PIECES], tokens)
                number += 1

    return checkpoint(pieces.mapInArrow(pack, "_pack bigint, pieces array<string>, tokens array<string>"))


def _pack_encoder(vocab: Vocabulary):
    """Function from some pieces and the lexicon of their substrings to the ids of each."""
    model, fallback, fixed = vocab.model, vocab.spec.byte_fallback, _fixed_ids(vocab)
    unknown = vocab.unknown_score()

    @F.pandas_udf("array<array<int>>")
    def encode_batch(packs: pd.Series, locals_: pd.Series) -> pd.Series:
        def one(pieces, rows):
            rows = [] if rows is None else list(rows)
            lexicon = _lookup(*([r[c] for r in rows] for c in ("token", "id", "logprob", "rules")), unknown)
            return [_piece_ids(piece, lexicon, fixed, model, fallback) for piece in pieces]

        return pd.Series([one(*row) for row in zip(packs, locals_)])

    return encode_batch.asNondeterministic()


def _encode_distinct(distinct: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``(piece, piece_ids)`` with a vocabulary that is too large to send to the tasks.

    Each pack of pieces is joined with the tokens that stand in any of them: a common token once, not for every piece.
    """
    lexicon = vocab.lexicon()
    longest = lexicon.agg(F.max(F.length("token"))).first()[0] or 1
    text = F.col("piece.text")
    shown = text if vocab.spec.byte_fallback else to_byte_chars(text)
    plain = distinct.where("not piece.added").select(text.alias("text"), shown.alias("shown"))
    packs = _substring_packs(plain, longest)
    rows = F.collect_list(F.struct("token", "id", "logprob", "rules"))
    parts = packs.select("_pack", F.explode("tokens").alias("token"))
    found = skew_join(parts, lexicon, "token", F.col("_pack")).groupBy("_pack").agg(rows.alias("local"))
    whole = packs.where("pieces is not null").select("_pack", "pieces").join(found.hint("merge"), "_pack", "left")
    done = whole.select("pieces", _pack_encoder(vocab)("pieces", "local").alias("ids"))
    each = done.select(F.inline(F.arrays_zip("pieces", "ids"))).toDF("text", "piece_ids")
    model = each.select(F.struct(F.lit(False).alias("added"), "text").alias("piece"), "piece_ids")
    return model.unionByName(_added_pieces(distinct, vocab))


def _encode_by_join(
    df: DataFrame, vocab: Vocabulary, key: str, ids: list[str], dropout: float, seed: int
) -> DataFrame:
    """Encode each distinct piece with the tokens that stand in it, then join the ids back.

    Dropout draws differ from place to place, so there every piece is encoded where it stands.
    """
    df = _with_row(df)
    if not dropout:
        flag = F.transform(text_pieces(key, vocab), lambda p: F.concat(p["added"].cast("int").cast("string"), p["text"]))
        packs = packed(df, flag)
        piece = F.struct(F.col("key").startswith("1").alias("added"), F.expr("substring(key, 2)").alias("text"))
        distinct = packs.keys().select("key").distinct().select(piece.alias("piece"))
        coded = F.concat(F.col("piece.added").cast("int").cast("string"), "piece.text").alias("key")
        values = _encode_distinct(distinct, vocab).select(coded, "piece_ids")
        found = unpacked(packs, values, "piece_ids", F.flatten).withColumnRenamed("piece_ids", "ids")
        return df.join(found.hint("merge"), "_row", "left").drop("_row")
    cut = F.posexplode(text_pieces(key, vocab)).alias("pos", "piece")
    exploded = df.select("_row", _row_key(ids, seed).alias("row_key"), cut)
    distinct, place = exploded.select("piece").distinct(), F.struct("_row", "pos")
    key_of = F.concat_ws(":", "row_key", "pos")
    found = _local_lexicons(distinct.where("not piece.added"), vocab)
    joined = skew_join(exploded.where("not piece.added"), found, "piece", place)
    drawn = joined.withColumn("piece_ids", _local_encoder(vocab, dropout)("piece.text", "local", key_of))
    whole = skew_join(exploded.where("piece.added"), _added_pieces(distinct, vocab), "piece", place)
    columns = ["_row", "pos", "piece_ids"]
    encoded = drawn.select(columns).unionByName(whole.select(columns))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "piece_ids")))
    grouped = encoded.groupBy("_row").agg(
        F.flatten(F.transform(in_order, lambda p: p["piece_ids"])).alias("ids")
    )
    empty = F.array().cast("array<int>")
    whole = df.join(grouped.hint("merge"), "_row", "left").drop("_row")
    return whole.withColumn("ids", F.when(F.col(key).isNotNull(), F.coalesce("ids", empty)))


def _token_bytes(token: str, kind: str, fallback: bool) -> bytes:
    """What a token stands for, as bytes."""
    if fallback and len(token) == 6 and token.startswith("<0x"):
        return bytes.fromhex(token[3:5])
    if kind in NOT_IN_MODEL or fallback or any(c not in CHAR_TO_BYTE for c in token):
        return token.encode()
    return bytes(CHAR_TO_BYTE[c] for c in token)


def decode(
    df: DataFrame,
    vocab: Vocabulary,
    ids: Sequence[str] = ("doc_id",),
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Add ``decoded``, the text of ``ids``.

    The bytes of all tokens are put together first: a character may be cut by a token edge.
    What is not valid UTF-8 then becomes U+FFFD, and so does a missing or foreign id.
    """
    if not fits_broadcast(vocab.tokens, max_broadcast_rows):
        return _decode_by_join(df, vocab)
    fallback = vocab.spec.byte_fallback
    rows = vocab.tokens.select("id", "token", "kind").collect()
    table = {r.id: _token_bytes(r.token, r.kind, fallback) for r in rows}
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("string")
    def decode_batch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sorted((i, raw) for i, raw in shared.value.items() if i is not None)
        keys = np.array([i for i, _ in known], np.int64)
        raws = [*(raw for _, raw in known), NO_ID_BYTES]
        letters = np.frombuffer(b"".join(raws), np.uint8)
        widths = np.fromiter(map(len, raws), np.int64, len(raws))
        starts = np.cumsum(widths) - widths

        def some(lists: pa.Array) -> list[str]:
            ids, null = flat_numbers(lists)
            at = np.searchsorted(keys, ids)
            at = np.where(~null & (np.append(keys, 0)[at] == ids), at, len(keys))
            place, ends = gathered(starts, widths, at)
            whole = letters[place].tobytes()
            ends = ends[np.append(0, np.cumsum(sizes_of(lists)))].tolist()
            return [whole[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]

        for lists in batches:
            texts = [text for a, b in stretches(lists) for text in some(lists.slice(a, b - a))]
            null = lists.is_null().to_numpy(zero_copy_only=False)
            yield pa.array(texts, pa.string(), mask=null)

    return df.withColumn("decoded", decode_batch("ids"))


def token_bytes(vocab: Vocabulary) -> DataFrame:
    """The vocabulary with ``bytes``, what each token stands for."""
    fallback = vocab.spec.byte_fallback

    @F.pandas_udf("binary")
    def token_bytes_batch(tokens: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([_token_bytes(t, k, fallback) for t, k in zip(tokens, kinds)])

    return vocab.tokens.withColumn("bytes", token_bytes_batch("token", "kind"))


def _decode_by_join(df: DataFrame, vocab: Vocabulary) -> DataFrame:
    df = _with_row(df)
    name = F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key")
    packs = packed(df, F.transform("ids", lambda i: F.coalesce(i.cast("string"), F.lit(""))))
    table = token_bytes(vocab).select(name, F.hex("bytes").alias("hex"))
    foreign = packs.keys().select("key").distinct().join(table, "key", "left_anti")
    table = table.unionByName(foreign.select("key", F.lit(NO_ID_BYTES.hex()).alias("hex")))
    found = unpacked(packs, table, "hex", lambda parts: F.array_join(parts, ""))
    text = F.make_valid_utf8(F.unhex("hex").cast("string")).alias("decoded")
    return df.join(found.select("_row", text).hint("merge"), "_row", "left").drop("_row")


def vocab_roundtrip(vocab: Vocabulary) -> DataFrame:
    """Encode each token's string as text and decode it: ``(id, token, n_ids, decoded, same)``."""
    tokens = vocab.tokens.select(F.col("id").alias("token_id"), "token")
    back = decode(encode(tokens, vocab, "token", ["token_id"]), vocab, ["token_id"])
    return back.select(
        F.col("token_id").alias("id"),
        "token",
        F.size("ids").alias("n_ids"),
        "decoded",
        (F.col("decoded") == F.col("token")).alias("same"),
    )

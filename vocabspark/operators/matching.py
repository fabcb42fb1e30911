"""Find the tokens of a list in texts: leftmost first, at each place the longest.

A short list becomes one pattern. A list of any length becomes sorted 64-bit hashes, 8 bytes a token: texts are hashed
at every place for every length that a token has, a window at a time, and looked up. Both give the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.functions.patterns import any_of
from vocabspark.functions.splits import split_isolated
from vocabspark.operators.lattice import by_length, hashes

# Tokens that go into one pattern.
PATTERN_TOKENS = 1000
MATCH_WINDOW = 1 << 16


def segments(text: Column, tokens: DataFrame, pattern_tokens: int | None = None) -> Column:
    """Array of ``(added, text)``: the tokens that stand in a text and what is between them, in order.

    Null stays null; the empty text has no segments if there are tokens.
    """
    most = PATTERN_TOKENS if pattern_tokens is None else pattern_tokens
    listed = tokens.where(F.length("token") > 0).select("token").distinct()
    head = sorted(row.token for row in listed.limit(most + 1).collect())
    if not head:
        return F.when(text.isNotNull(), F.array(_segment(F.lit(False), text)))
    if len(head) > most:
        return _zipped(_matcher(_table(listed))(text))
    pattern = any_of(head)
    cut = F.transform(split_isolated(text, pattern), lambda s: _segment(s.isin(head), s))
    return F.when(text.rlike(pattern), cut).when(text.isNotNull(), F.array(_segment(F.lit(False), text)))


def _segment(added: Column, text: Column) -> Column:
    return F.struct(added.alias("added"), text.alias("text"))


def _zipped(found: Column) -> Column:
    return F.zip_with(found["added"], found["text"], _segment)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("token").to_pylist()
        out, sizes = np.zeros(len(texts), np.uint64), np.fromiter(map(len, texts), np.int32, len(texts))
        for rows, points in by_length(texts):
            *_, whole = hashes(points, points.shape[1])
            out[rows] = whole[:, 0]
        yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(out.view(np.int64))], names=["size", "hash"])


def _table(tokens: DataFrame) -> dict:
    """Sorted hashes of the tokens by length, broadcast; only hashes come to the driver."""
    found = tokens.mapInArrow(_hashed, "size int, hash long").toArrow()
    sizes, keys = found["size"].to_numpy(), found["hash"].to_numpy().view(np.uint64)
    by_size = {int(size): np.sort(keys[sizes == size]) for size in np.unique(sizes)}
    return tokens.sparkSession.sparkContext.broadcast(by_size)


def longest_matches(points: np.ndarray, by_size: dict[int, np.ndarray]) -> np.ndarray:
    """Length of the longest token that begins at each character; 0 if none does."""
    longest = max(by_size)
    out = np.zeros(len(points), np.int32)
    for at in range(0, len(points), MATCH_WINDOW):
        window = points[at : at + MATCH_WINDOW + longest - 1][None, :]
        for size, own in enumerate(hashes(window, longest), start=1):
            keys = by_size.get(size)
            if keys is not None:
                own = own[0, :MATCH_WINDOW]
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                out[at + np.flatnonzero(keys[place] == own)] = size
    return out


def cut_at_tokens(text: str, by_size: dict[int, np.ndarray]) -> tuple[list[bool], list[str]]:
    """Whether each segment is a token, and the segments."""
    (_, points), = by_length([text], len(text))
    matches = longest_matches(points[0], by_size)
    added, parts, done = [], [], 0
    for start in np.flatnonzero(matches).tolist():
        if start < done:
            continue
        if start > done:
            added.append(False)
            parts.append(text[done:start])
        done = start + int(matches[start])
        added.append(True)
        parts.append(text[start:done])
    if done < len(text):
        added.append(False)
        parts.append(text[done:])
    return added, parts


def _matcher(shared):
    @F.pandas_udf("struct<added:array<boolean>,text:array<string>>")
    def match(texts: pd.Series) -> pd.DataFrame:
        none, empty = (None, None), ([], [])
        rows = [none if t is None else cut_at_tokens(t, shared.value) if t else empty for t in texts]
        return pd.DataFrame(rows, columns=["added", "text"])

    return match

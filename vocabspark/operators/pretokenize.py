"""Pre-tokenization: the ordered split steps, the piece table and its counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.functions.bytelevel import to_byte_chars
from vocabspark.functions.normalize import normalize
from vocabspark.functions.splits import apply_steps

WHITESPACE_POLICIES = ("yes", "inference", "no")


@dataclass(frozen=True)
class SplitSpec:
    """How text is cut into pieces.

    ``preserve_whitespace``: ``yes`` always, ``inference`` only after training, ``no`` never.
    ``byte_fallback`` cuts words with their leading space instead of byte-level pieces.
    """

    normal_form: str | None = "NFC"
    preserve_whitespace: str = "yes"
    remove_longspace: bool = False
    isolate_camelcase: bool = True
    byte_fallback: bool = False

    def __post_init__(self):
        if self.preserve_whitespace not in WHITESPACE_POLICIES:
            raise ValueError(f"preserve_whitespace must be one of {WHITESPACE_POLICIES}")

    def _steps(self, training: bool) -> list[str]:
        drops_space = {"yes": False, "inference": training, "no": True}
        steps = ["whitespace"] if drops_space[self.preserve_whitespace] else []
        steps += ["scripts", "punctuation", "digits"]
        if training and self.remove_longspace:
            steps.append("longspace")
        if training and self.isolate_camelcase:
            steps.append("camel")
        return [*steps, "word_with_space" if self.byte_fallback else "byte_level"]

    def train(self) -> list[str]:
        """Steps used while learning a vocabulary."""
        return self._steps(training=True)

    def inference(self) -> list[str]:
        """Steps used to encode: the training-only ones are gone."""
        return self._steps(training=False)


def pretokenize(df: DataFrame, steps: Sequence[str], key: str = "text") -> DataFrame:
    """Add ``pieces``, the ordered array of pieces of ``key``."""
    return df.withColumn("pieces", apply_steps(F.col(key), list(steps)))


def explode_pieces(df: DataFrame, steps: Sequence[str], ids: Sequence[str], key: str = "text") -> DataFrame:
    """One row ``(ids..., pos, piece)`` per piece."""
    pieces = apply_steps(F.col(key), list(steps))
    return df.select(*ids, F.posexplode(pieces).alias("pos", "piece"))


def count_pieces(pieces: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., piece, n)`` from a table with a ``piece`` column."""
    return pieces.groupBy(*by, "piece").agg(F.count(F.lit(1)).alias("n"))


def count_pretokens(
    df: DataFrame,
    steps: Sequence[str],
    by: Sequence[str] = (),
    key: str = "text",
    normal_form: str | None = None,
) -> DataFrame:
    """Distinct pieces of the corpus with their counts.

    One shuffle: pieces are counted inside each task first, so a piece that makes up a third
    of the corpus still sends only one row per task.
    """
    text = normalize(F.col(key), normal_form)
    return count_pieces(
        df.select(*by, F.explode(apply_steps(text, list(steps))).alias("piece")), by
    )


def byte_pieces(counts: DataFrame) -> DataFrame:
    """Write the (distinct) pieces in the byte alphabet. One-to-one, so nothing regroups."""
    return counts.withColumn("piece", to_byte_chars(F.col("piece")))


def chars(piece: Column) -> Column:
    """The characters of a piece, as an array."""
    return F.filter(F.split(piece, ""), lambda c: c != "")

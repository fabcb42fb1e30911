"""The byte alphabet: one visible character for each of the 256 byte values.

Printable Latin-1 bytes stand for themselves; the others take the code points from U+0100
upwards, in byte order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: byte ranges (inclusive) that stand for themselves -----------------
VISIBLE = [(33, 126), (161, 172), (174, 255)]
# --------------------------------------------------------------------------------------


def _is_visible(b: int) -> bool:
    return any(lo <= b <= hi for lo, hi in VISIBLE)


_HIDDEN = [b for b in range(256) if not _is_visible(b)]
BYTE_TO_CHAR = [
    chr(b) if _is_visible(b) else chr(256 + _HIDDEN.index(b)) for b in range(256)
]
CHAR_TO_BYTE = {c: b for b, c in enumerate(BYTE_TO_CHAR)}

ASCII_VISIBLE = r"^[!-~]*\z"


def byte_char(byte: Column) -> Column:
    """Visible character of a byte value column."""
    return F.element_at(F.array(*[F.lit(c) for c in BYTE_TO_CHAR]), byte.cast("int") + 1)


def byte_of(char: Column) -> Column:
    """Byte value of a visible character column; null outside the alphabet."""
    position = F.array_position(F.array(*[F.lit(c) for c in BYTE_TO_CHAR]), char)
    return F.when(position > 0, position.cast("int") - 1)


def to_byte_chars(text: Column) -> Column:
    """Write a string as the visible characters of its UTF-8 bytes.

    Latin-1 decoding gives one character per byte; only the hidden ones need replacing.
    """
    latin1 = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    hidden = "".join(chr(b) for b in _HIDDEN)
    shown = "".join(BYTE_TO_CHAR[b] for b in _HIDDEN)
    return F.when(text.rlike(ASCII_VISIBLE), text).otherwise(
        F.translate(latin1, hidden, shown)
    )


def from_byte_chars(text: Column) -> Column:
    """Inverse of :func:`to_byte_chars`; broken UTF-8 becomes U+FFFD."""
    hidden = "".join(chr(b) for b in _HIDDEN)
    shown = "".join(BYTE_TO_CHAR[b] for b in _HIDDEN)
    latin1 = F.translate(text, shown, hidden)
    return F.make_valid_utf8(F.encode(latin1, "ISO-8859-1").cast("string"))


def byte_alphabet(spark: SparkSession) -> DataFrame:
    """The 256 rows ``(byte, ch)``."""
    return spark.range(256).select(
        F.col("id").cast("int").alias("byte"), byte_char(F.col("id")).alias("ch")
    )

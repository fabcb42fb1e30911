"""Unicode normalization. Spark has no built-in, so this is one Arrow-batched function.

Pure ASCII text is in every normal form already: a native guard sends it past Python as
null, so only the rest pays for the transfer.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FORMS = ("NFC", "NFKC")
ASCII_ONLY = r"^\p{ASCII}*\z"


@cache
def _normalizer(form: str):
    @F.pandas_udf("string")
    def normalize_batch(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    return normalize_batch


def normalize(text: Column, form: str | None = "NFC") -> Column:
    """``text`` in normal form ``form``; unchanged when ``form`` is None."""
    if form is None:
        return text
    if form not in FORMS:
        raise ValueError(f"unknown normal form {form!r}; use one of {FORMS}")
    needs_work = ~text.rlike(ASCII_ONLY)
    return F.coalesce(_normalizer(form)(F.when(needs_work, text)), text)


@cache
def _segment_normalizer(form: str):
    @F.pandas_udf("array<string>")
    def normalize_batch(texts: pd.Series, fixed: pd.Series) -> pd.Series:
        def one(segments, flags):
            return [s if f else unicodedata.normalize(form, s) for s, f in zip(segments, flags)]

        return pd.Series([None if t is None else one(t, f) for t, f in zip(texts, fixed)])

    return normalize_batch


def normalize_segments(segments: Column, whole: Column, form: str | None) -> Column:
    """Normalize the ``text`` of each segment ``(added, text)`` that is not an added token.

    ``whole`` is the text the segments come from; if it is pure ASCII nothing goes to Python.
    """
    if form is None:
        return segments
    sent = F.when(~whole.rlike(ASCII_ONLY), segments)
    done = _segment_normalizer(form)(sent["text"], sent["added"])
    both = F.zip_with(sent["added"], done, lambda a, t: F.struct(a.alias("added"), t.alias("text")))
    return F.coalesce(both, segments)

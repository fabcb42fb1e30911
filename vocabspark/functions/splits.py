"""Pre-tokenization steps as native column expressions.

Each step maps a string column to an array of non-empty pieces. Steps that drop nothing
give back the text when their pieces are joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vocabspark.functions import patterns as P


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0))


def _non_empty(pieces: Column) -> Column:
    return F.filter(pieces, lambda p: p != "")


def split_isolated(text: Column, pattern: str) -> Column:
    """Matches and the gaps between them, in order; ``pattern`` never matches the empty string.

    A gap is what stands where no match begins. The possessive loop takes it in one go, without a stack.
    """
    return _matches(text, f"(?s:(?:{pattern})|(?:(?!{pattern}).)++)")


def split_whitespace(text: Column) -> Column:
    """Words and symbol runs; whitespace is dropped."""
    return _matches(text, P.WORDS_AND_SYMBOLS)


def split_scripts(text: Column) -> Column:
    """Cut where the Unicode script changes."""
    return _matches(text, P.SCRIPT_RUNS)


def split_punctuation(text: Column) -> Column:
    """Each punctuation character on its own."""
    return _matches(text, P.PUNCT_ISOLATED)


def split_digits(text: Column) -> Column:
    """Each digit on its own."""
    return _matches(text, P.DIGIT_ISOLATED)


def drop_long_space(text: Column) -> Column:
    """Cut at whitespace runs of 17 or more and drop the runs."""
    return _non_empty(F.split(text, P.LONG_SPACES))


def split_camel(text: Column) -> Column:
    """Cut between a lower-case and an upper-case ASCII letter."""
    return _non_empty(F.split(text, P.CAMEL_BOUNDARY))


def split_word_with_space(text: Column) -> Column:
    """Words with the whitespace before them; other characters between."""
    return split_isolated(text, P.WORD_WITH_SPACE[1:-1])


def split_byte_level(text: Column) -> Column:
    """Contractions, words, numbers and symbol runs with one leading space; space runs."""
    return _matches(text, P.BYTE_LEVEL)


STEPS = {
    "whitespace": split_whitespace,
    "scripts": split_scripts,
    "punctuation": split_punctuation,
    "digits": split_digits,
    "longspace": drop_long_space,
    "camel": split_camel,
    "word_with_space": split_word_with_space,
    "byte_level": split_byte_level,
}


# Steps that follow each other and their joint pattern, which gives the same pieces in one pass; the longest first.
JOINT = {
    ("punctuation", "digits", "byte_level"): P.PUNCT_DIGITS_BYTE_LEVEL,
    ("punctuation", "digits"): P.PUNCT_AND_DIGITS,
}


def _pass_of(pattern: str) -> Callable[[Column], Column]:
    return lambda text: _matches(text, pattern)


def _passes(steps: list[str]) -> list[Callable[[Column], Column]]:
    """The functions of the steps, one for those that have a joint pattern."""
    passes, at = [], 0
    while at < len(steps):
        for names, pattern in JOINT.items():
            if tuple(steps[at : at + len(names)]) == names:
                passes.append(_pass_of(pattern))
                at += len(names)
                break
        else:
            passes.append(STEPS[steps[at]])
            at += 1
    return passes


def apply_steps(text: Column, steps: list[str]) -> Column:
    """Run the named steps one after another over the pieces of the step before."""
    if not steps:
        return F.array(text)
    first, *others = _passes(steps)
    pieces = first(text)
    for step in others:
        pieces = F.flatten(F.transform(pieces, step))
    return pieces

"""Regex classes and patterns shared by the split functions.

Every class is spelled out instead of using ``\\s``, ``\\w`` or ``\\b``: those differ
between regex engines, and the results here must not depend on one.
"""

from __future__ import annotations

import re

# --- fixed values -----------------------------------------------------------
# Unicode whitespace, as the body of a character class.
WS = r"\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}"
# Word characters, as the body of a character class.
WORD = r"\p{L}\p{M}\p{N}_"
# ASCII punctuation and symbols plus Unicode punctuation.
PUNCT = r"!-/:-@\[-`{-~\p{P}"
# Runs of at least this many whitespace characters are dropped.
LONG_SPACE = 17

# Between a lower-case and an upper-case ASCII letter.
CAMEL_BOUNDARY = r"(?<=[a-z])(?=[A-Z])"

# Unicode scripts that form a class of their own. Han, Hiragana and Katakana form one
# class together; Common and Inherited are treated apart.
SCRIPTS = [
    "Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Syriac", "Thaana",
    "Devanagari", "Bengali", "Gurmukhi", "Gujarati", "Oriya", "Tamil", "Telugu", "Kannada",
    "Malayalam", "Sinhala", "Thai", "Lao", "Tibetan", "Myanmar", "Georgian", "Hangul",
    "Ethiopic", "Cherokee", "Canadian_Aboriginal", "Ogham", "Runic", "Khmer", "Mongolian",
    "Bopomofo", "Yi", "Old_Italic", "Gothic", "Deseret", "Tagalog", "Hanunoo", "Buhid",
    "Tagbanwa", "Limbu", "Tai_Le", "Linear_B", "Ugaritic", "Shavian", "Osmanya", "Cypriot",
    "Braille", "Buginese", "Coptic", "New_Tai_Lue", "Glagolitic", "Tifinagh", "Syloti_Nagri",
    "Old_Persian", "Kharoshthi", "Balinese", "Cuneiform", "Phoenician", "Phags_Pa", "Nko",
    "Sundanese", "Batak", "Lepcha", "Ol_Chiki", "Vai", "Saurashtra", "Kayah_Li", "Rejang",
    "Lycian", "Carian", "Lydian", "Cham", "Tai_Tham", "Tai_Viet", "Avestan",
    "Egyptian_Hieroglyphs", "Samaritan", "Mandaic", "Lisu", "Bamum", "Javanese", "Meetei_Mayek",
    "Imperial_Aramaic", "Old_South_Arabian", "Inscriptional_Parthian", "Inscriptional_Pahlavi",
    "Old_Turkic", "Brahmi", "Kaithi", "Meroitic_Hieroglyphs", "Meroitic_Cursive",
    "Sora_Sompeng", "Chakma", "Sharada", "Takri", "Miao", "Caucasian_Albanian", "Bassa_Vah",
    "Duployan", "Elbasan", "Grantha", "Pahawh_Hmong", "Khojki", "Linear_A", "Mahajani",
    "Manichaean", "Mende_Kikakui", "Modi", "Mro", "Old_North_Arabian", "Nabataean", "Palmyrene",
    "Pau_Cin_Hau", "Old_Permic", "Psalter_Pahlavi", "Siddham", "Khudawadi", "Tirhuta",
    "Warang_Citi", "Ahom", "Anatolian_Hieroglyphs", "Hatran", "Multani", "Old_Hungarian",
    "Adlam", "Bhaiksuki", "Marchen", "Newa", "Osage", "Tangut", "Masaram_Gondi", "Nushu",
    "Soyombo", "Zanabazar_Square", "Hanifi_Rohingya", "Old_Sogdian", "Sogdian", "Dogra",
    "Gunjala_Gondi", "Makasar", "Medefaidrin", "Elymaic", "Nandinagari",
    "Nyiakeng_Puachue_Hmong", "Wancho", "Yezidi", "Chorasmian", "Dives_Akuru",
    "Khitan_Small_Script",
]
# ----------------------------------------------------------------------------

WORDS_AND_SYMBOLS = rf"[{WORD}]+|[^{WS}{WORD}]+"
PUNCT_ISOLATED = rf"[{PUNCT}]|[^{PUNCT}]+"
DIGIT_ISOLATED = r"\p{N}|\P{N}+"
LONG_SPACES = rf"[{WS}]{{{LONG_SPACE},}}"
WORD_WITH_SPACE = rf"([{WORD}]+|[{WS}]+[{WORD}]+)"
NOT_BLANK = rf"[^{WS}]"

# Contractions, then optional-space runs of letters, digits or other symbols, then
# whitespace (leaving the last one before a word to that word). The letter run comes first
# only because it is by far the commonest and cannot start like any other alternative but
# the space ones, so the order does not change the result.
BYTE_LEVEL = (
    rf" ?\p{{L}}+|'(?:s|t|re|ve|m|ll|d)| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+"
    rf"|[{WS}]+(?![^{WS}])|[{WS}]+"
)


# Punctuation, then digits, each on its own; and the byte-level pieces of what is left, where a piece ends before both.
PUNCT_AND_DIGITS = rf"[{PUNCT}\p{{N}}]|[^{PUNCT}\p{{N}}]+"
PUNCT_DIGITS_BYTE_LEVEL = (
    rf" ?\p{{L}}+|[{PUNCT}\p{{N}}]| ?[^{WS}\p{{L}}\p{{N}}{PUNCT}]+"
    rf"|[{WS}]+(?![^{WS}\p{{N}}{PUNCT}])|[{WS}]+"
)


def script_runs() -> str:
    """Pattern for one run of a single script class.

    A space (U+0020) and Inherited marks join the run before them, or the first run. Common
    characters (digits, punctuation, other whitespace) are a class of their own.
    """
    joins = r"\p{IsInherited} "
    east_asian = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\x{30FC}"
    common = r"\p{IsCommon}&&[^\x{30FC}"
    named = [rf"\p{{Is{name}}}" for name in SCRIPTS]
    runs = [
        rf"{named[0]}[{named[0]}{joins}]*",
        rf"[{common} ]][{joins}{common}]]*",
        rf"[{east_asian}][{east_asian}{joins}]*",
        *(rf"{s}[{s}{joins}]*" for s in named[1:]),
    ]
    rest = f"[^{joins}{east_asian}{chr(92)}p{{IsCommon}}{''.join(named)}]"
    runs.append(f"{rest}(?:{rest}|[{joins}])*")
    return f"[{joins}]*(?:{'|'.join(runs)})|[{joins}]+"


SCRIPT_RUNS = script_runs()


def any_of(tokens: list[str]) -> str:
    """Pattern that matches any of the tokens, the longest first at each position.

    Tokens are grouped by first character, so most positions fail after one test per group.
    """
    groups: dict[str, list[str]] = {}
    for token in sorted(set(tokens), key=lambda t: (-len(t), t)):
        groups.setdefault(token[0], []).append(re.escape(token[1:]))
    return "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in groups.items())

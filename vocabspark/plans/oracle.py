"""The expected answers of ``queries.py`` as SQL over the same Parquet tables.

Another engine runs these, with its own regex dialect: no lookaround, other script names.
"""

from __future__ import annotations

from vocabspark.functions.patterns import LONG_SPACE, PUNCT, WORD, WS
from vocabspark.operators.inventory import ROLES, SPECIAL_TOKENS
from vocabspark.operators.vocab import CONTROL_PREFIX, EPSILON
from vocabspark.plans import queries as q

SQL: dict[str, str] = {}


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows, columns: str) -> str:
    return f"(VALUES {', '.join(rows)}) AS v({columns})"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


# --- splits -------------------------------------------------------------------------------

SEP = "chr(1)"
JOINS = r"\p{Inherited} "
EAST_ASIAN = r"\p{Han}\p{Hiragana}\p{Katakana}\x{30FC}"
_CLASSES = [r"\p{Latin}", r"\p{Common}", EAST_ASIAN, r"\p{Cyrillic}", r"\p{Hangul}", r"\p{Greek}"]
_RUNS = "|".join(f"[{c}][{c}{JOINS}]*" for c in _CLASSES)
SCRIPTS = f"[{JOINS}]*(?:{_RUNS})|[{JOINS}]+"
BYTE_LEVEL = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\x01{WS}\p{{L}}\p{{N}}]+|[{WS}]+"
)


def _all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {lit('(' + pattern + ')')}, 1)"


def _cut(marked: str) -> str:
    return f"list_filter(string_split({marked}, {SEP}), lambda e: e <> '')"


def byte_level(text: str) -> str:
    gap = lit(rf"([{WS}])([{WS}][^{WS}])")
    return _all(rf"regexp_replace({text}, {gap}, '\1' || {SEP} || '\2', 'g')", BYTE_LEVEL)


def long_space(text: str) -> str:
    return _cut(f"regexp_replace({text}, {lit(rf'[{WS}]{{{LONG_SPACE},}}')}, {SEP}, 'g')")


def camel(text: str) -> str:
    return _cut(rf"regexp_replace({text}, '([a-z])([A-Z])', '\1' || {SEP} || '\2', 'g')")


def word_with_space(text: str) -> str:
    match = lit(f"([{WORD}]+|[{WS}]+[{WORD}]+)")
    return _cut(rf"regexp_replace({text}, {match}, {SEP} || '\1' || {SEP}, 'g')")


STEPS = {
    "whitespace": lambda t: _all(t, rf"[{WORD}]+|[^{WS}{WORD}]+"),
    "scripts": lambda t: _all(t, SCRIPTS),
    "punctuation": lambda t: _all(t, rf"[{PUNCT}]|[^{PUNCT}]+"),
    "digits": lambda t: _all(t, r"\p{N}|\P{N}+"),
    "longspace": long_space,
    "camel": camel,
    "word_with_space": word_with_space,
    "byte_level": byte_level,
}


def steps(text: str, names: list[str]) -> str:
    out = STEPS[names[0]](text)
    for name in names[1:]:
        out = f"flatten(list_transform({out}, lambda p: {STEPS[name]('p')}))"
    return out


def split_rows(names: list[str], text: str = "text") -> str:
    """(doc_id, pos, piece) of the documents."""
    return f"""
    SELECT doc_id, CAST(i - 1 AS INT) AS pos, pieces[i] AS piece
    FROM (SELECT doc_id, pieces, unnest(range(1, len(pieces) + 1)) AS i
          FROM (SELECT doc_id, {steps('text', names)} AS pieces
                FROM (SELECT doc_id, {text} AS text FROM documents)))"""


CONVERSATION_SAMPLE = """
SELECT conv_id, turn, text FROM conversations ORDER BY conv_id, turn
LIMIT (SELECT CAST(floor(count(*) * 37 / 100.0) AS BIGINT) FROM conversations)"""

SQL["select_key"] = "SELECT html AS text FROM pages"
SQL["read_jsonl"] = "SELECT text FROM documents WHERE text IS NOT NULL"
SQL["read_text"] = r"SELECT regexp_replace(text, '[\r\n]', ' ', 'g') AS text FROM conversations"
SQL["convert_corpus"] = "SELECT text FROM conversations WHERE text IS NOT NULL"
SQL["read_mixed_directory"] = """
SELECT text FROM documents UNION ALL SELECT text FROM documents WHERE text IS NOT NULL
UNION ALL SELECT text FROM conversations"""
SQL["read_exemplars"] = f"""
SELECT DISTINCT unnest({steps('text', ['whitespace'])}) AS token, 'words' AS "set" FROM documents"""

SHORT = f"length(text) <= {q.MAX_LENGTH}"
FULL = f"regexp_matches(text, {lit(f'[^{WS}]')})"
SQL["corpus_profile"] = f"""
SELECT lang, count(*) AS n_rows, count(*) FILTER ({SHORT}) AS n_short,
  count(*) FILTER ({FULL}) AS n_not_blank, count(*) FILTER ({SHORT} AND {FULL}) AS n_kept,
  CAST(coalesce(sum(length(text)) FILTER ({SHORT} AND {FULL}), 0) AS BIGINT) AS chars_kept,
  CAST(coalesce(sum(octet_length(encode(text))) FILTER ({SHORT} AND {FULL}), 0) AS BIGINT) AS bytes_kept
FROM documents GROUP BY lang"""
SQL["sample_prefix"] = CONVERSATION_SAMPLE
SQL["sample_prefix_by_threshold"] = CONVERSATION_SAMPLE
SQL["sample_prefix_ties"] = """
SELECT * FROM conversations ORDER BY conv_id, turn, role, text
LIMIT (SELECT CAST(floor(count(*) * 37 / 100.0) AS BIGINT) FROM conversations)"""
SQL["shuffle"] = """
SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS pos FROM documents"""
SQL["sample_shuffled"] = """
SELECT doc_id, text FROM documents ORDER BY md5('42:' || doc_id), doc_id
LIMIT (SELECT CAST(floor(count(*) * 37 / 100.0) AS BIGINT) FROM documents)"""
SQL["take_first"] = "SELECT conv_id, turn, text FROM conversations ORDER BY conv_id, turn LIMIT 10"
SQL["filter_max_length"] = f"SELECT doc_id, text FROM documents WHERE {SHORT}"
SQL["filter_blank"] = rf"""
SELECT * FROM (SELECT doc_id, regexp_replace(text, '[^0-9 \n]', '', 'g') AS text FROM documents)
WHERE {FULL}"""


def _decomposed() -> str:
    text = "text"
    for whole, parts in q.DECOMPOSED.items():
        text = f"replace({text}, {lit(whole)}, {lit(parts)})"
    return text


SQL["normalize_nfc"] = f"SELECT doc_id, nfc_normalize({_decomposed()}) AS text FROM documents"
# The only compatibility character there is the ligature the query puts in.
SQL["normalize_nfkc"] = "SELECT doc_id, nfc_normalize(text) AS text FROM documents"

SPACED = f"replace(replace(text, ', ', ',' || repeat(' ', 16)), '. ', '.' || repeat(' ', 17))"
SQL["pt_whitespace"] = split_rows(["whitespace"])
SQL["pt_scripts"] = split_rows(["scripts"], f"translate(text, {lit(q.OTHER_SCRIPTS[0])}, {lit(q.OTHER_SCRIPTS[1])})")
SQL["pt_punct"] = split_rows(["punctuation"])
SQL["pt_digits"] = split_rows(["digits"], "translate(text, 'eo', '30')")
SQL["pt_drop_longspace"] = split_rows(["longspace"], SPACED)
SQL["pt_camel"] = split_rows(["camel"], "replace(text, ' ', '')")
SQL["pt_word_with_space"] = split_rows(["word_with_space"])
SQL["pt_bytelevel_split"] = split_rows(["byte_level"], "replace(text, '. ', '.  ')")
SQL["split_train"] = split_rows(
    ["scripts", "punctuation", "digits", "longspace", "camel", "byte_level"], SPACED
)
SQL["split_inference"] = split_rows(["scripts", "punctuation", "digits", "byte_level"], SPACED)
SQL["split_without_whitespace"] = split_rows(
    ["whitespace", "scripts", "punctuation", "digits", "byte_level"]
)
SQL["split_byte_fallback"] = split_rows(["scripts", "punctuation", "digits", "word_with_space"])

# --- pieces and bytes ---------------------------------------------------------------------


def byte_char(b: str) -> str:
    return f"""chr(CASE WHEN {b} <= 32 THEN {b} + 256 WHEN {b} BETWEEN 127 AND 160 THEN {b} + 162
      WHEN {b} = 173 THEN 323 ELSE {b} END)"""


def in_bytes(text: str) -> str:
    byte = f"CAST(('0x' || substr(hex(encode({text})), 2 * i + 1, 2)) AS INT)"
    chars = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte_char(byte)})"
    return f"array_to_string({chars}, '')"


def pieces(name: str, where: str = "true", by: str = "") -> str:
    """CTE ``name(piece, n)`` of byte-level pieces."""
    return f"""{name} AS (
    SELECT {by}piece, count(*) AS n
    FROM (SELECT {by}unnest({byte_level('text')}) AS piece FROM documents WHERE {where})
    GROUP BY {by}piece)"""


def byte_counts(name: str, where: str = "true") -> str:
    return pieces(f"{name}_raw", where) + f""",
    {name} AS MATERIALIZED (SELECT {in_bytes('piece')} AS piece, n FROM {name}_raw)"""


SQL["byte_chars"] = ctes(pieces("c")) + f"""
SELECT piece, {in_bytes('piece')} AS shown, piece AS back FROM c"""
SQL["pretoken_counts"] = ctes(pieces("c")) + " SELECT piece, n FROM c"
SQL["pretoken_counts_by_lang"] = ctes(pieces("c", by="lang, ")) + " SELECT lang, piece, n FROM c"
SQL["top_pieces_by_lang"] = ctes(pieces("c", f"{SHORT} AND {FULL}", "lang, ")) + f"""
SELECT lang, piece, n, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, piece) AS rank FROM c)
WHERE rank <= {q.TOP_PIECES}"""

# --- inventories --------------------------------------------------------------------------

SPECIALS = values([f"({lit(t)})" for t in SPECIAL_TOKENS], "token")
CONTROL = """replace(replace(replace(text, '.' || chr(10), '<|endoftext|>'), ' the ', '<|s|>'),
  ' and ', '<|unused07|>')"""
CONTROL_USE = rf"""used AS (
  SELECT token, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all({CONTROL}, '<\|[a-z0-9_/]+\|>')) AS token FROM documents)
  GROUP BY token)"""
BUFFER = "SELECT '<|unused' || lpad(CAST(i AS VARCHAR), 2, '0') || '|>' AS token FROM range({n}) t(i)"

SQL["special_tokens"] = ctes(CONTROL_USE) + f"""
SELECT token, coalesce(n, 0) AS n FROM {SPECIALS} LEFT JOIN used USING (token)"""
SQL["buffer_tokens"] = ctes(CONTROL_USE) + f"""
SELECT token, coalesce(n, 0) AS n FROM ({BUFFER.format(n=64)}) LEFT JOIN used USING (token)"""
SQL["whitespace_tokens"] = ctes(f"""used AS (
  SELECT token, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all({SPACED}, ' {{16}}| {{8}}| {{4}}| {{2}}| ')) AS token FROM documents)
  GROUP BY token)""") + """
SELECT repeat(' ', k) AS token, k AS length, coalesce(n, 0) AS n
FROM (VALUES (16), (8), (4), (2), (1)) v(k) LEFT JOIN used ON token = repeat(' ', k)"""


def _bytes_used(table: str, text: str) -> str:
    return f"""chars AS (SELECT ch, count(*) AS n
      FROM (SELECT unnest(string_split({text}, '')) AS ch FROM {table}) WHERE ch <> '' GROUP BY ch),
    used AS (SELECT byte, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT CAST(('0x' || substr(hx, 2 * i + 1, 2)) AS INT) AS byte, n FROM (
        SELECT hx, n, unnest(range(length(hx) // 2)) AS i
        FROM (SELECT hex(encode(ch)) AS hx, n FROM chars))) GROUP BY byte)"""


SQL["byte_alphabet"] = ctes(_bytes_used("documents", "text")) + f"""
SELECT CAST(b AS INT) AS byte, {byte_char('CAST(b AS INT)')} AS ch, coalesce(n, 0) AS n
FROM range(256) t(b) LEFT JOIN used ON byte = b"""
SQL["fallback_tokens"] = ctes(_bytes_used("pages", "html")) + """
SELECT printf('<0x%02X>', b) AS token, CAST(b AS INT) AS byte, 0.0::DOUBLE AS logprob, coalesce(n, 0) AS n
FROM range(256) t(b) LEFT JOIN used ON byte = b"""
SQL["vocab_budget"] = f"""
SELECT lang, n_alphabet, CAST({q.VOCAB_SIZE} - {q.N_WHITE - 1} - 256 AS BIGINT) AS trainer_size,
  CAST({len(SPECIAL_TOKENS) + q.N_BUFFER} AS BIGINT) AS n_added,
  {q.VOCAB_SIZE} - {q.N_WHITE - 1} - 256 - {len(SPECIAL_TOKENS) + q.N_BUFFER} - n_alphabet AS n_learned
FROM (SELECT lang, count(DISTINCT ch) AS n_alphabet
      FROM (SELECT lang, unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> '' GROUP BY lang)"""
_ROLES = values([f"({lit(t)}, {lit(r)})" for r, t in ROLES.items()], "token, named_role")
SQL["assign_roles"] = ctes(CONTROL_USE) + f"""
SELECT token, special, role, named_role, coalesce(n, 0) AS n
FROM (SELECT token, true AS special, 'special' AS role FROM {SPECIALS}
      UNION ALL SELECT token, true, 'buffer' FROM ({BUFFER.format(n=q.N_BUFFER)}))
LEFT JOIN (SELECT * FROM {_ROLES}) USING (token) LEFT JOIN used USING (token)"""

# --- pair and substring counts ------------------------------------------------------------


def pair_counts(symbols: str, source: str, having: str = "true") -> str:
    return f"""
SELECT l, r, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT s[i] AS l, s[i + 1] AS r, n FROM (
    SELECT s, n, unnest(range(1, len(s))) AS i FROM (SELECT {symbols} AS s, n FROM {source})))
GROUP BY l, r HAVING {having}"""


SQL["bpe_pair_counts"] = ctes(byte_counts("c")) + pair_counts("string_split(piece, '')", "c")
SQL["bpe_pair_counts_filtered"] = ctes(byte_counts("c")) + pair_counts(
    "regexp_extract_all(piece, 'Ġt|er|.')", "c", "sum(n) >= 20 AND length(l) + length(r) <= 3"
)


def seeds(source: str, name: str) -> str:
    """CTE of substring counts up to TOKEN_LENGTH characters."""
    return f"""{name} AS (
    SELECT token, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT substr(piece, i, k) AS token, n FROM (
        SELECT piece, n, k, unnest(range(1, length(piece) - k + 2)) AS i FROM (
          SELECT piece, n, unnest(range(1, {q.TOKEN_LENGTH} + 1)) AS k FROM {source}) WHERE k <= length(piece)))
    GROUP BY token)"""


SQL["unigram_seed"] = ctes(byte_counts("c"), seeds("c", "s")) + " SELECT token, n FROM s"

# --- two vocabularies ---------------------------------------------------------------------

SIDES = {"base": "lang = 'en'", "plus": "lang IS DISTINCT FROM 'en'", "every": "true"}


def uvocab(side: str) -> str:
    return byte_counts(f"{side}_c", SIDES[side]) + f""",
    {side} AS MATERIALIZED (
      SELECT piece AS token, round(ln(n / (SELECT sum(n) FROM {side}_c)), 9) AS logprob
      FROM {side}_c)"""


def merges(side: str) -> str:
    return byte_counts(f"{side}_c", SIDES[side]) + ",\n" + seeds(f"{side}_c", f"{side}_s") + f""",
    {side}_m AS MATERIALIZED (
      SELECT CAST(row_number() OVER (ORDER BY n DESC, length(token), token) - 1 AS INT) AS rank,
        substr(token, 1, length(token) - 1) AS "left", substr(token, length(token), 1) AS "right", token
      FROM {side}_s WHERE length(token) > 1)"""


def vocab(side: str) -> str:
    """CTE ``{side}_v(token, id, kind)`` over ``{side}_m``."""
    return f"""{side}_v AS MATERIALIZED (
      SELECT token, CAST(row_number() OVER (ORDER BY section, rank, token) - 1 AS INT) AS id, kind FROM (
        SELECT token, 0 AS rank, 'special' AS kind, 0 AS section FROM {SPECIALS}
        UNION ALL SELECT {byte_char('CAST(b AS INT)')}, 0, 'alphabet', 1 FROM range(256) t(b)
        UNION ALL SELECT token, rank, 'merge', 2 FROM {side}_m
        UNION ALL SELECT repeat(' ', k), -k, 'whitespace', 3 FROM range(2, {q.N_WHITE} + 1) t(k)))"""


WHOLE_VOCAB = ctes(merges("every"), vocab("every"))
BOTH_MERGES = (merges("base"), merges("plus"))
AT_ID = """(SELECT rank, "left", "right", rank + {offset} AS id FROM {m})"""

SQL["assign_ids"] = WHOLE_VOCAB + " SELECT token, id, kind FROM every_v"
SQL["vocab_counts"] = WHOLE_VOCAB + """
SELECT n_vocab, n_added, n_no_merge, (SELECT count(*) FROM every_m) AS n_merges,
  n_vocab = n_no_merge + (SELECT count(DISTINCT token) FROM every_m) AS adds_up
FROM (SELECT count(*) AS n_vocab, count(*) FILTER (kind IN ('special', 'whitespace')) AS n_added,
        count(*) FILTER (kind <> 'merge') AS n_no_merge FROM every_v)"""
SQL["merge_misaligned"] = ctes(*BOTH_MERGES, vocab("base")) + f"""
SELECT id, rank, "left", "right", token FROM {AT_ID.format(offset=q.OFFSET, m='plus_m')}
JOIN base_v USING (id) WHERE "left" || "right" <> token"""
SQL["merge_by_token"] = WHOLE_VOCAB + f"""
SELECT token, id, rank, "left", "right" FROM {AT_ID.format(offset=q.OFFSET, m='every_m')} JOIN every_v USING (id)"""
UNION = """u AS MATERIALIZED (
  SELECT token, coalesce(b."left", p."left") AS "left", coalesce(b."right", p."right") AS "right",
    b.rank AS base_rank, p.rank AS plus_rank, CAST(length(token) AS INT) AS length
  FROM base_m b FULL JOIN plus_m p USING (token))"""
ORDERED = f"""o AS (
  SELECT token, CAST(row_number() OVER (ORDER BY length, base_rank NULLS LAST, plus_rank, token)
    - 1 + {q.OFFSET} AS INT) AS id, "left", "right", base_rank, plus_rank, length FROM u)"""
SQL["union_bpe"] = ctes(*BOTH_MERGES, UNION) + " SELECT * FROM u"
SQL["order_union"] = ctes(*BOTH_MERGES, UNION, ORDERED) + " SELECT * FROM o"
SQL["reindex_bpe"] = ctes(*BOTH_MERGES, vocab("base"), UNION, ORDERED) + """
SELECT token, id, kind FROM base_v WHERE token NOT IN (SELECT token FROM o)
UNION ALL SELECT token, id, 'merge' FROM o"""
SQL["merge_bpe_job"] = ctes(*BOTH_MERGES, vocab("base"), UNION, ORDERED, f"""
  fixed AS (SELECT token, id, kind FROM base_v WHERE kind NOT IN ('merge', 'whitespace')),
  first AS MATERIALIZED (SELECT token, id FROM o WHERE id < {q.OFFSET + q.MERGE_TO})""") + f"""
SELECT token, id, kind FROM fixed WHERE token NOT IN (SELECT token FROM first)
UNION ALL SELECT token, id, 'merge' FROM first
UNION ALL SELECT token, CAST({q.OFFSET} + (SELECT count(*) FROM first) + row_number() OVER (ORDER BY id) - 1 AS INT), kind
FROM base_v WHERE kind = 'whitespace'"""
TARGET_MERGES = q.VOCAB_SIZE - 256 - q.N_WHITE - q.N_BUFFER
SQL["budget_deficit"] = ctes(*BOTH_MERGES, UNION) + f"""
SELECT CAST({TARGET_MERGES} AS BIGINT) AS target_merges, count(*) AS n_union,
  {TARGET_MERGES} - count(*) AS deficit FROM u"""


def union_unigram(shared: str, digits: int = 9) -> str:
    return ctes(uvocab("base"), uvocab("plus"), f"""u AS (
      SELECT token, round(CASE WHEN b.logprob IS NOT NULL AND p.logprob IS NOT NULL THEN {shared}
        ELSE coalesce(b.logprob, p.logprob) END, {digits}) AS logprob
      FROM base b FULL JOIN plus p USING (token))""")


MEAN = "(b.logprob + p.logprob) / 2"
HIGHER = f"least(0, greatest(b.logprob, p.logprob) + {EPSILON})"
SQL["union_unigram_mean"] = union_unigram(MEAN, 10) + " SELECT token, logprob FROM u"
SQL["union_unigram_max"] = union_unigram(HIGHER) + " SELECT token, logprob FROM u"
SQL["union_unigram_min"] = union_unigram("least(b.logprob, p.logprob)") + " SELECT token, logprob FROM u"
SQL["top_by_score"] = union_unigram(MEAN, 10) + " SELECT token, logprob FROM u ORDER BY logprob DESC, token LIMIT " + str(q.TOP_TOKENS)
SQL["order_by_score"] = union_unigram(MEAN, 10) + """
SELECT token, logprob, row_number() OVER (ORDER BY logprob DESC, token) - 1 AS pos FROM u"""
SQL["order_by_length"] = union_unigram(MEAN, 10) + """
SELECT token, logprob, row_number() OVER (ORDER BY length(token), logprob DESC, token) - 1 AS pos FROM u"""
SQL["unigram_alp"] = ctes(uvocab("every")) + f"""
SELECT count(*) AS n_tokens, round(sum(logprob) / {q.VOCAB_SIZE}, 6) AS alp FROM every"""

EXEMPLARS = r"""x AS MATERIALIZED (
  SELECT DISTINCT lang AS "set", ch AS token
  FROM (SELECT lang, unnest(string_split(text, '')) AS ch FROM documents)
  WHERE regexp_matches(ch, '^\p{L}$') AND unicode(ch) > 127)"""
ESSENTIALS = EXEMPLARS + f""",
  e AS MATERIALIZED (
    SELECT {byte_char('CAST(b AS INT)')} AS token FROM range(256) t(b)
    UNION SELECT {in_bytes('token')} FROM x
    UNION SELECT {in_bytes("repeat(' ', k)")} FROM (VALUES (2), (4), (8), (16)) v(k))"""


def filled(side: str) -> str:
    return f"""f AS MATERIALIZED (SELECT token, logprob FROM {side} UNION ALL
      SELECT token, (SELECT min(logprob) FROM {side}) FROM e WHERE token NOT IN (SELECT token FROM {side}))"""


def trimmed(source: str, target: int) -> str:
    keep = f"(token IN (SELECT token FROM e) OR starts_with(token, {lit(CONTROL_PREFIX)}))"
    return f"""t AS MATERIALIZED (SELECT token, logprob FROM {source} WHERE {keep} UNION ALL
      (SELECT token, logprob FROM {source} WHERE NOT {keep} ORDER BY logprob DESC, token
       LIMIT (SELECT greatest({target} - count(*), 0) FROM {source} WHERE {keep})))"""


def rescored(source: str) -> str:
    return f"""SELECT token, round(CASE WHEN token IN (SELECT token FROM e)
      THEN (SELECT min(logprob) FROM {source}) - {EPSILON} * (length(token) - 1) ELSE logprob END, 9) AS logprob
    FROM {source}"""


def repaired(source: str, protect: str = "false") -> str:
    floor = f"(SELECT min(logprob) - {EPSILON} FROM {source})"
    alphabet = f"(SELECT {byte_char('CAST(b AS INT)')} AS token FROM range(256) t(b))"
    other = f"token NOT IN (SELECT token FROM {alphabet})"
    return f"""
    SELECT token, round({floor}, 9) AS logprob FROM {alphabet}
    UNION ALL SELECT token, round(logprob, 9) FROM {source} WHERE {other} AND ({protect})
    UNION ALL (SELECT token, round(logprob, 9) FROM {source} WHERE {other} AND NOT ({protect})
      ORDER BY logprob DESC, token LIMIT (
        SELECT greatest(count(*) FILTER ({other} AND NOT ({protect}))
          - (256 - count(*) FILTER (NOT ({other}))), 0) FROM {source}))"""


WHOLE_FILLED = ctes(uvocab("every"), ESSENTIALS, filled("every"))
SQL["essential_tokens"] = ctes(ESSENTIALS) + " SELECT token FROM e"
SQL["add_essentials"] = WHOLE_FILLED + " SELECT token, logprob FROM f"
SQL["trim_vocab"] = WHOLE_FILLED + ",\n" + trimmed("f", q.TRIM_TO) + " SELECT token, logprob FROM t"
SQL["trim_unigram_job"] = WHOLE_FILLED + ",\n" + trimmed("f", q.TRIM_TO) + f"""
SELECT token, logprob, row_number() OVER (ORDER BY logprob DESC, token) - 1 AS pos FROM ({rescored('t')})"""
SQL["merge_unigram_job"] = union_unigram(HIGHER) + ",\n" + ESSENTIALS + ",\n" + trimmed("u", q.MERGE_TO) + f"""
SELECT token, logprob, row_number() OVER (ORDER BY logprob DESC, token) - 1 AS pos
FROM ({repaired('t', 'token IN (SELECT token FROM e)')})"""
SQL["intermediate_size"] = ctes(*BOTH_MERGES, vocab("base")) + f"""
SELECT *, {q.VOCAB_SIZE} - (internal_offset + added_offset) AS intermediate_size FROM (
  SELECT *, n_total - n_distinct AS internal_offset, n_total - n_unadded AS added_offset FROM (
    SELECT count(*) AS n_total, count(*) FILTER (kind NOT IN ('special', 'whitespace')) AS n_unadded,
      count(DISTINCT token) AS n_distinct
    FROM (SELECT token, kind FROM base_v UNION ALL SELECT token, 'merge' FROM plus_m)))"""
SQL["floor_bytes"] = ctes(uvocab("every")) + f"""
SELECT token, round(CASE WHEN token IN (SELECT {byte_char('CAST(b AS INT)')} FROM range(256) t(b))
  THEN (SELECT min(logprob) - {EPSILON} FROM every) ELSE logprob END, 9) AS logprob FROM every"""
SQL["repair_bytes"] = ctes(uvocab("every")) + repaired("every")
SQL["rescore_essentials"] = WHOLE_FILLED + " " + rescored("f")

LISTED = ctes(uvocab("base"), uvocab("plus"), f"""listed AS (
  SELECT token, logprob, row_number() OVER (ORDER BY logprob DESC, token) - 1 AS pos FROM base
  UNION ALL SELECT token, logprob, row_number() OVER (ORDER BY logprob DESC, token) - 1 + (SELECT count(*) FROM base) FROM plus)""")
SQL["duplicate_tokens"] = LISTED + " SELECT token, count(*) AS n FROM listed GROUP BY token HAVING count(*) > 1"
SQL["dedupe_vocab"] = LISTED + " SELECT token, arg_max(logprob, pos) AS logprob FROM listed GROUP BY token"
SQL["check_size"] = LISTED + f"""
SELECT count(DISTINCT token) AS n, CAST({q.VOCAB_SIZE} AS BIGINT) AS target,
  count(DISTINCT token) = {q.VOCAB_SIZE} AS matches FROM listed"""
SQL["exemplar_coverage"] = ctes(merges("every"), EXEMPLARS) + f"""
SELECT "set", count(*) AS n_exemplars,
  count(*) FILTER ({in_bytes('token')} IN (SELECT token FROM every_m)) AS n_covered FROM x GROUP BY "set" """
SQL["set_unk"] = WHOLE_VOCAB + """
SELECT kind, count(*) AS n, (SELECT min(id) FROM every_v WHERE token = '<|unk|>') AS unk_id FROM every_v GROUP BY kind"""

# --- BPE training: one pair after another, unrolled -----------------------------------------


TRAIN_STEPS = ("scripts", "punctuation", "digits", "byte_level")


def bpe_chain(n_merges: int, names=TRAIN_STEPS, symbols_of=in_bytes("piece")) -> str:
    """CTEs ``w0 .. wN`` (words as wrapped symbols) and ``p1 .. pN`` (the pair merged next)."""
    text = steps("text", list(names))
    parts = [f"""doc_pieces AS MATERIALIZED (
      SELECT doc_id, lang, i, pieces[i] AS piece FROM (
        SELECT doc_id, lang, pieces, unnest(range(1, len(pieces) + 1)) AS i
        FROM (SELECT doc_id, lang, {text} AS pieces FROM documents)))""",
        "counted AS (SELECT piece, count(*) AS n FROM doc_pieces GROUP BY piece)",
        f"""w0 AS MATERIALIZED (
      SELECT piece, regexp_replace({symbols_of}, '(?s)(.)', chr(2) || '\\1' || chr(3), 'g') AS s, n
      FROM counted)"""]
    for i in range(1, n_merges + 1):
        pairs = pair_counts(symbols("s"), f"w{i - 1}", "length(l) + length(r) <= 16")
        parts.append(f"p{i} AS MATERIALIZED ({pairs} ORDER BY n DESC, l, r LIMIT 1)")
        parts.append(f"""w{i} AS MATERIALIZED (
          SELECT piece, replace(s, chr(2) || l || chr(3) || chr(2) || r || chr(3),
            chr(2) || l || r || chr(3)) AS s, w{i - 1}.n AS n FROM w{i - 1}, p{i})""")
    return ctes(*parts)


def symbols(wrapped: str) -> str:
    return f"regexp_extract_all({wrapped}, '\\x02([^\\x03]*)\\x03', 1)"


CHAIN = bpe_chain(q.N_MERGES)
LAST = f"w{q.N_MERGES}"
SQL["train_bpe"] = CHAIN + " UNION ALL ".join(
    f' SELECT {i - 1} AS rank, l AS "left", r AS "right", l || r AS token, n FROM p{i}'
    for i in range(1, q.N_MERGES + 1)
)
TRAINED = CHAIN + f""",
learned AS ({' UNION ALL '.join(f'SELECT l || r AS token, {i} AS rank FROM p{i}' for i in range(1, q.N_MERGES + 1))}),
trained AS MATERIALIZED (
  SELECT token, CAST(row_number() OVER (ORDER BY section, rank, token) - 1 AS INT) AS id, kind FROM (
    SELECT token, 0 AS rank, 'special' AS kind, 0 AS section FROM {SPECIALS}
    UNION ALL SELECT token, 0, 'special', 0 FROM ({BUFFER.format(n=q.N_BUFFER)})
    UNION ALL SELECT {byte_char('CAST(b AS INT)')}, 0, 'alphabet', 1 FROM range(256) t(b)
    UNION ALL SELECT token, rank, 'merge', 2 FROM learned))"""
SQL["train_bpe_fallback"] = bpe_chain(q.N_MERGES, (*TRAIN_STEPS[:3], "word_with_space"), "piece") + f""",
learned AS ({' UNION ALL '.join(f'SELECT l || r AS token, {i} AS rank FROM p{i}' for i in range(1, q.N_MERGES + 1))})
SELECT token, CAST(row_number() OVER (ORDER BY section, rank, token) - 1 AS INT) AS id, kind, special,
  CASE WHEN section = 2 THEN CAST(rank - 1 AS INT) END AS rank FROM (
    SELECT token, 0 AS rank, 'special' AS kind, 0 AS section, true AS special FROM {SPECIALS}
    UNION ALL SELECT token, 0, 'special', 0, true FROM ({BUFFER.format(n=q.N_BUFFER)})
    UNION ALL SELECT printf('<0x%02X>', b), 0, 'special', 0, false FROM range(256) t(b)
    UNION ALL SELECT DISTINCT unnest(string_split(piece, '')), 0, 'alphabet', 1, NULL FROM counted
    UNION ALL SELECT token, rank, 'merge', 2, NULL FROM learned)"""
SQL["vocab_json"] = TRAINED + """
SELECT t.token, id, kind, CAST(l.rank - 1 AS INT) AS rank FROM trained t LEFT JOIN learned l USING (token)"""
SQL["read_named_table"] = "SELECT text FROM documents"
SQL["encode_bpe"] = TRAINED + f"""
SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i, k) AS ids FROM (
  SELECT doc_id, i, k, s[k] AS token FROM (
    SELECT doc_id, i, s, unnest(range(1, len(s) + 1)) AS k
    FROM doc_pieces JOIN (SELECT piece, {symbols('s')} AS s FROM {LAST}) USING (piece)))
JOIN trained USING (token) GROUP BY doc_id"""
SQL["encode_bpe_by_join"] = SQL["encode_bpe"]
SQL["vocab_roundtrip"] = TRAINED + " SELECT id, token, token AS decoded, true AS same FROM trained"
SQL["vocab_artifact"] = TRAINED + """
SELECT token, id, kind, CASE WHEN kind = 'special' THEN true END AS special FROM trained"""
SQL["token_frequency"] = CHAIN + f"""
SELECT lang, token, count(*) AS n FROM (
  SELECT lang, unnest(s) AS token
  FROM doc_pieces JOIN (SELECT piece, {symbols('s')} AS s FROM {LAST}) USING (piece)) GROUP BY lang, token"""

# Bytes of a token, and the byte sequences that decode to exactly one replacement character:
# a lone byte, or the start of a longer sequence that is cut short.
_BYTE = """CASE WHEN u BETWEEN 256 AND 288 THEN u - 256 WHEN u BETWEEN 289 AND 322 THEN u - 162
  WHEN u = 323 THEN 173 ELSE u END"""
_HEX = f"""array_to_string(list_transform(list_transform(string_split(token, ''), lambda c: unicode(c)),
  lambda u: printf('%02X', {_BYTE})), '')"""
ONE_REPLACED = (
    "^([89A-F].|E0[AB].|E[1-9A-CEF][89AB].|ED[89].|F0[9AB].([89AB].)?"
    "|F[1-3][89AB].([89AB].)?|F48.([89AB].)?)$"
)
SQL["fallback_portion"] = CHAIN + f""",
used AS (
  SELECT lang, token, count(*) AS n FROM (
    SELECT lang, unnest(s) AS token
    FROM doc_pieces JOIN (SELECT piece, {symbols('s')} AS s FROM {LAST}) USING (piece)) GROUP BY lang, token),
hexed AS (SELECT lang, n, {_HEX} AS hx FROM used)
SELECT lang, n_tokens, n_fallback, n_holding, round(n_fallback / n_tokens, 6) AS portion FROM (
  SELECT lang, CAST(sum(n) AS BIGINT) AS n_tokens,
    CAST(coalesce(sum(n) FILTER (regexp_matches(hx, '{ONE_REPLACED}')), 0) AS BIGINT) AS n_fallback,
    CAST(coalesce(sum(n) FILTER (TRY(decode(unhex(hx))) IS NULL), 0) AS BIGINT) AS n_holding
  FROM hexed GROUP BY lang)"""
SQL["length_stats"] = CHAIN + f""",
sized AS (SELECT lang, CAST(sum(len({symbols('s')})) AS BIGINT) AS tokens
  FROM doc_pieces JOIN {LAST} USING (piece) GROUP BY lang)
SELECT lang, n_docs, chars, bytes, tokens, round(chars / tokens, 6) AS chars_per_token,
  round(bytes / tokens, 6) AS bytes_per_token
FROM (SELECT lang, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS chars,
        CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM documents GROUP BY lang)
JOIN sized USING (lang)"""

# A token that is not whole characters has one broken sequence, at its end or at its start.
DECODED = TRAINED + f""",
hexes AS (SELECT *, {_HEX} AS hx FROM trained),
alone AS MATERIALIZED (
  SELECT id, token, CASE WHEN kind = 'special' THEN token ELSE coalesce(
    TRY(decode(unhex(hx))),
    CASE WHEN regexp_matches(hx, '{ONE_REPLACED}') THEN chr(65533) END,
    TRY(decode(unhex(substr(hx, 1, length(hx) - 2)))) || chr(65533),
    chr(65533) || TRY(decode(unhex(substr(hx, 3))))) END AS decoded
  FROM hexes)"""
SQL["token_decode_table"] = DECODED + """
SELECT id, token, decoded, decoded = chr(65533) AS is_fallback, contains(decoded, chr(65533)) AS has_fallback
FROM alone"""
SQL["reconstruction"] = DECODED + f"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, k) - 1 AS INT) AS pos, id, token,
  CASE WHEN decoded = chr(65533) THEN '|ufb|' ELSE decoded END AS shown
FROM (SELECT doc_id, i, k, s[k] AS token FROM (
  SELECT doc_id, i, s, unnest(range(1, len(s) + 1)) AS k
  FROM doc_pieces JOIN (SELECT piece, {symbols('s')} AS s FROM {LAST}) USING (piece)))
JOIN alone USING (token)"""

# --- text that must come back ------------------------------------------------------------------

BACK = "SELECT doc_id, nfc_normalize(text) AS decoded FROM documents"
for name in ("decode", "decode_by_join", "decode_unigram", "decode_dropout"):
    SQL[name] = BACK
SQL["invertibility"] = """
SELECT lang, count(*) AS n_docs, count(*) FILTER (nfc_normalize(text) = text) AS n_invertible,
  count(*) AS n_invertible_normal,
  round(count(*) FILTER (nfc_normalize(text) = text) / count(*), 6) AS share_invertible
FROM documents GROUP BY lang"""

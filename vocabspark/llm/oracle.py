"""The operators that SQL can express, in DuckDB's SQL."""

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOWER = _FOLD.replace("coalesce(text, '')", "text")


def _field(value: str) -> str:
    """A value with its UTF-8 length before it."""
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


_LEAF = f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', '{text}')))})"

def _assigned(step: int) -> str:
    """The nearest entry of every part of every vector, under the codebooks of a step."""
    return f"""near{step} AS MATERIALIZED (
  SELECT id, part, min({{'d': d, 'entry': entry}}) AS best FROM (
    SELECT p.id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x))::BIGINT AS d
    FROM points p JOIN books{step} b ON b.part = p.part AND b.pos = p.pos GROUP BY p.id, p.part, b.entry
  ) GROUP BY id, part
)"""


def _moved(step: int) -> str:
    """The codebooks after a step: means rounded down, entries without points as they were."""
    return f"""{_assigned(step)}, books{step + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM books{step} b LEFT JOIN (
    SELECT part, entry, pos, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (
      SELECT p.part, near.best.entry AS entry, p.pos, sum(p.x)::BIGINT AS s, count(*) AS n
      FROM points p JOIN near{step} near ON near.id = p.id AND near.part = p.part GROUP BY ALL
    )
  ) m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos
)"""


SQL = {
    "op1_ngram_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
      THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2]))
      WHEN len(w) > 0 THEN [array_to_string(w, chr(1))] ELSE [] END AS s FROM words
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS d, doc_id AS r FROM sets UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles,
  (SELECT min(r) FROM reach WHERE d = s.doc_id) AS component_id,
  (SELECT count(*) FROM links WHERE a = s.doc_id)::BIGINT AS n_links
FROM sets s
""",
    "op2_benchmark_decontamination": rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), cut AS (
  SELECT item_id, least(len(w), 13) AS size, unnest(CASE WHEN len(w) = 0 THEN [] ELSE
    list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: array_to_string(w[i:i + 12], ' ')) END) AS win FROM items
), windows AS (SELECT DISTINCT item_id, size, win FROM cut),
docs AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS p, w FROM docs, (SELECT DISTINCT size FROM windows)
  WHERE len(w) >= size
), hits AS (
  SELECT doc_id, p, x.size, item_id FROM places x JOIN windows v ON v.size = x.size AND v.win = array_to_string(w[p:p + x.size - 1], ' ')
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
  sha256(coalesce(named.ids, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op7_suffix_array_dedup": """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM raw),
strings AS (SELECT doc_id, p, hash(substr(h, 2 * p + 1, 100)) AS k, md5(substr(h, 2 * p + 1, 100)) AS m FROM places),
first AS (SELECT k, m, min(doc_id) AS d FROM strings GROUP BY k, m),
gone AS (SELECT s.doc_id, s.p FROM strings s JOIN first f ON f.k = s.k AND f.m = s.m WHERE f.d < s.doc_id),
marked AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER w <= 50 THEN 0 ELSE 1 END AS fresh FROM gone
  WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM marked),
spans AS (SELECT doc_id, g, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY doc_id, g),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT s.doc_id, max(s.b), any_value(length(r.h) // 2) FROM spans s JOIN raw r USING (doc_id) GROUP BY s.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, (2 * a + 1)::BIGINT, (2 * (b - a))::BIGINT), '' ORDER BY a) AS h FROM gaps JOIN raw USING (doc_id) GROUP BY doc_id
), sums AS (SELECT doc_id, sum(b - a) AS n, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT r.doc_id, (length(r.h) // 2)::BIGINT AS n_bytes, coalesce(s.n, 0)::BIGINT AS n_removed, coalesce(s.spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k.h, r.h))) AS kept_sha256
FROM raw r LEFT JOIN sums s USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE bits AS (
  SELECT doc_id, lang, {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text=_LOWER)} AS low,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: 0::BIGINT)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc
  FROM documents
), leaves AS (
  SELECT row_number() OVER () AS id, doc_id, leaf, low, crc,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS n
  FROM bits
), up AS (
  SELECT tree, 0 AS level, place, leaf AS digest, n FROM leaves UNION ALL
  SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
  FROM up WHERE n > 1 GROUP BY tree, level, place // 8, n
), subroots AS (SELECT tree, digest FROM up WHERE n = 1),
over AS (
  SELECT 0 AS level, tree AS place, digest, (SELECT count(*) FROM subroots) AS n FROM subroots UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
  FROM over WHERE n > 1 GROUP BY level, place // 8, n
), nodes AS (
  SELECT tree, level, place, digest FROM up WHERE n > 1 UNION ALL
  SELECT -1, 1000 + level, place, digest FROM over WHERE n > 1
), own AS (
  SELECT l.id, u.tree, u.level, u.place FROM leaves l JOIN up u
    ON u.tree = l.tree AND u.n > 1 AND u.place = l.place // (8 ** u.level)::BIGINT UNION ALL
  SELECT l.id, -1, 1000 + o.level, o.place FROM leaves l JOIN over o ON o.n > 1 AND o.place = l.tree // (8 ** o.level)::BIGINT
), steps AS (
  SELECT o.id, o.level, row_number() OVER (PARTITION BY o.id ORDER BY o.level) AS step,
    coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place < o.place), '') AS before,
    coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (s.place > o.place), '') AS after
  FROM own o JOIN nodes s ON s.tree = o.tree AND s.level = o.level AND s.place // 8 = o.place // 8
  GROUP BY o.id, o.level, o.place
), folded AS (
  SELECT id, 0 AS step, CASE WHEN (4294967295 - crc) % 3 = 0 THEN low ELSE leaf END AS x FROM leaves UNION ALL
  SELECT f.id, f.step + 1, sha256(s.before || f.x || s.after) FROM folded f JOIN steps s ON s.id = f.id AND s.step = f.step + 1
), last AS (SELECT id, arg_max(x, step) AS x FROM folded GROUP BY id),
proofs AS (SELECT id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM steps GROUP BY id),
root AS (SELECT digest FROM over WHERE n = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  x.x AS folded_root, x.x = root.digest AS verified
FROM leaves l JOIN subroots s USING (tree) CROSS JOIN root LEFT JOIN proofs p USING (id) JOIN last x USING (id)
""",
    "op12_vector_codes": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS id, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
  SELECT id, (i // (len(v) // 8))::INT AS part, (i % (len(v) // 8))::INT AS pos, floor(4096 * v[i + 1]::DOUBLE)::BIGINT AS x
  FROM (SELECT id, v, unnest(range(len(v))) AS i FROM kept)
), books0 AS MATERIALIZED (SELECT part, id AS entry, pos, x FROM points WHERE id < 16),
{", ".join(map(_moved, range(6)))}, {_assigned(6)}, codes AS (
  SELECT id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near6 GROUP BY id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM books6) AS codebooks_sha256
FROM kept JOIN codes USING (id)
""",
    "op13_warc": """
WITH own AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
held AS (SELECT h, max(page_id) AS holder FROM own WHERE strlen(h) >= 1000 GROUP BY h)
SELECT page_id, strlen(own.h)::BIGINT AS payload_bytes, sha1(own.h) AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM holder AND holder IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM own LEFT JOIN held ON held.h = own.h
""",
}

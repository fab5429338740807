"""DuckDB statements for the operators that SQL can express, over whole tables."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

CONTAMINATION = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, win FROM (
    SELECT item_id, unnest(CASE WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) ELSE [w] END) AS win
    FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
found AS (
  SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS win FROM places) p JOIN windows USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM found) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    ELSE [array_to_string(w, ' ')] END) AS s FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * m >= 80 * (x.n + y.n - m)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, root AS component_id, doc_id = root AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY 1) USING (doc_id)
"""

ROUNDS = 6


def _assigned(number: int) -> str:
    """Each part with the nearest entry of codebook ``number``, the lower one of equals."""
    return f"""assigned{number} AS MATERIALIZED (
  SELECT r, p, any_value(part) AS part, min({{'d': d, 'e': e}}) AS near FROM (
    SELECT r, parts.p, parts.v AS part, e, list_sum(list_transform(list_zip(parts.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts JOIN book{number} b ON parts.p = b.p) GROUP BY r, p)"""


def _averaged(number: int) -> str:
    """Codebook ``number``: averages of the round before, rounded down; unused entries stay."""
    return f"""book{number} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{number - 1} b LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM (
      SELECT p, near.e AS e, j, sum(part[j])::BIGINT AS s, count(*) AS n
      FROM assigned{number - 1}, (SELECT unnest(range(1, 9)) AS j) GROUP BY ALL) GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""


VECTOR_CODES = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, q[8 * p + 1:8 * p + 8] AS v FROM kept, (SELECT unnest(range(8)) AS p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= 16),
{"".join(f"{_assigned(i)},{chr(10)}{_averaged(i + 1)},{chr(10)}" for i in range(ROUNDS))}{_assigned(ROUNDS)},
said AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM (
  SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM book{ROUNDS})),
coded AS (SELECT r, string_agg(lpad(lower(to_hex(near.e)), 2, '0'), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error
  FROM assigned{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), said
"""

WORD_REPEATS = r"""
WITH docs AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)),
firsts AS (SELECT win, min(doc_id) AS least FROM wins GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM wins JOIN firsts USING (win) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS said FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

STATEMENTS: dict[str, str] = {
    "op3_decontamination": CONTAMINATION,
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op11_vector_codes": VECTOR_CODES,
    "op12_recompression": WORD_REPEATS,
}

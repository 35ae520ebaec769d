"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

# CRC-32 (reflected, polynomial 0xEDB88320) over the bytes of a text: a table of 256 values,
# then one lookup per byte.
CRC = """
crc_steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps
)"""


def crc_of(codes: str) -> str:
    """CRC-32 of a list of byte values, given the column ``steps``."""
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
        "lambda x, b: xor(x >> 8, steps[(xor(x, b) & 255) + 1])), 4294967295)"
    )


_DIGITS = "list_transform(string_split({}, ''), lambda c: unicode(c)::BIGINT)"

TRIE = f"""
WITH {CRC.strip()},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    {crc_of(_DIGITS.format("conv_id::VARCHAR"))} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_steps
),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.place, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
),
whole AS (
  SELECT c.conv_id, coalesce(s.seq, []) AS seq, coalesce(s.words, []) AS words
  FROM convs c LEFT JOIN (
    SELECT conv_id,
      list({{'role': role, 'text': text}} ORDER BY part, place) AS seq,
      list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) ORDER BY part, place) AS words
    FROM rebuilt GROUP BY conv_id
  ) s ON s.conv_id = c.conv_id
),
prefixes AS (
  SELECT conv_id, d AS depth, seq[1:d] AS prefix,
    CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words, d = len(seq) AS ends
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM whole)
),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth
),
children AS (
  SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL
),
subtrees AS (
  SELECT n.prefix, n.depth, sum((b.n_convs - 1) * b.words) AS saved_tokens,
    count(*) FILTER (c.n_children IS NULL) AS n_leaves
  FROM nodes n
  JOIN nodes b ON b.depth >= n.depth AND b.prefix[1:n.depth] = n.prefix
  LEFT JOIN children c ON c.depth = b.depth AND c.prefix = b.prefix
  GROUP BY n.prefix, n.depth
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(c.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n
JOIN subtrees s ON s.depth = n.depth AND s.prefix = n.prefix
LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""

# UTF-8 bytes of ASCII and of U+00C0 to U+00FF.
_BYTES = (
    "flatten(list_transform(string_split({}, ''), lambda c: "
    "CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))"
)

VARIANTS = f"""
WITH RECURSIVE {CRC.strip()},
runs AS (
  SELECT name, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS name,
      unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
  ) GROUP BY ALL
),
summed AS (SELECT *, {crc_of(_BYTES.format("name || ':' || run"))} AS h FROM runs, crc_steps),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 97 = 0
      THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
    FROM summed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT word, n, i, substring(word, 1, i - 1) AS l, substring(word, i + 1) AS r FROM places),
shorter AS (SELECT DISTINCT c.word, c.n, w.word AS other, w.n AS other_n FROM cut c JOIN words w ON w.word = c.l || c.r),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON b.l = a.l AND b.r = a.r AND b.word <> a.word
  UNION ALL SELECT word, n, other, other_n FROM shorter
  UNION ALL SELECT other, other_n, word, n FROM shorter
),
counted AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(c.n_near, 0)::BIGINT AS n_near,
    CASE WHEN c.other_n >= 2 * w.n THEN c.other END AS form, CASE WHEN c.other_n >= 2 * w.n THEN c.other_n END AS form_n
  FROM words w LEFT JOIN counted c ON c.word = w.word
),
steps AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL
),
ends AS (
  SELECT s.word, s.root FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NULL
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n::BIGINT AS form_n FROM formed f JOIN ends e ON e.word = f.word
"""

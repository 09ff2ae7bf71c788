"""DuckDB SQL for the operators that SQL can express, written from their definitions and not from the code."""

from __future__ import annotations


def phrases(min_count: int = 100, top: int = 2000) -> str:
    """Operator 11 by counting every contiguous sequence."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words WHERE len(w) > 0),
grams AS (
  SELECT lang, g, count(*) AS a
  FROM (SELECT lang, w[i : i + k - 1] AS g FROM places, range(1, 6) AS t(k) WHERE i + k - 1 <= len(w))
  GROUP BY lang, g),
candidates AS (SELECT * FROM grams WHERE len(g) >= 2 AND a >= {min_count}),
inside AS (
  SELECT lang, g[i : i + k - 1] AS g, max(a) AS longer
  FROM candidates, range(2, 5) AS t(k), range(1, 5) AS s(i)
  WHERE k < len(g) AND i + k - 1 <= len(g)
  GROUP BY 1, 2),
staying AS (
  SELECT c.lang, c.g, c.a FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.g = i.g
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a),
cuts AS (
  SELECT s.lang, s.g, s.a, k, x.a AS l, y.a AS r, t.n,
         (1000::HUGEINT * s.a * t.n) // (x.a::HUGEINT * y.a) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM staying) s
  JOIN grams x ON x.lang = s.lang AND x.g = s.g[1 : k]
  JOIN grams y ON y.lang = s.lang AND y.g = s.g[k + 1 :]
  JOIN totals t ON t.lang = s.lang),
best AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked WHERE rank <= {top}"""


def filter_audit() -> str:
    """Operator 12 by walking through every order."""
    return r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
failing AS (
  SELECT doc_id, part,
         (len(words) < 100)::INT
         + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
  FROM docs),
given AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failing LEFT JOIN given USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
         list_sum(list_transform(range(1, step), lambda j: 1 << (ascii(filter_order[j]) - 65))) AS before
  FROM orders, range(1, 6) AS t(step)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (coalesce(before, 0)::INT | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & coalesce(before, 0)::INT = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & coalesce(before, 0)::INT > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & coalesce(before, 0)::INT = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & coalesce(before, 0)::INT = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted"""

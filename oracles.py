"""DuckDB SQL that states what each query must return. Word and element lists are those of the library; the logic is not.

The parts are common table expressions that the queries at the end put together.
"""

from __future__ import annotations

from sievemark.functions.html import BLOCK
from sievemark.functions.language import FUNCTION_WORDS
from sievemark.operators.tfidf import STOP_WORDS


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")" for row in rows)


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


# --- F1: language by function words --------------------------------------------------


def lang_ctes(source: str = "documents", p: str = "") -> str:
    """``{p}lang(doc_id, language, language_score)``."""
    listed = _values([(lang, w) for lang, ws in FUNCTION_WORDS.items() for w in ws])
    return rf"""
{p}listed(language, w) AS (VALUES {listed}),
{p}profile AS (SELECT min(language) AS language, w FROM {p}listed GROUP BY w HAVING count(DISTINCT language) = 1),
{p}hit AS (
  SELECT d.doc_id, pr.language, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')) AS t FROM {source}) d
  JOIN {p}profile pr ON d.t = pr.w GROUP BY d.doc_id, pr.language),
{p}best AS (
  SELECT doc_id, language, n::DOUBLE / sum(n) OVER (PARTITION BY doc_id) AS language_score,
         row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, language) AS r FROM {p}hit),
{p}lang AS (
  SELECT s.doc_id, b.language, b.language_score FROM {source} s
  LEFT JOIN {p}best b ON b.doc_id = s.doc_id AND b.r = 1)"""


# --- F2: Gopher ------------------------------------------------------------------------


def gopher_ctes(source: str = "documents", p: str = "", cut: str = "") -> str:
    """``{p}gopher(doc_id, features..., gopher_reason)``; words stand between blanks or in the table ``cut``."""
    cut = cut or rf"(SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS w FROM {source})"
    return rf"""
{p}word AS (
  SELECT doc_id, w, lower(regexp_replace(w, '[^\p{{L}}]', '', 'g')) AS bare
  FROM {cut} WHERE w <> ''),
{p}per_word AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w)) AS chars, count(*) FILTER (bare <> '') AS letters,
         count(DISTINCT bare) FILTER (bare IN ('the','be','to','of','and','that','have','with')) AS stops
  FROM {p}word GROUP BY doc_id),
{p}line AS (
  SELECT doc_id, trim(l, E' \t\r\n') AS l
  FROM (SELECT doc_id, unnest(string_split(text, E'\n')) AS l FROM {source})),
{p}per_line AS (
  SELECT doc_id, count(*) AS n_lines,
         count(*) FILTER (l LIKE '•%' OR l LIKE '-%') AS bullets,
         count(*) FILTER (l LIKE '%...' OR l LIKE '%…') AS dotted
  FROM {p}line WHERE l <> '' GROUP BY doc_id),
{p}measured AS (
  SELECT d.doc_id, coalesce(n_words, 0)::INTEGER AS n_words,
         round(coalesce(chars::DOUBLE / n_words, 0), 6) AS mean_word_length,
         coalesce((length(text) - length(replace(text, '#', '')))::DOUBLE / n_words, 0) AS hash_ratio,
         coalesce(((length(text) - length(replace(text, '...', ''))) // 3
                   + length(text) - length(replace(text, '…', '')))::DOUBLE / n_words, 0) AS ellipsis_ratio,
         coalesce(bullets::DOUBLE / n_lines, 0) AS bullet_line_share,
         coalesce(dotted::DOUBLE / n_lines, 0) AS ellipsis_line_share,
         coalesce(letters::DOUBLE / n_words, 0) AS letter_word_share,
         coalesce(stops, 0)::INTEGER AS n_stop_words
  FROM {source} d LEFT JOIN {p}per_word USING (doc_id) LEFT JOIN {p}per_line USING (doc_id)),
{p}gopher AS (
  SELECT *, CASE WHEN n_words < 50 THEN 'too_few_words'
                 WHEN n_words > 100000 THEN 'too_many_words'
                 WHEN mean_word_length < 3 THEN 'words_too_short'
                 WHEN mean_word_length > 10 THEN 'words_too_long'
                 WHEN hash_ratio > 0.1 THEN 'too_many_hashes'
                 WHEN ellipsis_ratio > 0.1 THEN 'too_many_ellipses'
                 WHEN bullet_line_share > 0.9 THEN 'too_many_bullet_lines'
                 WHEN ellipsis_line_share > 0.3 THEN 'too_many_ellipsis_lines'
                 WHEN letter_word_share < 0.8 THEN 'too_few_letter_words'
                 WHEN n_stop_words < 2 THEN 'too_few_stop_words' END AS gopher_reason
  FROM {p}measured)"""


# --- F2: words by Unicode's boundaries ---------------------------------------------------
#
# The rules letter by letter, over windows: a letter begins a new piece unless the letters around it forbid that.
# Texts with Hebrew are not covered (their rules on quotes are left out).

UNICODE_WORDS = r"""
u_char AS MATERIALIZED (
  SELECT doc_id, i, c, CASE
    WHEN regexp_matches(c, '[\p{M}\x{200C}\x{200D}\x{AD}\x{2060}-\x{2064}\x{FEFF}\x{1F3FB}-\x{1F3FF}]') THEN 'X'
    WHEN regexp_matches(c, '[\p{Katakana}\x{30FC}\x{FF70}\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}]') THEN 'K'
    WHEN regexp_matches(c, '[\p{Han}\p{Hiragana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]') THEN 'U'
    WHEN regexp_matches(c, '[\p{L}\p{Nl}]') THEN 'A'
    WHEN regexp_matches(c, '\p{Nd}') THEN 'N'
    WHEN regexp_matches(c, '[\p{Pc}\x{202F}]') THEN 'E'
    WHEN regexp_matches(c, '[:\x{B7}\x{387}\x{55F}\x{5F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}]') THEN 'ML'
    WHEN regexp_matches(c, '[,;\x{37E}\x{589}\x{60C}\x{60D}\x{66C}\x{7F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}]') THEN 'MN'
    WHEN regexp_matches(c, '[.''\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}]') THEN 'MB'
    WHEN c IN (' ', E'\t', E'\n', E'\r') THEN 'S' ELSE 'O' END AS cls
  FROM (SELECT doc_id, i, cs[i] AS c FROM (SELECT doc_id, cs, unnest(range(1, len(cs) + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '(?s).') AS cs FROM documents)))),
u_near AS (
  SELECT *, lag(cls) OVER w AS p, lag(cls, 2) OVER w AS pp, lead(cls) OVER w AS f FROM u_char WHERE cls <> 'X'
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
u_break AS (
  SELECT doc_id, i, coalesce(NOT (
    (p IN ('A', 'N') AND cls IN ('A', 'N')) OR (p = 'K' AND cls = 'K')
    OR (p IN ('A', 'N', 'K', 'E') AND cls = 'E') OR (p = 'E' AND cls IN ('A', 'N', 'K'))
    OR (p = 'A' AND cls IN ('ML', 'MB') AND f = 'A') OR (pp = 'A' AND p IN ('ML', 'MB') AND cls = 'A')
    OR (p = 'N' AND cls IN ('MN', 'MB') AND f = 'N') OR (pp = 'N' AND p IN ('MN', 'MB') AND cls = 'N')), true) AS opens
  FROM u_near),
u_piece AS (
  SELECT doc_id, i, c, cls, sum(coalesce(opens, false)::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS piece
  FROM u_char LEFT JOIN u_break USING (doc_id, i)),
u_mark AS (
  SELECT doc_id, min(i) AS pos, string_agg(c, '' ORDER BY i) AS w
  FROM (SELECT *, sum((cls = 'S')::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS blank FROM u_char) WHERE cls <> 'S'
  GROUP BY doc_id, blank HAVING NOT regexp_matches(w, '[\p{L}\p{N}]')),
u_word AS (
  SELECT doc_id, min(i) AS pos, string_agg(c, '' ORDER BY i) AS w FROM u_piece
  GROUP BY doc_id, piece HAVING count(*) FILTER (cls IN ('A', 'N', 'K', 'U')) > 0
  UNION ALL SELECT * FROM u_mark)"""


# --- F3: C4 ------------------------------------------------------------------------------


def c4_ctes(source: str = "documents", p: str = "") -> str:
    """``{p}c4(doc_id, c4_text, n_sentences, c4_reason)``."""
    return rf"""
{p}c4_split AS (
  SELECT doc_id, i, trim(string_split(text, E'\n')[i], E' \t\r\n') AS l
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, E'\n')) + 1)) AS i FROM {source})),
{p}c4_line AS (
  SELECT doc_id, i, trim(regexp_replace(l, '\[[0-9]*\]|\[edit\]|\[citation needed\]', '', 'g'), E' \t\r\n') AS l
  FROM {p}c4_split WHERE l <> ''),
{p}c4_kept AS (
  SELECT doc_id, i, l, regexp_split_to_array(l, '[ \t\r]+') AS ws FROM {p}c4_line
  WHERE right(l, 1) IN ('.', '!', '?', '"') AND right(l, 3) <> '...'
    AND NOT regexp_matches(lower(l), 'javascript|terms of use|privacy policy|cookie policy|uses cookies|use of cookies|use cookies')),
{p}c4_joined AS (
  SELECT doc_id, string_agg(l, E'\n' ORDER BY i) AS t FROM {p}c4_kept
  WHERE len(ws) >= 3 AND len(list_filter(ws, lambda w: length(w) > 1000)) = 0 GROUP BY doc_id),
{p}c4 AS (
  SELECT doc_id, c4_text, n_sentences,
         CASE WHEN contains(text, '{{') THEN 'curly_bracket'
              WHEN contains(lower(text), 'lorem ipsum') THEN 'lorem_ipsum'
              WHEN n_sentences < 5 THEN 'too_few_sentences' END AS c4_reason
  FROM (
    SELECT d.doc_id, d.text, coalesce(t, '') AS c4_text,
           CASE WHEN t IS NULL THEN 0
                ELSE 1 + len(regexp_extract_all(t, '[.!?]["'')\]]*[ \t]+|\n')) END::INTEGER AS n_sentences
    FROM {source} d LEFT JOIN {p}c4_joined USING (doc_id)))"""


# --- F3: learned sentence boundaries -------------------------------------------------------

SENTENCE_TOKEN = r"""regexp_replace(regexp_replace(tok, '^["''(\[]+', ''), '["'')\],;:!?]+$', '')"""


def _sentence_type(bare: str) -> str:
    cut = f"regexp_replace(lower({bare}), '\\.$', '')"
    return rf"CASE WHEN regexp_matches({cut}, '^[0-9]+$') THEN '##' WHEN regexp_matches({cut}, '^\p{{L}}[\p{{L}}.''-]*$') THEN {cut} END"


def _hits(k: str, n: str, p: str) -> str:
    return f"(CASE WHEN {k} = 0 THEN 0 ELSE {k} * ln({p}) END + CASE WHEN {n} = {k} THEN 0 ELSE ({n} - ({k})) * ln(1 - {p}) END)"


def _pair_likelihood(a: str, b: str, ab: str, n: str) -> str:
    rest = f"(({b} - {ab})::DOUBLE / ({n} - {a}))"
    return f"-2 * ({_hits(ab, a, f'({b}::DOUBLE / {n})')} + {_hits(f'({b} - {ab})', f'({n} - {a})', f'({b}::DOUBLE / {n})')} - {_hits(ab, a, f'({ab}::DOUBLE / {a})')} - {_hits(f'({b} - {ab})', f'({n} - {a})', rest)})"


SENTENCE_WORDS = rf"""
s_token AS MATERIALIZED (
  SELECT doc_id, ln, i, tok, b, b LIKE '%.' AND b NOT LIKE '%..' AS dotted, {_sentence_type("b")} AS type, regexp_matches(b, '^\p{{Lu}}') AS upper
  FROM (SELECT doc_id, ln, i, toks[i] AS tok, {SENTENCE_TOKEN.replace("tok", "toks[i]")} AS b
        FROM (SELECT doc_id, ln, toks, unnest(range(1, len(toks) + 1)) AS i
              FROM (SELECT doc_id, ln, list_filter(regexp_split_to_array(string_split(text, E'\n')[ln], '[ \t\r]+'), lambda w: w <> '') AS toks
                    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, E'\n')) + 1)) AS ln FROM documents))))),
s_count AS (SELECT type, count(*) AS n, count(*) FILTER (dotted) AS k FROM s_token GROUP BY type),
s_total AS (SELECT sum(n)::DOUBLE AS n_all, sum(k)::DOUBLE AS k_all FROM s_count),
s_scored AS (
  SELECT type, n, k, -2 * ({_hits('k', 'n', '(k_all / n_all)')} - {_hits('k', 'n', '0.99::DOUBLE')}) * exp(-letters) * (length(type) - letters + 1) * pow(letters::DOUBLE, k - n) AS score
  FROM (SELECT *, length(replace(type, '.', '')) AS letters FROM s_count) JOIN s_total ON k > 0 AND type <> '##')"""

SENTENCE_MODEL = rf"""
s_short AS (SELECT type FROM s_scored WHERE score >= 0.3),
s_place AS MATERIALIZED (
  SELECT t.*, p.tok AS p_tok, p.type AS p_type, p.dotted AS p_dotted,
         coalesce(p.type = '##' OR length(p.type) = 1 OR p.type IN (FROM s_short), false) AS p_short
  FROM s_token t LEFT JOIN s_token p ON p.doc_id = t.doc_id AND p.ln = t.ln AND p.i = t.i - 1),
s_state AS (
  SELECT type, upper, CASE WHEN p_tok IS NULL OR regexp_matches(p_tok, '[!?]["'')\]]*$') OR (p_dotted AND NOT p_short) THEN 0 WHEN p_dotted THEN 1 ELSE 2 END AS state FROM s_place),
s_used AS (
  SELECT type, count(*) AS n, count(*) FILTER (state = 0 AND upper) AS n_start, count(*) FILTER (state = 2 AND upper) AS n_inside, count(*) FILTER (NOT upper) AS n_lower
  FROM s_state WHERE type IS NOT NULL AND type <> '##' GROUP BY type),
s_starts AS (SELECT count(*)::DOUBLE AS breaks FROM s_state WHERE state = 0),
s_first AS (
  SELECT type FROM s_used, s_starts, s_total WHERE n_start > 0
    AND ((n_lower > 0 AND n_inside = 0) OR (n_all * n_start > breaks * n AND {_pair_likelihood('breaks', 'n', 'n_start', 'n_all')} >= 30))),
s_met AS (SELECT p_type AS a, type AS b, count(*) AS n FROM s_place WHERE p_dotted AND p_short AND type IS NOT NULL GROUP BY 1, 2),
s_bound AS (
  SELECT a, b FROM (SELECT m.*, x.n AS na, y.n AS nb FROM s_met m JOIN s_count x ON x.type = a JOIN s_count y ON y.type = b), s_total
  WHERE n_all * n > na * nb AND {_pair_likelihood('na', 'nb', 'n', 'n_all')} >= 7.88),
s_piece AS (
  SELECT doc_id, list_filter(regexp_split_to_array(l, '[ \t]+'), lambda w: w <> '') AS toks, row_number() OVER () AS piece
  FROM (SELECT doc_id, unnest(regexp_split_to_array(c4_text, '[\r\n]')) AS l FROM c4)),
s_pair AS (
  SELECT doc_id, p_b, b, {_sentence_type("p_b")} AS p_type, {_sentence_type("b")} AS type
  FROM (SELECT doc_id, {SENTENCE_TOKEN.replace("tok", "toks[i]")} AS p_b, {SENTENCE_TOKEN.replace("tok", "toks[i + 1]")} AS b
        FROM (SELECT doc_id, toks, unnest(range(1, len(toks))) AS i FROM s_piece) WHERE toks[i] LIKE '%.')
  WHERE p_b LIKE '%.' AND p_b NOT LIKE '%..'),
s_held AS (
  SELECT doc_id, count(*) AS held FROM s_pair
  WHERE (p_type IN (FROM s_short) AND NOT (regexp_matches(b, '^\p{{Lu}}') AND coalesce(type IN (FROM s_first), false)))
     OR ((p_type, type) IN (SELECT (a, b) FROM s_bound) AND NOT coalesce(type IN (FROM s_first), false)) GROUP BY doc_id)"""


# --- F5: ingest ---------------------------------------------------------------------------


def ingest_ctes(source: str = "documents", p: str = "") -> str:
    """``{p}judged(doc_id, text, language, language_score, stage, reason)``."""
    return ",".join([lang_ctes(source, p), gopher_ctes(source, p), c4_ctes(source, p)]) + rf""",
{p}judged AS (
  SELECT doc_id, CASE WHEN stage IS NULL THEN c4_text ELSE text END AS text, language, language_score, stage,
         CASE stage WHEN 'language' THEN CASE WHEN language IS NULL THEN 'no_known_word' ELSE 'other_language' END
                    WHEN 'gopher' THEN gopher_reason WHEN 'c4' THEN c4_reason END AS reason
  FROM (
    SELECT d.doc_id, d.text, l.language, l.language_score, g.gopher_reason, c.c4_reason, c.c4_text,
           CASE WHEN l.language IS NULL OR l.language <> 'en' OR l.language_score < 0.65 THEN 'language'
                WHEN g.gopher_reason IS NOT NULL THEN 'gopher'
                WHEN c.c4_reason IS NOT NULL THEN 'c4' END AS stage
    FROM {source} d JOIN {p}lang l USING (doc_id) JOIN {p}gopher g USING (doc_id) JOIN {p}c4 c USING (doc_id))),
{p}clean AS (SELECT doc_id, text FROM {p}judged WHERE stage IS NULL)"""


# --- D1-D4: near copies ---------------------------------------------------------------------


def _md5_31(value: str) -> str:
    return f"('0x' || substr(md5({value}), 1, 8))::BIGINT"


PERMUTATIONS = f"""
perm AS (
  SELECT j, 1 + {_md5_31("'a:1:' || j")} % 2147483646 AS a, {_md5_31("'b:1:' || j")} % 2147483647 AS b
  FROM range(112) r(j))"""


def band_ctes(source: str, p: str) -> str:
    """``{p}sig(doc_id, j, v)`` and ``{p}band(doc_id, band, band_hash)``; needs ``perm``."""
    token_hash = f"{_md5_31('t')} % 2147483647"
    rolled = "h"
    for k in range(1, 5):
        rolled = f"(({rolled}) * 1000003 + lead(h, {k}) OVER w) % 2147483647"
    return rf"""
{p}tok AS (
  SELECT doc_id, i, ts[i] AS t
  FROM (SELECT doc_id, ts, unnest(range(1, len(ts) + 1)) AS i
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS ts
              FROM {source}))),
{p}shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, s
  FROM (SELECT doc_id, {rolled} AS s, lead(h, 4) OVER w AS last_h
        FROM (SELECT doc_id, i, {token_hash} AS h FROM {p}tok)
        WINDOW w AS (PARTITION BY doc_id ORDER BY i))
  WHERE last_h IS NOT NULL),
{p}sig AS MATERIALIZED (SELECT doc_id, j, min((a * s + b) % 2147483647) AS v FROM {p}shingle, perm GROUP BY doc_id, j),
{p}band AS MATERIALIZED (
  SELECT doc_id, (j // 8)::INTEGER AS band, md5(string_agg(v::VARCHAR, '-' ORDER BY j)) AS band_hash
  FROM {p}sig GROUP BY doc_id, j // 8)"""


def dedup_ctes(source: str, p: str) -> str:
    """``{p}component(id, component)`` over all documents of a bucket; needs ``perm`` and RECURSIVE."""
    return band_ctes(source, p) + rf""",
{p}star AS (
  SELECT DISTINCT doc_id AS x, m AS y
  FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY band, band_hash) AS m FROM {p}band) WHERE doc_id <> m),
{p}link AS MATERIALIZED (SELECT x, y FROM {p}star UNION SELECT y, x FROM {p}star),
{p}reach(x, y) AS (
  SELECT x, x FROM {p}link UNION SELECT r.x, l.y FROM {p}reach r JOIN {p}link l ON r.y = l.x),
{p}component AS (SELECT x AS id, min(y) AS component FROM {p}reach GROUP BY x),
{p}kept AS (
  SELECT * FROM {source} WHERE doc_id NOT IN (SELECT id FROM {p}component WHERE id <> component))"""


# --- M1: TF-IDF ---------------------------------------------------------------------------------



def topic_ctes(k: int = 8, n_init: int = 10, max_iter: int = 20, seed: int = 42) -> str:
    """``topic(doc_id, topic_cluster)`` over ``d_kept``: as many rounds as there may be, for all starts at once.

    The term frequencies are those of TFIDF, counted in ``d_kept``.
    """
    ctes = TFIDF.replace("documents", "d_kept") + rf""",
x AS MATERIALIZED (
  SELECT doc_id, term, floor(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) * 65536 + 0.5)::BIGINT AS q FROM weighted),
drawn AS MATERIALIZED (
  SELECT doc_id, row_number() OVER (ORDER BY md5('{seed}:' || doc_id)) - 1 AS place, count(*) OVER () AS n FROM d_kept),
starts AS (SELECT i, c FROM range({n_init}) AS s(i), range({k}) AS t(c)),
chosen AS (
  SELECT i, c, doc_id FROM starts JOIN drawn ON place = (i * {k} + c) % least(n, {n_init * k})),
m0 AS MATERIALIZED (SELECT i, c, term, q AS v FROM chosen JOIN x USING (doc_id)),
"""
    assign = lambda r: f"""
l{r} AS MATERIALIZED (
  SELECT i, c, sum(v * v) AS s FROM m{r} GROUP BY i, c),
a{r} AS MATERIALIZED (
  SELECT i, doc_id, c, score
  FROM (SELECT g.i, g.doc_id, g.c, coalesce(l.s, 0) - 2 * coalesce(p.p, 0) AS score,
               row_number() OVER (PARTITION BY g.i, g.doc_id ORDER BY coalesce(l.s, 0) - 2 * coalesce(p.p, 0), g.c) AS r
        FROM (SELECT i, c, doc_id FROM starts, d_kept) g
        LEFT JOIN l{r} l ON l.i = g.i AND l.c = g.c
        LEFT JOIN (SELECT m.i, m.c, x.doc_id, sum(m.v * x.q) AS p FROM x JOIN m{r} m ON m.term = x.term GROUP BY 1, 2, 3) p
               ON p.i = g.i AND p.c = g.c AND p.doc_id = g.doc_id)
  WHERE r = 1)"""  # noqa: E731
    for r in range(max_iter):
        ctes += assign(r) + f""",
n{r} AS MATERIALIZED (SELECT i, c, count(*) AS n FROM a{r} GROUP BY i, c),
m{r + 1} AS MATERIALIZED (
  SELECT a.i, a.c, x.term, (2 * sum(x.q) + n.n) // (2 * n.n) AS v
  FROM a{r} a JOIN n{r} n ON n.i = a.i AND n.c = a.c JOIN x ON x.doc_id = a.doc_id GROUP BY a.i, a.c, x.term, n.n
  UNION ALL
  SELECT m.i, m.c, m.term, m.v FROM m{r} m WHERE NOT EXISTS (SELECT 1 FROM n{r} n WHERE n.i = m.i AND n.c = m.c)),
"""
    return ctes + assign(max_iter) + f""",
cheapest AS (SELECT i FROM a{max_iter} GROUP BY i ORDER BY sum(score), i LIMIT 1),
topic AS (SELECT doc_id, c::INTEGER AS topic_cluster FROM a{max_iter} JOIN cheapest USING (i))"""


TFIDF = rf"""
term_hit AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM documents)
  WHERE term NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}) GROUP BY doc_id, term),
vocabulary AS (
  SELECT term, sum(tf) AS total, count(*) AS df FROM term_hit GROUP BY term HAVING count(*) >= 2
  ORDER BY total DESC, term LIMIT 20000),
weighted AS (
  SELECT h.doc_id, h.term, h.tf,
         h.tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + v.df)::DOUBLE) + 1) AS w
  FROM term_hit h JOIN vocabulary v USING (term))"""


# --- A1-A4: shards ---------------------------------------------------------------------------------

SHARDS = """
shard_of AS (
  SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 64)::INTEGER AS shard FROM documents),
stats AS (
  SELECT s.shard, count(*) AS n_docs, avg(length(d.text)) AS avg_text_len, avg(l.quality) AS avg_quality_score,
         avg(g.language_score) AS avg_language_score,
         count(DISTINCT d.lang)::DOUBLE AS n_topic_clusters_present
  FROM documents d JOIN shard_of s USING (doc_id) JOIN lang g USING (doc_id) LEFT JOIN labels l USING (doc_id)
  GROUP BY s.shard)"""

METRICS = ["n_docs", "avg_text_len", "avg_quality_score", "avg_language_score", "n_topic_clusters_present"]

Z = ", ".join(
    f"CASE WHEN stddev_pop({m}) OVER () = 0 THEN 0 ELSE ({m} - avg({m}) OVER ()) / stddev_pop({m}) OVER () END AS {m}_z"
    for m in METRICS
)
Z_SCORES = f"z AS (SELECT shard, {Z} FROM stats)"
FLAGS = "list_filter([" + ", ".join(
    f"CASE WHEN abs({m}_z) > 1.5 THEN '{m} (z=' || printf('%+.2f', {m}_z) || ')' END" for m in METRICS
) + "], lambda f: f IS NOT NULL)"


# --- B: mixes -------------------------------------------------------------------------------------------

HELD_OUT = ("src18", "src19")
HELD = ", ".join(f"'{s}'" for s in HELD_OUT)
STEPS = 6
BUDGET = 600 * 32 * 128


def mix_ctes() -> str:
    """``variant_doc(variant, doc_id, text)`` and ``shared_doc(shared_set, doc_id, text)``."""
    return ",".join(
        [
            PERMUTATIONS,
            ingest_ctes("documents", "i_"),
            f"""
held AS (SELECT doc_id FROM documents WHERE source IN ({HELD})),
raw_train AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM held)),
raw_held AS (SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM held)),
clean_train AS MATERIALIZED (SELECT doc_id, text FROM i_clean WHERE doc_id NOT IN (SELECT doc_id FROM held)),
clean_held AS MATERIALIZED (SELECT doc_id, text FROM i_clean WHERE doc_id IN (SELECT doc_id FROM held))""",
            dedup_ctes("raw_train", "r_"),
            dedup_ctes("clean_train", "c_"),
            band_ctes("raw_held", "rh_"),
            band_ctes("clean_held", "ch_"),
            """
seen AS MATERIALIZED (SELECT band, band_hash FROM r_band UNION SELECT band, band_hash FROM c_band),
variant_doc AS MATERIALIZED (
  SELECT 'raw' AS variant, doc_id, text FROM raw_train
  UNION ALL SELECT 'deduped', doc_id, text FROM r_kept
  UNION ALL SELECT 'deduped_filtered', doc_id, text FROM c_kept),
shared_doc AS MATERIALIZED (
  SELECT 'filtered' AS shared_set, doc_id, text FROM clean_held
  WHERE doc_id NOT IN (SELECT doc_id FROM ch_band JOIN seen USING (band, band_hash))
  UNION ALL SELECT 'unfiltered', doc_id, text FROM raw_held
  WHERE doc_id NOT IN (SELECT doc_id FROM rh_band JOIN seen USING (band, band_hash)))""",
        ]
    )


TOKENS = r"list_append(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> ''), '<eot>')"

STREAM = f"""
variant_tok AS MATERIALIZED (SELECT variant, doc_id, {TOKENS} AS ts FROM variant_doc),
placed AS MATERIALIZED (
  SELECT variant, doc_id, ts, len(ts) AS n_tokens,
         (sum(len(ts)) OVER (PARTITION BY variant ORDER BY md5('1234:' || doc_id)) - len(ts))::BIGINT AS "offset"
  FROM variant_tok),
size AS MATERIALIZED (
  SELECT variant, count(*) AS n_docs, sum(n_tokens)::BIGINT AS n_tokens_total,
         floor(sum(n_tokens)::BIGINT * 0.9::DOUBLE)::BIGINT AS n_train_tokens
  FROM placed GROUP BY variant),
budget AS (SELECT least({BUDGET}, min(n_train_tokens)) AS b FROM size)"""

LOSS = f"""
stream AS MATERIALIZED (
  SELECT variant, "offset" + i - 1 AS pos, CASE WHEN i = 1 THEN '<eot>' ELSE ts[i - 1] END AS prev, ts[i] AS cur
  FROM (SELECT variant, "offset", ts, unnest(range(1, len(ts) + 1)) AS i FROM placed)),
step AS (SELECT k, (b * k // {STEPS})::BIGINT AS tokens FROM budget, range(1, {STEPS} + 1) r(k)),
used AS MATERIALIZED (
  SELECT s.variant, prev, cur, pos, pos < b AS is_train, pos >= n_train_tokens AS is_val
  FROM stream s JOIN size USING (variant), budget WHERE pos < b OR pos >= n_train_tokens),
shared_pair AS MATERIALIZED (
  SELECT shared_set, CASE WHEN i = 1 THEN '<eot>' ELSE ts[i - 1] END AS prev, ts[i] AS cur, count(*) AS n
  FROM (SELECT shared_set, ts, unnest(range(1, len(ts) + 1)) AS i
        FROM (SELECT shared_set, {TOKENS} AS ts FROM shared_doc)) GROUP BY ALL),
vocabulary AS (SELECT count(*) AS v FROM (SELECT cur FROM used UNION SELECT cur FROM shared_pair)),
bi AS MATERIALIZED (
  SELECT variant, k, prev, cur, count(*) AS c FROM used, step WHERE pos < tokens GROUP BY ALL),
ctx AS MATERIALIZED (SELECT variant, k, prev, sum(c) AS h FROM bi GROUP BY ALL),
uni AS MATERIALIZED (SELECT variant, k, cur, sum(c) AS u FROM bi GROUP BY ALL),
asked AS (
  SELECT variant, k, 'train' AS part, prev, cur, c AS n FROM bi
  UNION ALL SELECT variant, k, 'val', prev, cur, count(*) FROM used, step WHERE is_val GROUP BY ALL
  UNION ALL SELECT variant, k, shared_set, prev, cur, n FROM shared_pair, step, (SELECT variant FROM size)),
scored AS (
  SELECT variant, k, tokens, part, n,
         -ln(CASE WHEN h > 0 THEN 0.75 * coalesce(c, 0)::DOUBLE / h + 0.25 * ((coalesce(u, 0) + 1)::DOUBLE / (tokens + v))
                  ELSE (coalesce(u, 0) + 1)::DOUBLE / (tokens + v) END) AS nll
  FROM asked JOIN step USING (k) LEFT JOIN bi USING (variant, k, prev, cur) LEFT JOIN ctx USING (variant, k, prev)
  LEFT JOIN uni USING (variant, k, cur), vocabulary),
curve AS MATERIALIZED (
  SELECT variant, k::INTEGER AS step, tokens,
         round(sum(n * nll) FILTER (part = 'train') / sum(n) FILTER (part = 'train'), 6) AS train_loss,
         round(sum(n * nll) FILTER (part = 'val') / sum(n) FILTER (part = 'val'), 6) AS val_loss,
         round(sum(n * nll) FILTER (part = 'filtered') / sum(n) FILTER (part = 'filtered'), 6) AS shared_eval_loss,
         round(sum(n * nll) FILTER (part = 'unfiltered') / sum(n) FILTER (part = 'unfiltered'), 6) AS shared_raw_loss
  FROM scored GROUP BY variant, k, tokens)"""

ORDER = "CASE variant WHEN 'raw' THEN 1 WHEN 'deduped' THEN 2 ELSE 3 END::INTEGER AS variant_order"


def page_text_sql() -> str:
    text = "html"
    steps = [
        *[(rf"(?is)<{e}[ \t\r\n>].*?</{e}[ \t\r\n]*>", "' '") for e in ("script", "style", "noscript", "template")],
        (r"(?s)<!--.*?-->", "' '"),
        (rf"(?i)</?({BLOCK})([ \t\r\n/][^>]*)?>", r"E'\n'"),
        (r"<[^>]*>", "' '"),
    ]
    for pattern, to in steps:
        text = f"regexp_replace({text}, '{pattern}', {to}, 'g')"
    for entity, char in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("apos", "''"), ("amp", "&")):
        text = f"replace({text}, '&{entity};', '{char}')"
    text = rf"regexp_replace({text}, '[ \t\r]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\n[ \n]*', E'\n', 'g')"
    return rf"SELECT page_id, url, trim({text}, E' \n') AS text FROM pages"


WET_RECORDS = """
SELECT doc_id, 'http://example.org/' || doc_id AS url,
       md5(coalesce(text, '') || chr(13) || chr(10) || chr(13) || chr(10) || 'WARC/1.0' || chr(13) || chr(10)
           || 'WARC-Type: conversion' || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(lang, '')) AS body_md5,
       true AS length_ok
FROM documents"""

QUARANTINE = """
SELECT 'malformed' AS reason, count(*) AS n_lines, count(*) AS n_distinct FROM documents WHERE doc_id % 10 = 3
UNION ALL SELECT 'no text', count(*), count(*) FROM documents WHERE doc_id % 25 = 4
UNION ALL SELECT 'document', count(*), count(DISTINCT doc_id) FROM documents"""


FUNNEL = """SELECT 1 AS stage_order, 'language' AS stage, count(*) AS docs_in, count(*) FILTER (stage IS NULL OR stage <> 'language') AS docs_out, count(*) FILTER (stage = 'language') AS dropped FROM judged
UNION ALL SELECT 2, 'gopher', count(*), count(*) FILTER (stage IS NULL OR stage <> 'gopher'), count(*) FILTER (stage = 'gopher') FROM judged WHERE stage IS NULL OR stage <> 'language'
UNION ALL SELECT 3, 'c4', count(*), count(*) FILTER (stage IS NULL), count(*) FILTER (stage = 'c4') FROM judged WHERE stage IS NULL OR stage = 'c4'"""


def all_queries() -> dict[str, str]:
    judged = ingest_ctes()
    dup = f"WITH RECURSIVE {PERMUTATIONS},{dedup_ctes('documents', 'd_')}"
    clean_dup = f"WITH RECURSIVE {PERMUTATIONS},{ingest_ctes('documents', 'i_')},{dedup_ctes('i_clean', 'd_')}"
    shards = f"WITH {lang_ctes()},{SHARDS}"
    labelled = f"WITH {judged}, train AS (SELECT doc_id, (stage IS NULL)::INTEGER AS label FROM judged WHERE stage IS NULL OR stage <> 'language')"
    scored = f"WITH {lang_ctes()}, scored AS (SELECT d.doc_id, coalesce(language_score, 0) AS s, l.quality AS label FROM lang d JOIN labels l USING (doc_id))"
    mixes = f"WITH RECURSIVE {mix_ctes()}"
    stream = f"{mixes},{STREAM}"
    loss = f"{stream},{LOSS}"
    stepped = f"""WITH {judged},
piece AS (SELECT doc_id, part::INTEGER AS part, array_to_string(l[3 * part + 1 : 3 * part + 3], E'\\n') AS t
          FROM (SELECT doc_id, l, unnest(range((len(l) + 2) // 3)) AS part FROM (SELECT doc_id, string_split(text, E'\\n') AS l FROM clean))),
long AS (SELECT doc_id, part, regexp_replace(t, '[0-9]', '#', 'g') AS text FROM piece WHERE length(t) >= 200)"""
    sizes = "clean_docs_in, deduped_docs_out, clean_docs_in - deduped_docs_out AS near_dups_removed, round((clean_docs_in - deduped_docs_out) / clean_docs_in::DOUBLE * 100, 2) AS near_dups_removed_pct"
    return {
        "lang_score": f"WITH {lang_ctes()} SELECT doc_id, language, round(language_score, 6) AS language_score FROM lang",
        "lang_softmax": f"SELECT lang, count(*) AS n_docs, true AS told FROM documents WHERE {_md5_31(chr(39) + '42:' + chr(39) + ' || doc_id')} / 4294967296.0::DOUBLE < 0.5 AND text <> '' GROUP BY lang",
        "wet_records": WET_RECORDS,
        "jsonl_round_trip": f"WITH {lang_ctes()} SELECT doc_id, md5(coalesce(text, '')) AS text_md5, language FROM lang JOIN documents USING (doc_id)",
        "jsonl_quarantine": QUARANTINE,
        "gopher_features": f"WITH {gopher_ctes()} SELECT doc_id, n_words, mean_word_length, round(hash_ratio, 6) AS hash_ratio, round(ellipsis_ratio, 6) AS ellipsis_ratio, round(bullet_line_share, 6) AS bullet_line_share, round(ellipsis_line_share, 6) AS ellipsis_line_share, round(letter_word_share, 6) AS letter_word_share, n_stop_words FROM gopher",
        "gopher_keep": f"WITH {gopher_ctes()} SELECT doc_id, gopher_reason FROM gopher",
        "c4_clean_text": f"WITH {c4_ctes()} SELECT doc_id, c4_text, n_sentences, c4_reason FROM c4",
        "ingest_funnel": f"WITH {judged} {FUNNEL}",
        "ingest_steps": f"{stepped} SELECT doc_id, part, text FROM long",
        "ingest_steps_funnel": f"""{stepped}, n AS (SELECT (SELECT count(*) FROM clean) AS docs, (SELECT count(*) FROM piece) AS pieces, (SELECT count(*) FROM long) AS longs)
{FUNNEL}
UNION ALL SELECT 4, 'three_lines', docs, pieces, 0 FROM n UNION ALL SELECT 5, 'short', pieces, longs, pieces - longs FROM n
UNION ALL SELECT 6, 'no_digits', longs, longs, 0 FROM n""",
        "ingest_rejects": f"WITH {judged} SELECT doc_id, stage AS reject_stage, reason AS reject_reason, text FROM judged WHERE stage IN ('gopher', 'c4')",
        "ingest_clean": f"WITH {judged} SELECT doc_id, text, language, round(language_score, 6) AS language_score FROM judged WHERE stage IS NULL",
        "ingest_summary": f"WITH {judged} SELECT count(*) AS raw_docs, count(*) FILTER (stage IS NULL) AS clean_docs, count(stage) AS dropped, round(count(stage) / count(*)::DOUBLE * 100, 2) AS dropped_pct FROM judged",
        "page_text": page_text_sql(),
        "minhash_signature": f"WITH {PERMUTATIONS},{band_ctes('documents', 'd_')} SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY j) AS signature FROM d_sig GROUP BY doc_id",
        "minhash_bands": f"WITH {PERMUTATIONS},{band_ctes('documents', 'd_')} SELECT doc_id, band, band_hash FROM d_band",
        "band_index_groups": f"{dup} SELECT id AS doc_id, component FROM d_component WHERE id <> component",
        "dup_components": f"{dup} SELECT id AS doc_id, component FROM d_component WHERE id <> component",
        "topic_clusters": f"{clean_dup},{topic_ctes()} SELECT doc_id, topic_cluster FROM topic",
        "topic_sizes": f"{clean_dup},{topic_ctes()} SELECT topic_cluster, count(*) AS n_docs FROM topic GROUP BY topic_cluster",
        "near_dedup": f"{dup} SELECT doc_id, n_chars FROM d_kept",
        "dedup_summary": f"{clean_dup} SELECT {sizes} FROM (SELECT (SELECT count(*) FROM i_clean) AS clean_docs_in, (SELECT count(*) FROM d_kept) AS deduped_docs_out)",
        "tfidf_terms": f"WITH {TFIDF} SELECT doc_id, term, tf::INTEGER AS tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM weighted",
        "train_set": f"{labelled} SELECT doc_id, label FROM train",
        "split_counts": f"{labelled} SELECT label, {_md5_31(chr(39) + '42:' + chr(39) + ' || doc_id')} / 4294967296.0::DOUBLE < 0.2 AS is_test, count(*) AS n FROM train GROUP BY ALL",
        "split_exact": f"{labelled} SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id)) <= round(count(*) OVER (PARTITION BY label) * 0.2) AS is_test FROM train",
        "score_auc": f"""{scored},
ranked AS (SELECT label, s, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM scored)
SELECT count(*) AS n, count(*) FILTER (label = 1) AS n_positive,
       round(count(*) FILTER ((s >= 0.5) = (label = 1)) / count(*)::DOUBLE, 6) AS accuracy,
       round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)::DOUBLE
             / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0))::DOUBLE, 6) AS roc_auc FROM ranked""",
        "score_quantiles": f"WITH {lang_ctes()} SELECT round(min(language_score), 6) AS min, round(quantile_cont(language_score, 0.25), 6) AS p25, round(quantile_cont(language_score, 0.5), 6) AS median, round(quantile_cont(language_score, 0.75), 6) AS p75, round(max(language_score), 6) AS max FROM lang",
        "shard_quantiles": f"""{shards},
v AS (SELECT s.shard::VARCHAR AS scope, l.language_score AS s FROM shard_of s JOIN lang l USING (doc_id)
      UNION ALL SELECT 'corpus', language_score FROM lang WHERE language_score IS NOT NULL)
SELECT scope, count(s) AS n, round(min(s), 6) AS min, round(quantile_disc(s, 0.25), 6) AS p25, round(quantile_disc(s, 0.5), 6) AS median,
       round(quantile_disc(s, 0.75), 6) AS p75, round(max(s), 6) AS max FROM v GROUP BY scope""",
        "quality_threshold": f"WITH {lang_ctes()} SELECT doc_id, round(language_score, 6) AS quality_score FROM lang WHERE language_score >= 0.9",
        "shard_rows": f"WITH {lang_ctes()} SELECT d.doc_id::VARCHAR AS id, d.text, NULL::VARCHAR AS url, NULL::VARCHAR AS date, l.language, l.language_score::FLOAT AS language_score, -1::INTEGER AS topic_cluster, NULL::FLOAT AS quality_score, 'CC-TEST' AS crawl FROM documents d JOIN lang l USING (doc_id)",
        "shard_assign": f"{shards} SELECT doc_id, shard FROM shard_of",
        "shard_files": "SELECT file, least(64, n - 64 * file) AS rows FROM (SELECT count(*) AS n FROM documents), range(CAST(ceil(n / 64) AS BIGINT)) AS r(file)",
        "published_shards": "SELECT file, least(64, n - 64 * file) AS rows FROM (SELECT count(*) AS n FROM documents), range(CAST(ceil(n / 64) AS BIGINT)) AS r(file)",
        "stage_stats": f"WITH {judged} SELECT 'ingest_clean' AS stage, count(*) AS raw_docs, count(*) FILTER (stage IS NULL) AS clean_docs, count(stage) AS dropped, round(count(stage) / count(*)::DOUBLE * 100, 2) AS dropped_pct FROM judged",
        "report_curve": f"{loss} SELECT {ORDER}, variant, step, tokens, train_loss, val_loss FROM curve",
        "shard_round_trip": "SELECT doc_id::VARCHAR AS id, text, -1::INTEGER AS topic_cluster, '2026' AS crawl FROM documents",
        "shard_stats": f"{shards} SELECT shard, n_docs, round(avg_text_len, 6) AS avg_text_len, round(avg_quality_score, 6) AS avg_quality_score, round(avg_language_score, 6) AS avg_language_score, n_topic_clusters_present FROM stats",
        "shard_flags": f"{shards}, {Z_SCORES} SELECT shard, {', '.join(f'round({m}_z, 6) AS {m}_z' for m in METRICS)}, array_to_string({FLAGS}, '; ') AS flags FROM z",
        "shard_flag_count": f"{shards}, {Z_SCORES} SELECT count(*) FILTER (len({FLAGS}) > 0) AS n_flagged, count(*) AS n_shards, round(sqrt(count(*) - 1), 6) AS z_ceiling FROM z",
        "variant_counts": f"{mixes} SELECT variant, count(*) AS n_docs FROM variant_doc GROUP BY variant",
        "shared_sets": f"{mixes} SELECT shared_set, doc_id FROM shared_doc",
        "token_offsets": f'{stream} SELECT variant, doc_id, n_tokens::INTEGER AS n_tokens, "offset" FROM placed',
        "token_budget": f"{stream} SELECT variant, n_docs, n_tokens_total, n_train_tokens, n_tokens_total - n_train_tokens AS n_val_tokens, b AS budget FROM size, budget",
        "sample_batches": f"""{stream},
stream AS MATERIALIZED (SELECT variant, "offset" + i - 1 AS pos, ts[i] AS cur FROM (SELECT variant, "offset", ts, unnest(range(1, len(ts) + 1)) AS i FROM placed)),
drawn AS (
  SELECT variant, draw_id::INTEGER AS draw_id, ('0x' || left(md5('1337:' || variant || ':' || draw_id), 15))::BIGINT % (n_tokens_total - 129) AS start
  FROM size, range(64) AS r(draw_id))
SELECT variant, draw_id, start, string_agg(cur, ' ' ORDER BY pos) FILTER (pos < start + 128) AS x, string_agg(cur, ' ' ORDER BY pos) FILTER (pos > start) AS y
FROM drawn JOIN stream USING (variant) WHERE pos BETWEEN start AND start + 128 GROUP BY variant, draw_id, start""",
        "token_blocks": f"""{stream},
stream AS (SELECT variant, "offset" + i - 1 AS pos, ts[i] AS cur FROM (SELECT variant, "offset", ts, unnest(range(1, len(ts) + 1)) AS i FROM placed)),
two AS (SELECT variant, pos // 128 AS block_id, pos, cur FROM stream UNION ALL SELECT variant, pos // 128 - 1, pos, cur FROM stream WHERE pos % 128 = 0 AND pos > 0)
SELECT variant, block_id, string_agg(cur, ' ' ORDER BY pos) FILTER (pos < (block_id + 1) * 128) AS x, string_agg(cur, ' ' ORDER BY pos) FILTER (pos > block_id * 128) AS y
FROM two GROUP BY variant, block_id HAVING count(*) = 129""",
        "unicode_words": f"""WITH {UNICODE_WORDS}
SELECT doc_id, coalesce(n, 0)::INTEGER AS n_words, md5(coalesce(ws, '')) AS words_md5
FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY pos) AS ws FROM u_word GROUP BY doc_id) USING (doc_id)""",
        "gopher_unicode": f"WITH {UNICODE_WORDS},{gopher_ctes(cut='u_word')} SELECT doc_id, n_words, mean_word_length, gopher_reason FROM gopher",
        "sentence_words": f"WITH {SENTENCE_WORDS} SELECT type, n, k AS n_dotted, round(score, 6) + 0.0 AS score FROM s_scored",
        "sentence_counts": f"""WITH {c4_ctes()},{SENTENCE_WORDS},{SENTENCE_MODEL}
SELECT doc_id, (n_sentences - coalesce(held, 0))::INTEGER AS n_sentences,
       CASE WHEN c4_reason IN ('curly_bracket', 'lorem_ipsum') THEN c4_reason WHEN n_sentences - coalesce(held, 0) < 5 THEN 'too_few_sentences' END AS c4_reason
FROM c4 LEFT JOIN s_held USING (doc_id)""",
        "mix_curve": f"{loss} SELECT * FROM curve",
        "report_funnel": f"""{clean_dup},
n AS (SELECT (SELECT count(*) FROM documents) AS raw, (SELECT count(*) FROM i_clean) AS clean, (SELECT count(*) FROM d_kept) AS deduped)
SELECT 1 AS stage_order, 'raw' AS stage, raw AS docs, NULL::DOUBLE AS dropped_pct FROM n
UNION ALL SELECT 2, 'clean', clean, round((raw - clean) / raw::DOUBLE * 100, 2) FROM n
UNION ALL SELECT 3, 'deduped', deduped, round((clean - deduped) / clean::DOUBLE * 100, 2) FROM n
UNION ALL SELECT 4, 'scored', deduped, NULL FROM n UNION ALL SELECT 5, 'shard_rows', deduped, NULL FROM n""",
        "report_anomaly": f"{shards}, {Z_SCORES} SELECT shard, CASE WHEN len({FLAGS}) > 0 THEN 'ANOMALY' ELSE 'OK' END AS status, {', '.join(f'round({m}_z, 2) AS {m}_z' for m in METRICS)} FROM z",
        "report_loss": f"""{loss},
last AS (SELECT {ORDER}, * FROM curve WHERE step = {STEPS} AND shared_eval_loss IS NOT NULL)
SELECT variant_order, variant, 'own val_loss' AS measure, val_loss AS loss FROM last
UNION ALL SELECT variant_order, variant, 'shared eval_loss', shared_eval_loss FROM last""",
        "report_mix": f"""{loss} SELECT {ORDER}, variant, n_docs AS docs, n_tokens_total AS tokens, round(train_loss, 4) AS train_loss,
round(val_loss, 4) AS own_val_loss, round(shared_eval_loss, 4) AS shared_eval_loss, round(shared_raw_loss, 4) AS shared_raw_loss
FROM curve JOIN size USING (variant) WHERE step = {STEPS}""",
    }

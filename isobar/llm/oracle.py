"""DuckDB statements with the answers of the queries that SQL can express."""

from .rules import RULES, STOP_WORDS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

TOP_K = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS p FROM d WHERE len(w) >= 20),
hits AS (
  SELECT doc_id, p FROM starts
  QUALIFY row_number() OVER (PARTITION BY array_to_string(w[p:p + 19], ' ') ORDER BY doc_id, p) > 1
),
covered AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS p FROM hits),
gone AS (SELECT doc_id, list(p) AS ps FROM covered GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t FROM word LEFT JOIN covered USING (doc_id, p)
  WHERE covered.doc_id IS NULL GROUP BY word.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _rules() -> str:
    tests = []
    for r in RULES:
        parts = [f"{r.top} >= {r.least!r} * {r.bottom}"] if r.least is not None else []
        parts += [f"{r.top} <= {r.most!r} * {r.bottom}"] if r.most is not None else []
        tests.append(f"({r.bottom} = 0 OR ({' AND '.join(parts)}))")
    stops = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS for w in line.split()}))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
l AS (
  SELECT *, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines,
    CASE WHEN len(w) < 3 THEN [] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in generate_series(1, len(w) - 2)] END AS g
  FROM d
),
g AS (SELECT doc_id, unnest(g) AS g, unnest(generate_series(1, len(g))) AS p FROM l),
twice AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY doc_id),
m AS (
  SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) for x in w]), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len([x for x in w if lower(x) IN ({stops})]) AS n_stop_words,
    CAST(length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')) AS BIGINT) AS n_upper,
    CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclaims
  FROM l LEFT JOIN repeated USING (doc_id)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(tests)} AS kept FROM b
"""


NEAR = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
    ELSE [w[i] || ' ' || w[i + 1] for i in generate_series(1, len(w) - 1)] END)) AS s FROM d
),
class AS (SELECT min(doc_id) AS c, s.s, len(s.s) AS n FROM s WHERE len(s.s) > 0 GROUP BY s.s),
x AS (SELECT c, n, unnest(s) AS x FROM class),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM x a JOIN x b ON a.x = b.x AND a.c < b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs UNION SELECT c, c FROM class),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
found AS (SELECT a AS c, min(b) AS component FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(component, s.doc_id) AS component_id, s.doc_id = coalesce(component, s.doc_id) AS kept
FROM s LEFT JOIN class ON class.s = s.s LEFT JOIN found USING (c)
"""

SEARCH = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS row FROM documents
),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
s AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
m AS (SELECT row, doc_id, 100 - 50 + ((50 * CAST(len(w) AS BIGINT) * n_docs) // n_terms) AS m FROM d, s WHERE len(w) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY row, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, s GROUP BY term
),
added AS (SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS x FROM tf JOIN m USING (row) JOIN weight USING (term)),
scored AS (
  SELECT item_id, doc_id, CAST(sum(x) AS BIGINT) AS score FROM added JOIN q USING (term) JOIN m USING (row) GROUP BY item_id, row, doc_id
)
SELECT * FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
) WHERE rank <= 50
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size),
f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size > 1),
cuts AS (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c),
scores AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, CAST((2000000 * a::HUGEINT) // (x.f + y.f) AS BIGINT) AS score FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, a, m, unnest(generate_series(1, size - m + 1)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < size)
),
covering AS (SELECT lang, phrase, max(a) AS longer FROM sub GROUP BY lang, phrase),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM best LEFT JOIN covering USING (lang, phrase) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op11_ranked_search": SEARCH,
    "op13_collocations": PHRASES,
    "op2_top_k": TOP_K,
    "op3_substring_dedup": SUBSTRINGS,
    "op4_quality_rules": _rules(),
    "op6_near_duplicates": NEAR,
}

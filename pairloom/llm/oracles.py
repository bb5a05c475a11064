"""SQL that gives the rows of the queries that SQL can express.

The others are compared with plain Python in the tests: hashes, classifiers and dynamic programs.
"""

from __future__ import annotations

import math

from pairloom.llm.license_scan import BASE_PHRASES, TEMPLATES
from pairloom.llm.url_filter import LONG_SUFFIXES, RULES

_LOWER = """translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _licenses() -> str:
    """Blocks of 64 words at every 32nd against each template, in full."""
    templates = []
    for label, text in TEMPLATES:
        words = sorted({w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()})
        templates.append(f"('{label}', [{_quoted(words)}], {math.ceil(0.8 * len(words) - 1e-9)})")
    phrases = []
    for phrase, label in BASE_PHRASES:
        words = phrase.split()
        there = " AND ".join(f"words[pos + {k}] = '{word}'" for k, word in enumerate(words, 1))
        phrases.append(f"SELECT row, pos, '{label}' AS label FROM places WHERE {there}")
    return f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row,
    regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
places AS (SELECT row, words, unnest(range(0, len(words))) AS pos FROM docs),
base AS ({" UNION ALL ".join(phrases)}),
templates(label, wanted, need) AS (VALUES {", ".join(templates)}),
blocks AS (SELECT row, list_distinct(words[pos + 1:pos + 64]) AS held FROM places WHERE pos % 32 = 0),
matches AS (
  SELECT row, label, len(list_intersect(wanted, held)) / len(wanted) AS share
  FROM blocks, templates WHERE len(list_intersect(wanted, held)) >= need),
by_base AS (
  SELECT row, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY 1),
by_all AS (
  SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share
  FROM (SELECT row, label, share FROM matches UNION ALL SELECT row, label, 1.0 FROM base) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(share, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN by_base USING (row) LEFT JOIN by_all USING (row)
"""


_WARC = """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM bodies),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM digests WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests LEFT JOIN firsts USING (payload_digest)
"""

_NEAREST = """
WITH numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL),
parts AS (SELECT row, unnest(embedding) AS x FROM numbered),
usable AS (
  SELECT row FROM parts GROUP BY 1 HAVING bool_and(x IS NOT NULL AND isfinite(x)) AND bool_or(x <> 0)),
vectors AS (SELECT row, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM numbered JOIN usable USING (row)),
scores AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.row <> c.row),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_EXACT = f"""
WITH rows AS (SELECT doc_id, {_LOWER.format("text")} AS content FROM documents),
groups AS (SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(content) AS text_sha256
FROM rows JOIN groups USING (content)
"""

_NEAR = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(0, greatest(1, len(words) - 3))) AS pos FROM docs WHERE len(words) > 0),
sets AS (SELECT DISTINCT doc_id, words[pos + 1:pos + 4] AS shingle FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1),
degrees AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM docs JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id) LEFT JOIN degrees USING (doc_id)
"""

_MOMENTS = """least(0.999, greatest(0.001, sum((x - n * m) * (x - n * m) - n * (m * (1 - m))) / sum(n * (n - 1) * (m * (1 - m)))))"""


def _level(name: str, groups: str) -> str:
    """A level of host reputation: its groups with prior mean m become groups with a posterior mean."""
    return f"""
{name}_in AS ({groups}),
{name}_rho AS (SELECT CASE WHEN sum(n * (n - 1) * (m * (1 - m))) > 0 THEN {_MOMENTS} ELSE 0.5 END AS rho FROM {name}_in),
{name} AS (
  SELECT *, (1 - rho) / rho AS strength, (x + (1 - rho) / rho * m) / (n + (1 - rho) / rho) AS posterior
  FROM {name}_in, {name}_rho)"""


def _urls() -> str:
    rules = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)
    long = _quoted(LONG_SUFFIXES)
    return f"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS row,
    {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES {rules}),
fits AS (
  SELECT row, verdict, rule_host || rule_path AS rule,
    row_number() OVER (PARTITION BY row ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path, verdict) AS k
  FROM parts, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
ruled AS (SELECT p.*, rule, verdict AS given FROM parts p LEFT JOIN fits f ON f.row = p.row AND k = 1),
counts AS (
  SELECT host, string_split(host, '.') AS l, CAST(count(given) AS DOUBLE) AS n, CAST(count(*) FILTER (given = 'block') AS DOUBLE) AS x
  FROM ruled GROUP BY 1),
hosts AS (
  SELECT host, n, x, CASE WHEN array_to_string(l[-2:], '.') IN ({long}) THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix,
    CASE WHEN array_to_string(l[-2:], '.') IN ({long}) THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain
  FROM counts),
everything AS (SELECT (sum(x) + 0.5) / (sum(n) + 1) AS m FROM hosts),
{_level("suffixes", "SELECT suffix, sum(n) AS n, sum(x) AS x, any_value(m) AS m FROM hosts, everything GROUP BY 1")},
{_level("domains", "SELECT h.suffix, domain, sum(h.n) AS n, sum(h.x) AS x, any_value(s.posterior) AS m FROM hosts h JOIN suffixes s USING (suffix) GROUP BY 1, 2")},
{_level("judged", "SELECT host, h.n, h.x, d.posterior AS m FROM hosts h JOIN domains d USING (suffix, domain)")},
bounds AS (
  SELECT host, n, posterior, posterior - 1.645 * sqrt(posterior * (1 - posterior) / (n + strength + 1)) AS bound FROM judged)
SELECT page_id, r.host, path, rule,
  coalesce(given, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(n AS BIGINT) AS n_labelled, round(posterior, 6) AS bad_rate, round(bound, 6) AS bound
FROM ruled r JOIN bounds USING (host)
"""


_RANKED = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row,
    regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
facts AS (SELECT count(*) AS nd, sum(len(terms)) AS nl FROM docs WHERE len(terms) > 0),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark),
places AS (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs),
held AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM places
  WHERE term IN (SELECT term FROM wanted) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM held, facts GROUP BY term, nd),
impacts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nl))) AS impact
  FROM held JOIN weights USING (term), facts),
scores AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM wanted JOIN impacts USING (term) GROUP BY item_id, row),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

_COLLOCATIONS = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM texts),
places AS (SELECT lang, words, unnest(range(0, len(words))) AS pos FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(words[pos + 1:pos + k], ' ') AS phrase
  FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE pos + k <= len(words)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY 1, 2, 3),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY 1),
candidates AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 100),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
  FROM candidates, (SELECT unnest(range(1, 5)) AS j) WHERE j < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, j,
    CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = head JOIN counts y ON y.lang = c.lang AND y.phrase = tail
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM scored),
covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN candidates b
  ON b.lang = s.lang AND b.k > s.k AND 100 * b.f >= 100 * s.f AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
ranked AS (
  SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r,
    CAST(n AS BIGINT) AS n, score
  FROM best ANTI JOIN covered USING (lang, phrase) WHERE place = 1)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_license_scan": _licenses(),
    "op5_warc": _WARC,
    "op6_vector_join": _NEAREST,
    "op9_exact_dedup": _EXACT,
    "op10_ngram_join": _NEAR,
    "op11_collocations": _COLLOCATIONS,
    "op12_ranked_search": _RANKED,
    "op13_url_filter": _urls(),
}

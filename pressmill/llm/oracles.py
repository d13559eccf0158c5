"""SQL for DuckDB with the rows of the registered queries that SQL can express."""
from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


ORACLES = {
    "op1_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM p),
lengths AS (SELECT DISTINCT n FROM phrases),
places AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM
  (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
met AS (SELECT r, item_id, places.n AS n, i FROM places JOIN phrases USING (n, phrase)),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM met) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM
  (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)""",
    "op4_exact_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
  row_number() OVER w = 1 AS kept, s AS text_sha256
FROM d WINDOW w AS (PARTITION BY s ORDER BY doc_id NULLS LAST, r)""",
    "op10_line_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM d),
k AS (SELECT r, i, line, {lowered(r"trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM x),
bad AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*) AS n_lines, count(bad.key) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE bad.key IS NULL), '') AS text
  FROM k LEFT JOIN bad ON k.key = bad.key GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM d JOIN kept USING (r)""",
}


def _either_case(pattern: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


def _secrets() -> str:
    """The spans by splitting at each pattern; owners are counted over the values themselves."""
    assign = "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = ((1, "assign", assign, 2, 8), (2, "access", "AKIA[A-Z0-9]{12,}", 0, 16), (3, "hex", "[0-9a-f]{32,}", 0, 32))
    parts = " UNION ALL ".join(
        f"SELECT r, o, {rank} AS rank, '{kind}' AS kind, {least} AS least, list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) AS gaps,"
        f" regexp_extract_all(t, '{p}') AS whole, regexp_extract_all(t, '{p}', {group}) AS vals FROM d" for rank, kind, p, group, least in kinds)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS o FROM documents),
p AS ({parts}),
x AS (SELECT r, o, rank, kind, least, whole, vals, gaps, unnest(range(1, len(whole) + 1)) AS i FROM p WHERE len(whole) > 0),
m AS (SELECT r, o, rank, kind, vals[i] AS val, least, whole[i] AS hit, sum(gaps[i] + length(whole[i])) OVER (PARTITION BY r, rank ORDER BY i) AS stop FROM x),
base AS (SELECT r, o, rank, kind, val, CAST(stop - length(hit) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM m WHERE length(val) >= least),
owners AS (SELECT val, count(DISTINCT o) AS n, length(val) >= 16 AND regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]')
  AND len(list_filter(range(1, length(val) - 4), lambda i: substring(val, i, 6) = repeat(substring(val, i, 1), 6))) = 0 AS made FROM base GROUP BY val),
judged AS (SELECT DISTINCT r, CASE WHEN n > 2 OR NOT made THEN 4 ELSE 5 END AS rank, stop - length(val) AS start, stop FROM base JOIN owners USING (val)),
s AS (SELECT r, rank, kind, start, stop FROM base UNION ALL SELECT r, rank, CASE rank WHEN 4 THEN 'example' ELSE 'live' END, start, stop FROM judged),
g AS (SELECT r, count(*) FILTER (rank = 1) AS n_assign, count(*) FILTER (rank = 2) AS n_access, count(*) FILTER (rank = 3) AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (rank <= 3) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)"""


def _licenses() -> str:
    """Votes of word 4-grams themselves instead of their hashes."""
    from pressmill.llm.licenses import PHRASES, TEMPLATES

    split = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES)
    templates = ", ".join("({}, '{}', '{}')".format(n, label, text.replace("'", "''")) for n, (label, text) in enumerate(TEMPLATES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {split.format(lowered("coalesce(text, '')"))} AS w FROM documents),
phrases(phrase, label, n) AS (VALUES {phrases}),
pairs AS (SELECT r, i - 1 AS pos, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM
  (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM pairs JOIN phrases USING (phrase) GROUP BY r),
raw_templates(template, label, body) AS (VALUES {templates}),
t AS (SELECT template, label, {split.format(lowered("body"))} AS w FROM raw_templates),
tg AS (SELECT template, label, len(w) AS size, i - 1 AS tpos, array_to_string(w[i:i + 3], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - 2)) AS i FROM t)),
dg AS (SELECT r, i - 1 AS pos, array_to_string(w[i:i + 3], ' ') AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)),
votes AS (SELECT r, template, label, size, tpos, pos, pos - tpos AS diagonal FROM dg JOIN tg USING (gram)),
diagonals AS (SELECT r, template, label, size, diagonal, list(DISTINCT tpos) AS places, min(pos) AS start, max(pos) AS last FROM votes GROUP BY ALL),
cut AS (SELECT *, CAST(coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > 3, true) AS INT) AS apart FROM diagonals),
runs AS (SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM cut),
words AS (SELECT r, template, label, size, span, start, last, unnest(places) AS p FROM runs),
merged AS (SELECT r, template, label, size, span, count(DISTINCT x) AS n, min(start) AS a, max(last) + 4 AS b FROM
  (SELECT *, unnest(range(p, p + 4)) AS x FROM words) GROUP BY r, template, label, size, span),
good AS (SELECT r, list(DISTINCT label) AS labels, max(n / size) AS best FROM merged WHERE n / size >= 0.8 AND b - a <= 1.3 * size + 1 GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(good.labels, [])))), ',') AS labels,
  CAST(greatest(coalesce(best, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN good USING (r)"""


ORACLES |= {"op7_secrets": _secrets(), "op8_licenses": _licenses()}

ORACLES["op13_hard_negatives"] = """
WITH t AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.r AS r, b.vec_id AS id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM t a JOIN t b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.id, s.r) AS rank
  FROM p JOIN s USING (anchor) WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

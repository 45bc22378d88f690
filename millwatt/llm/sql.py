"""SQL twins, for DuckDB, of the queries that SQL expresses."""

from __future__ import annotations

from . import linededup, mixing, resampling, urls

_BLANK = r"[\x20\x09-\x0D]+"

MIXING = f"""
WITH items AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS turn
  FROM documents),
sizes AS (SELECT k, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM items GROUP BY k),
weighed AS (
  SELECT k, source_size, 2 * source_size AS cap,
    [{", ".join(map(str, mixing.WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INT] AS weight,
    sum(source_size) OVER () * 150 / 100 AS budget
  FROM sizes),
levels AS (
  SELECT *, row_number() OVER w AS place,
    (budget - (sum(cap) OVER w - cap)) / sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW w AS (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
common AS (SELECT arg_min(level, place) AS level FROM levels WHERE cap >= level * weight),
targets AS (
  SELECT k, source_size, least(cap::DOUBLE, coalesce(common.level * weight, cap::DOUBLE)) AS target FROM levels, common),
ends AS (
  SELECT *, (sum(size) OVER (PARTITION BY k ORDER BY turn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS e FROM items)
SELECT doc_id, size, source_size, target,
  (least(greatest(floor(target)::BIGINT - e + size, 0), size)
   + least(greatest(floor(target)::BIGINT - source_size - e + size, 0), size))::BIGINT AS taken
FROM ends JOIN targets USING (k)
"""


def _rule_case() -> str:
    cases = []
    for _, pattern in sorted(urls.RULES, key=lambda r: -len(r[1])):
        name, slash, rest = pattern.partition("/")
        cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{pattern}'")
    return f"CASE {' '.join(cases)} END"


def _same(what: str) -> str:
    rate = f"(all_{what} / all_pages)"
    return f"abs({what} / pages - {rate}) <= {urls.Z}::DOUBLE * sqrt({rate} * (1 - {rate}) / pages) + 0.5::DOUBLE / pages"


def _wide_levels() -> str:
    out, sums = [], ", ".join(f"sum({c})::DOUBLE AS {{0}}{c}" for c in ("pages", "labelled", "blocked"))
    for d in range(1, urls.DEPTH + 1):
        before = f"t{d - 1}"
        out.append(f"""
children{d} AS (
  SELECT host, g[1:{d - 1}] AS above, g[{d}] AS child, {sums.format("")} FROM {before} WHERE len(g) >= {d} GROUP BY 1, 2, 3),
nodes{d} AS (SELECT host, above, {sums.format("all_")} FROM children{d} GROUP BY 1, 2),
wide{d} AS (
  SELECT host, above, child FROM children{d} JOIN nodes{d} USING (host, above) WHERE {_same("labelled")} AND {_same("blocked")}),
t{d} AS (
  SELECT t.* EXCLUDE (g),
    CASE WHEN w.host IS NOT NULL AND g[{d}] <> '**' THEN list_concat(g[1:{d - 1}], ['*'], g[{d + 1}:]) ELSE g END AS g
  FROM {before} t LEFT JOIN wide{d} w ON t.host = w.host AND len(g) >= {d} AND g[1:{d - 1}] = w.above AND g[{d}] = w.child)""")
    return ",".join(out)


URL_FILTER = f"""
WITH parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ruled AS (SELECT *, {_rule_case()} AS rule FROM parsed),
parts AS (
  SELECT *, CASE rule {" ".join(f"WHEN '{p}' THEN '{v}'" for v, p in urls.RULES)} END AS given,
    list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
      lambda s: CASE WHEN regexp_matches(s, '{urls._VARIABLE}') THEN '*' ELSE s END) AS segments
  FROM ruled),
shaped AS (SELECT *, CASE WHEN len(segments) > {urls.DEPTH} THEN list_concat(segments[1:{urls.DEPTH}], ['**']) ELSE segments END AS shape FROM parts),
t0 AS (
  SELECT host, shape, count(*) AS pages, count(given) AS labelled, count(*) FILTER (given = 'block') AS blocked, shape AS g FROM shaped GROUP BY host, shape),
{_wide_levels()},
named AS (
  SELECT *, '/' || array_to_string(g, '/') AS template, '/' || array_to_string(g[1:greatest(len(g) - 1, 0)], '/') AS parent FROM t{urls.DEPTH}),
leaves AS (SELECT host, parent, template, sum(labelled) AS n, sum(blocked) AS b FROM named GROUP BY ALL),
pooled AS (SELECT host, parent, CASE WHEN sum(n) > 0 THEN sum(b) / sum(n) ELSE 0 END AS rate FROM leaves GROUP BY ALL),
merged AS (
  SELECT l.*, CASE WHEN n = 0 OR abs(b / n - rate) <= {urls.Z} * sqrt(rate * (1 - rate) / n) THEN '~' ELSE template END AS branch
  FROM leaves l JOIN pooled USING (host, parent)),
grouped AS (SELECT host, parent, branch, sum(n) AS group_n, sum(b) AS group_b FROM merged GROUP BY ALL),
across AS (SELECT template, sum(n) AS all_n, sum(b) AS all_b FROM leaves GROUP BY ALL),
overall AS (SELECT CASE WHEN sum(n) > 0 THEN sum(b) / sum(n) ELSE 0 END AS share FROM leaves),
judged AS (
  SELECT host, parent, template,
    round((group_b + {urls.SMOOTHING} * (all_b + {urls.SMOOTHING} * share) / (all_n + {urls.SMOOTHING})) / (group_n + {urls.SMOOTHING}), 9) AS purity
  FROM merged JOIN grouped USING (host, parent, branch) JOIN across USING (template), overall),
verdicts AS (SELECT host, shape, purity FROM named JOIN judged USING (host, parent, template))
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN purity >= {urls.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM shaped LEFT JOIN verdicts USING (host, shape)
"""

LINE_DEDUP = f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM split),
lines AS (
  SELECT doc_id, line_no, list_filter(regexp_split_to_array(line, '{_BLANK}'), lambda w: w <> '') AS words FROM numbered),
long AS (SELECT * FROM lines WHERE len(words) >= {linededup.MIN_WORDS}),
firsts AS (SELECT words, min((doc_id, line_no)) AS first FROM long GROUP BY words),
fuzzy AS (SELECT * FROM firsts WHERE len(words) >= {linededup.FUZZY_WORDS}),
places AS (SELECT words, first, unnest(range(1, len(words) + 1)) AS i FROM fuzzy),
variants AS (SELECT words, first, i, list_concat(words[1:i - 1], words[i + 1:]) AS rest FROM places),
replaced AS (SELECT i, rest, min(first) AS least FROM variants GROUP BY i, rest),
shorter AS (SELECT v.first, f.first AS near FROM variants v JOIN fuzzy f ON v.rest = f.words),
near AS (
  SELECT first, least AS near FROM variants JOIN replaced USING (i, rest)
  UNION ALL SELECT first, near FROM shorter
  UNION ALL SELECT near, first FROM shorter),
stays AS (
  SELECT f.words, least(f.first, coalesce(min(n.near), f.first)) AS least FROM firsts f LEFT JOIN near n USING (first) GROUP BY f.words, f.first),
gone AS (SELECT DISTINCT l.doc_id, l.line_no FROM long l JOIN stays USING (words) WHERE (l.doc_id, l.line_no) > least),
listed AS (SELECT doc_id, count(*) AS n, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) END::BIGINT AS n_lines,
  coalesce(n, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN listed USING (doc_id)
"""

RESAMPLING = f"""
WITH RECURSIVE bits(b, step, c) AS (
  SELECT b, 0, b::BIGINT FROM range(256) AS r(b)
  UNION ALL SELECT b, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY b) AS entries FROM bits WHERE step = 8),
texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, 'd' AS side, text FROM documents
  UNION ALL SELECT NULL, NULL, 'b', text FROM benchmark),
split AS (
  SELECT row_id, doc_id, side,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM texts),
listed AS (
  SELECT row_id, side, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM split),
occurring AS (SELECT row_id, side, unnest(grams) AS gram FROM listed),
per_gram AS (SELECT row_id, side, gram, count(*) AS n FROM occurring GROUP BY ALL),
spelled AS (SELECT gram, hex(encode(gram)) AS digits FROM (SELECT DISTINCT gram FROM per_gram)),
steps(gram, digits, pos, c) AS (
  SELECT gram, digits, 0, 4294967295::BIGINT FROM spelled
  UNION ALL
  SELECT gram, digits, pos + 1,
    xor(c // 256, entries[xor(c % 256, ('0x' || digits[2 * pos + 1:2 * pos + 2])::BIGINT) + 1])
  FROM steps, crc_table WHERE 2 * pos < length(digits)),
buckets AS (SELECT gram, xor(c, 4294967295) % {resampling.BUCKETS} AS bucket FROM steps WHERE 2 * pos = length(digits)),
placed AS (SELECT row_id, side, bucket, sum(n)::BIGINT AS n FROM per_gram JOIN buckets USING (gram) GROUP BY ALL),
counts AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + {resampling.BUCKETS})::DOUBLE)
    / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + {resampling.BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM counts, totals),
weights AS (
  SELECT row_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_id),
scored AS (
  SELECT row_id, doc_id, len(w) >= 20 AS able, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM split LEFT JOIN weights USING (row_id) WHERE side = 'd'),
noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY able) AS n FROM noisy)
SELECT doc_id, n_features, weight, score, (CASE WHEN able AND place <= n * 25 // 100 THEN place END)::BIGINT AS rank FROM ranked
"""

EXACT_DEDUP = f"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_BLANK}', ' ', 'g') AS text FROM documents),
classes AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY text)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256
FROM plain JOIN classes USING (text)
"""

"""DuckDB SQL for the rows of the queries. Each works on whole tables, by the plainest way there is."""

from __future__ import annotations

from pairloom.llm import lines, mixing, secrets, urls
from pairloom.llm.text import SHINGLE, SIMILAR

_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"

OP1 = """
WITH turns AS (SELECT conv_id, list(DISTINCT {'turn': turn, 'role': role, 'text': text}) AS t FROM conversations GROUP BY conv_id),
convs AS (SELECT conv_id, list_sort(t) AS t FROM turns),
lists AS (SELECT conv_id, t, list_transform(t, lambda x: {'role': x.role, 'text': x.text}) AS said FROM convs),
heads AS (SELECT said, count(*) AS n_copies, min(conv_id) AS conv_id FROM lists GROUP BY said),
proper AS (SELECT DISTINCT said[1:n] AS said FROM (SELECT said, unnest(range(1, len(said))) AS n FROM heads))
SELECT conv_id, CAST(len(said) AS INT) AS n_turns, n_copies,
       array_to_string(list_transform(said, lambda x: '<|im_start|>' || coalesce(x.role, 'unknown') || chr(10) || replace(coalesce(x.text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10)), '') AS rendered
FROM heads WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.said = heads.said)
"""


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _op2() -> str:
    lists = []
    for ordinal, r in enumerate(secrets.RULES):
        p = _literal(r.pattern)
        lists.append(
            f"""SELECT doc_id, row, {ordinal} AS ord, '{r.kind}' AS kind, unnest(list_transform(range(1, len(m) + 1),
            lambda i: {{'s': list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'n': length(m[i]), 'size': length(g[i])}})) AS hit
            FROM (SELECT doc_id, row, string_split_regex(text, {p}) AS b, regexp_extract_all(text, {p}) AS m, regexp_extract_all(text, {p}, {r.group}) AS g FROM d WHERE regexp_matches(text, {p}))"""
        )
    least = " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(secrets.RULES))
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(lists)}),
good AS (SELECT row, ord, kind, CAST(hit.s AS BIGINT) AS s, CAST(hit.s + hit.n AS BIGINT) AS e FROM spans WHERE hit.size >= CASE ord {least} END),
named AS (SELECT row, ord, kind, s, kind || ':' || s || ':' || e AS span FROM good),
byrow AS (SELECT row, count_if(kind = 'assign') AS a, count_if(kind = 'access') AS c, count_if(kind = 'hex') AS h,
                 string_agg(span, ',' ORDER BY s, ord) FILTER (ord < 3) AS base, string_agg(span, ',' ORDER BY s, ord) AS spans FROM named GROUP BY row)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN byrow USING (row)
"""


_SHINGLES = f"list_distinct(list_transform(range(1, greatest(len(w) - {SHINGLE - 2}, 1)), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')))"
OP3 = f"""
WITH items AS (SELECT item_id, {_SHINGLES} AS s FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
parts AS (SELECT item_id, len(s) AS q, unnest(s) AS x FROM items),
docs AS (SELECT doc_id, row, unnest({_SHINGLES}) AS x FROM (SELECT doc_id, row_number() OVER () AS row, {_WORDS} AS w FROM documents)),
shared AS (SELECT doc_id, row, item_id, q, count(*) AS n FROM docs JOIN parts USING (x) GROUP BY doc_id, row, item_id, q)
SELECT doc_id, item_id, CAST(max(n) AS INT) AS n_shared, CAST(any_value(q) AS INT) AS n_item, round(max(n) / any_value(q), 6) AS containment
FROM shared WHERE n >= ceil({SIMILAR} * q - 1e-9) GROUP BY doc_id, item_id
"""

_LAST = 2**63 - 1
OP4 = rf"""
WITH d AS (SELECT coalesce(doc_id, {_LAST}) AS doc, doc_id, text, row_number() OVER () AS row FROM documents),
l AS (SELECT doc, row, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM d),
m AS (SELECT *, regexp_replace(trim(line), '\S*[0-9]\S*', '<*>', 'g') AS masked FROM l),
s AS (SELECT *, regexp_split_to_array(masked, '\s+') AS tokens FROM m),
t AS (SELECT *, len(tokens) AS n, len(list_filter(tokens, lambda t: t <> '<*>')) * 2 >= len(tokens) AS prose FROM s),
k AS (SELECT *, CASE WHEN masked <> '' THEN CASE WHEN prose THEN 'p' || masked ELSE 'f' || trim(line) END END AS key, [CAST(n AS VARCHAR)] || tokens[1:{lines.DEPTH}] AS leaf FROM t),
own AS (SELECT key, min(doc) AS first FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT text) >= CASE WHEN any_value(n) < {lines.MIN_TOKENS} THEN {lines.SHORT_DOCS} ELSE {lines.MIN_DOCS} END),
distinct_lines AS (SELECT DISTINCT leaf, n, key, tokens FROM k WHERE n > {lines.DEPTH} AND prose AND key IS NOT NULL),
spots AS (SELECT leaf, n, key, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM distinct_lines),
support AS (SELECT leaf, pos, token, count(*) AS c FROM spots WHERE pos >= {lines.DEPTH} GROUP BY leaf, pos, token HAVING count(*) >= 2),
counted AS (SELECT *, row_number() OVER (PARTITION BY leaf, key ORDER BY c DESC) AS place FROM spots JOIN support USING (leaf, pos, token)),
sized AS (SELECT leaf, key, c AS size FROM counted WHERE place = greatest(ceil(n * {lines.FIXED}::DOUBLE)::INT - {lines.DEPTH}, 1)),
shaped AS (SELECT leaf, key, any_value(size) AS size, list({{'pos': pos, 'token': token}} ORDER BY pos) AS shape FROM counted JOIN sized USING (leaf, key) WHERE c * 2 >= size
           GROUP BY leaf, key HAVING count(*) + {lines.DEPTH} >= any_value(n) * {lines.FIXED}::DOUBLE AND count(*) + {lines.DEPTH} < any_value(n)),
templates AS (SELECT leaf, shape FROM shaped GROUP BY leaf, shape HAVING count(*) >= 2 AND count(*) * 2 >= min(size)),
fits AS (SELECT leaf, shape, key FROM shaped JOIN templates USING (leaf, shape)),
groups AS (SELECT leaf, shape, min(doc) AS first FROM k JOIN fits USING (leaf, key) GROUP BY leaf, shape HAVING count(DISTINCT text) >= {lines.MIN_DOCS}),
gone AS (SELECT key, min(first) AS first FROM (SELECT key, first FROM own UNION ALL SELECT key, first FROM fits JOIN groups USING (leaf, shape)) GROUP BY key),
kept AS (SELECT k.row, count(*) AS n_lines, count(g.key) AS n_dropped, string_agg(k.line, chr(10) ORDER BY k.i) FILTER (g.key IS NULL) AS text
         FROM k LEFT JOIN gone g ON k.key = g.key AND k.doc > g.first GROUP BY k.row)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE n_lines END AS n_lines, n_dropped, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM d JOIN kept USING (row)
"""


def _place(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 10) AS BIGINT)"


OP6 = rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS n_tokens FROM documents WHERE regexp_matches(coalesce(text, ''), '\S')),
sources AS MATERIALIZED (SELECT source, sum(n_tokens)::BIGINT AS total FROM d GROUP BY source),
allof AS MATERIALIZED (SELECT sum(total)::BIGINT AS budget, count(*) AS k FROM sources),
step AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo1, 1.0::DOUBLE AS hi1, 0.0::DOUBLE AS lo2, 1.0::DOUBLE AS hi2
  UNION ALL
  SELECT i + 1, CASE WHEN ok1 THEN m1 ELSE lo1 END, CASE WHEN ok1 THEN hi1 ELSE m1 END, CASE WHEN ok2 THEN m2 ELSE lo2 END, CASE WHEN ok2 THEN hi2 ELSE m2 END
  FROM (SELECT i, lo1, hi1, lo2, hi2, m1, m2,
               (SELECT ln(sum(pow(total / budget, m1))) - m1 * sum(pow(total / budget, m1) * ln(total / budget)) / sum(pow(total / budget, m1)) >= {mixing.EVENNESS} * ln(any_value(k)) FROM sources, allof) AS ok1,
               (SELECT max(pow(total / budget, m2) * budget / total) / sum(pow(total / budget, m2)) > {mixing.REPEATS} FROM sources, allof) AS ok2
        FROM (SELECT *, (lo1 + hi1) / 2 AS m1, (lo2 + hi2) / 2 AS m2 FROM step WHERE i < 45))),
a AS (SELECT ceil(greatest(
   CASE WHEN (SELECT -sum(total / budget * ln(total / budget)) >= {mixing.EVENNESS} * ln(any_value(k)) FROM sources, allof) THEN 1 ELSE hi1 END,
   CASE WHEN (SELECT max(budget / total) / count(*) <= {mixing.REPEATS} FROM sources, allof) THEN 0 ELSE hi2 END) * 1e6 - 1e-6) / 1e6 AS a FROM step WHERE i = 45),
norm AS (SELECT sum(pow(total / budget, a)) AS s FROM sources, allof, a),
plan AS (SELECT source, total, pow(total / budget, a) / s AS weight, floor(pow(total / budget, a) / s * budget + 1e-6)::BIGINT AS due FROM sources, allof, a, norm),
rows AS (SELECT doc_id, d.source, n_tokens, total, weight, due, unnest(range(ceil(due / total)::BIGINT)) AS epoch FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source WHERE due > 0),
keyed AS (SELECT *, {_place("'0'", "epoch::VARCHAR", "coalesce(doc_id::VARCHAR, '')")} AS place FROM rows),
placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY place, doc_id NULLS FIRST, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + epoch * total AS start FROM keyed),
blocks AS (SELECT *, least(floor(start / (due / greatest(ceil(budget / {mixing.BLOCK_TOKENS}), 1)::DOUBLE)), greatest(ceil(budget / {mixing.BLOCK_TOKENS}), 1) - 1)::BIGINT AS block FROM placed, allof WHERE start < due),
mixed AS (SELECT *, {_place("'0b'", "block::VARCHAR", "epoch::VARCHAR", "coalesce(doc_id::VARCHAR, '')")} AS shuffle FROM blocks)
SELECT block, row_number() OVER (PARTITION BY block ORDER BY shuffle, doc_id NULLS FIRST, epoch, n_tokens, source NULLS FIRST) AS position, doc_id, source, epoch, n_tokens, round(weight, 6) AS weight FROM mixed
"""

_HOST = r"coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _bare(url: str) -> str:
    cut = f"regexp_extract({url}, '(?s)^([^#]*)', 1)"
    head = f"regexp_extract({cut}, '(?s)^(.*?://[^/?]*)', 1)"
    return f"translate({head}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || substr({cut}, length({head}) + 1)"


_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)
OP8 = rf"""
WITH RECURSIVE p AS (SELECT page_id, url, html, row_number() OVER () AS row FROM pages),
rules(verdict, h, pth) AS (VALUES {_RULES}),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM p WHERE url IS NOT NULL),
links AS (SELECT url, CASE WHEN regexp_matches(tag, '(?is)^<link\b.*\srel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''>\s]+)', 1)
                           WHEN regexp_matches(tag, '(?is)^<meta\b.*http-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)url\s*=\s*([^"''>\s]+)', 1) END AS t FROM tags),
full_links AS (SELECT url, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || t
                                WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || '/' || t END AS t FROM links WHERE t <> ''),
e AS (SELECT DISTINCT {_bare("url")} AS a, {_bare("t")} AS b FROM full_links),
both_ways AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(v, w) AS (SELECT a, a FROM both_ways UNION SELECT r.v, x.b FROM reach r JOIN both_ways x ON r.w = x.a),
comp AS (SELECT v, min(w) AS c FROM reach GROUP BY v),
urls AS (SELECT url FROM p WHERE url IS NOT NULL UNION SELECT v FROM comp),
parts AS (SELECT url, {_HOST} AS host, {_PATH} AS path FROM urls),
judged AS (SELECT url, h || pth AS rule, verdict FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pth)
           QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(h) + length(pth) DESC, verdict DESC, h DESC) = 1),
passed AS (SELECT c, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' ELSE 'allow' END AS verdict FROM comp LEFT JOIN judged ON judged.url = v GROUP BY c)
SELECT p.page_id, {_HOST.replace("url", "p.url")} AS host, {_PATH.replace("url", "p.url")} AS path, j.rule, coalesce(j.verdict, s.verdict, 'allow') AS verdict
FROM p LEFT JOIN judged j ON j.url = p.url LEFT JOIN comp ON comp.v = {_bare("p.url")} LEFT JOIN passed s ON s.c = comp.c
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS row, {_WORDS} AS w FROM documents),
heads AS (SELECT w, row_number() OVER () AS t, min(doc_id) AS doc, count(*) AS copies FROM d GROUP BY w),
x AS (SELECT t, unnest(CASE WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END) AS s FROM heads WHERE len(w) > 0),
counts AS (SELECT t, s, count(*) AS c FROM x GROUP BY t, s),
sizes AS (SELECT t, sum(c) AS n FROM counts GROUP BY t),
pairs AS (SELECT a.t AS a, b.t AS b, sum(least(a.c, b.c)) AS m FROM counts a JOIN counts b ON a.s = b.s AND a.t < b.t GROUP BY a.t, b.t),
linked AS (SELECT a, b FROM pairs JOIN sizes p ON p.t = a JOIN sizes q ON q.t = b WHERE m >= {SIMILAR} * (p.n + q.n - m) - 1e-9),
both_ways AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach(v, w) AS (SELECT a, a FROM both_ways UNION SELECT r.v, x.b FROM reach r JOIN both_ways x ON r.w = x.a),
comp AS (SELECT v, min(w) AS c FROM reach GROUP BY v),
member AS (SELECT w, doc, copies, coalesce(c, t) AS c FROM heads LEFT JOIN comp ON v = t),
classes AS (SELECT w, min(doc) OVER (PARTITION BY c) AS class_id, sum(copies) OVER (PARTITION BY c) AS class_size FROM member)
SELECT d.doc_id, class_id, class_size::BIGINT AS class_size FROM d JOIN classes USING (w)
"""

ORACLES: dict[str, str] = {
    "op1_chat_formatting": OP1,
    "op2_secret_scan": _op2(),
    "op3_decontamination": OP3,
    "op4_line_dedup": OP4,
    "op6_mixing": OP6,
    "op8_url_filter": OP8,
    "op9_near_dedup": OP9,
}

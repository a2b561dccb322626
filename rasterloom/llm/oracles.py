"""DuckDB SQL that says what some of the queries return. Each is written from the contract, not from the operator."""

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""

OP3 = f"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {AZ}), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
v AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM u),
l AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h0 AS (SELECT name, count(l.doc_id) AS n, coalesce(sum(l.bad), 0) AS bad FROM v LEFT JOIN l ON page_id = doc_id GROUP BY name),
h AS (
  SELECT *, list_reverse(string_split(name, '.')) AS p, name LIKE '[%' OR regexp_full_match(name, '[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}') AS ip,
         CASE WHEN array_to_string(string_split(name, '.')[-2:], '.') IN ('ac.uk','co.jp','co.uk','com.au','com.br','com.cn','co.in','co.kr','co.nz','co.za','gov.uk','org.uk') THEN 2 ELSE 1 END AS k FROM h0),
g AS (SELECT name, n, bad, CASE WHEN ip THEN name ELSE array_to_string(list_reverse(p[1:k + 1]), '.') END AS domain, CASE WHEN ip THEN '[]' ELSE array_to_string(list_reverse(p[1:k]), '.') END AS suffix FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM g GROUP BY suffix),
t AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0.5 END AS m FROM s),
sm AS (SELECT s.*, least(greatest(m, 0.001), 0.999) AS m FROM s, t),
sw AS (SELECT 1 / least(greatest((sum(n * (bad / n - m) ** 2 / (m * (1 - m))) - count(*)) / (sum(n) - count(*)), 0.001), 0.5) - 1 AS w FROM sm WHERE n > 0),
sp AS (SELECT suffix, (m * w + bad) / (w + n) AS rate FROM sm, sw),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM g GROUP BY ALL),
dm AS (SELECT d.*, least(greatest(rate, 0.001), 0.999) AS m FROM d JOIN sp USING (suffix)),
dw AS (SELECT 1 / least(greatest((sum(n * (bad / n - m) ** 2 / (m * (1 - m))) - count(*)) / (sum(n) - count(*)), 0.001), 0.5) - 1 AS w FROM dm WHERE n > 0),
dp AS (SELECT domain, (m * w + bad) / (w + n) AS rate FROM dm, dw),
hm AS (SELECT g.*, least(greatest(rate, 0.001), 0.999) AS m FROM g JOIN dp USING (domain)),
hw AS (SELECT 1 / least(greatest((sum(n * (bad / n - m) ** 2 / (m * (1 - m))) - count(*)) / (sum(n) - count(*)), 0.001), 0.5) - 1 AS w FROM hm WHERE n > 0),
hp AS (SELECT name, n, bad, m * w + bad AS a, w + n - m * w - bad AS b FROM hm, hw),
ab AS (SELECT DISTINCT a, b FROM hp WHERE a / (a + b) > 0.475),
-- P(rate <= 1/2) by the midpoint rule over the angle t of rate = sin(t)^2, 0 to pi / 4
tail AS (SELECT a, b, sum(exp((2 * a - 1) * ln(sin(x)) + (2 * b - 1) * ln(cos(x)) + lgamma(a + b) - lgamma(a) - lgamma(b))) * 2 * pi() / 4 / 4000 AS p
         FROM ab, (SELECT (i + 0.5) * pi() / 4 / 4000 AS x FROM range(4000) r(i)) GROUP BY a, b),
j AS (SELECT name, n, bad, CASE WHEN p < 0.05 THEN 'block' ELSE 'allow' END AS judged FROM hp LEFT JOIN tail USING (a, b)),
rules(rule_host, rule_path, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (
  SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(v, length(rule_host || rule_path)) AS v
  FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(f.v, judged) AS verdict, CAST(n AS BIGINT) AS labelled, CAST(bad AS BIGINT) AS bad
FROM v LEFT JOIN f USING (host, path) JOIN j USING (name)
"""

OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, {AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, {AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bl AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM bl, unnest(range(1, len(w) - k + 2)) AS t(i)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM d, (SELECT DISTINCT k FROM bl) AS sizes, unnest(range(1, len(w) - k + 2)) AS t(i)),
hit AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
least_id AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, p FROM win JOIN least_id USING (s), unnest(range(i, i + 13)) AS t(p) WHERE doc_id > first),
gone_list AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone_list USING (doc_id)
"""

OP10 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, {AZ}), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared_pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared_pairs JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a, min(b) AS least_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(least_id, doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON doc_id = a
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols FROM documents),
win AS (SELECT row_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM d, unnest(range(1, len(w) - 6)) AS t(i)),
twice AS (SELECT row_id, s FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT row_id, count(DISTINCT p) AS n FROM win JOIN twice USING (row_id, s), unnest(range(i, i + 8)) AS t(p) GROUP BY row_id),
m AS (
  SELECT d.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (row_id)),
r AS (
  SELECT row_id, lang, source, unnest([{'m': 1, 'x': word_chars / n_words}, {'m': 2, 'x': n_symbols / n_words}, {'m': 3, 'x': n_dup_lines / n_lines}, {'m': 4, 'x': n_repeat_words / n_words}], recursive := true)
  FROM m WHERE n_words > 0),
b AS (SELECT *, CASE WHEN x > 0 THEN ceil(ln(x) / ln(1.01::DOUBLE / 0.99::DOUBLE)) ELSE -1000000 END AS b FROM r),
-- each bucket once for its source, its language and the corpus
k AS (SELECT 0 AS level, lang, source, m, b FROM b UNION ALL SELECT 1, lang, NULL, m, b FROM b UNION ALL SELECT 2, NULL, NULL, m, b FROM b),
q AS (
  SELECT level, lang, source, m, count(*) AS docs, list_sort(list(b))[CAST(ceil(count(*) * 0.25) AS BIGINT)] AS b1, list_sort(list(b))[CAST(ceil(count(*) * 0.75) AS BIGINT)] AS b3 FROM k GROUP BY ALL HAVING count(*) >= 100),
f AS (
  SELECT *, row_number() OVER (PARTITION BY row_id, m ORDER BY level) AS nth
  FROM (SELECT b.row_id, b.m, b.x, q.level, CASE WHEN b1 = -1000000 THEN 0 ELSE 2 * (1.01::DOUBLE / 0.99::DOUBLE) ** b1 / (1.01::DOUBLE / 0.99::DOUBLE + 1) END AS q1, CASE WHEN b3 = -1000000 THEN 0 ELSE 2 * (1.01::DOUBLE / 0.99::DOUBLE) ** b3 / (1.01::DOUBLE / 0.99::DOUBLE + 1) END AS q3
        FROM b JOIN q ON b.m = q.m AND (q.level = 2 OR b.lang IS NOT DISTINCT FROM q.lang) AND (q.level > 0 OR b.source IS NOT DISTINCT FROM q.source)) s),
outside AS (SELECT DISTINCT row_id FROM f WHERE nth = 1 AND (x > q3 + 3 * greatest(q3 - q1, [0.5, 0.04, 0.15, 0.08][m]) OR m = 1 AND x < q1 - 3 * greatest(q3 - q1, 0.5)))
SELECT doc_id, n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND row_id NOT IN (SELECT row_id FROM outside) AS kept FROM m
"""

OP12 = r"""
WITH own AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, '')) AS w FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 6 AS h FROM own),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(o.w[1:h], []), c.w[h + 1:]) AS w FROM crc c LEFT JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (SELECT conv_id, d, w[1:d] AS p, d = len(w) AS ends, CASE WHEN d > 0 THEN length(w[d].t) ELSE 0 END AS chars FROM rebuilt, unnest(range(len(w) + 1)) AS t(d)),
nodes AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars, coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ids FROM prefixes GROUP BY d, p),
kids AS (SELECT p, count(*) AS n_children FROM (SELECT p[1:d - 1] AS p FROM nodes WHERE d > 0) s GROUP BY p),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (p)),
sums AS (SELECT t.p, sum(CASE WHEN s.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((s.n - 1) * s.chars) AS saved FROM full_nodes t JOIN full_nodes s ON s.d >= t.d AND s.p[1:t.d] = t.p GROUP BY t.p)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ids) AS ends_sha256
FROM full_nodes f JOIN sums USING (p) LEFT JOIN nodes u ON f.d > 0 AND u.d = f.d - 1 AND u.p = f.p[1:f.d - 1]
"""

"""DuckDB SQL for the queries that SQL can express."""

CHAT = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text, (CASE WHEN role IS NULL THEN '0' ELSE '1' || md5(role) END) || (CASE WHEN text IS NULL THEN '0' ELSE '1' || md5(text) END) AS h
           FROM conversations WHERE conv_id IS NOT NULL),
steps AS (SELECT conv_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n_turns, string_agg(h, ',') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p
          FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
whole AS (SELECT p, n_turns, min(conv_id) AS conv_id, count(*) AS n_equal FROM steps WHERE place = n_turns GROUP BY p, n_turns),
kept AS (SELECT * FROM whole WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE s.p = whole.p AND s.place < s.n_turns))
SELECT conv_id, n_turns, n_equal, string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS text
FROM kept JOIN t USING (conv_id) GROUP BY conv_id, n_turns, n_equal
"""

MIXING = r"""
WITH d AS (SELECT doc_id, source, source IS NULL AS no_source, coalesce(source, '') AS src, md5(coalesce(text, '')) AS tie,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS o FROM documents),
s AS (SELECT no_source, src, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
p AS (SELECT *, row_number() OVER (ORDER BY no_source, src) AS place FROM s),
w AS (SELECT *, [1, 2, 3][((place - 1) % 3 + 1)::INT] AS weight FROM p),
g AS (SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER e, 0) AS remaining, sum(weight) OVER () - coalesce(sum(weight) OVER e, 0) AS rest
      FROM w WINDOW e AS (ORDER BY source_size * 6 / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 3 * source_size::HUGEINT * rest <= weight * remaining AS stops FROM g),
t AS (SELECT *, CASE WHEN stops THEN (3 * source_size)::DOUBLE ELSE weight * (max(CASE WHEN NOT stops THEN {'a': rest, 'l': remaining::DOUBLE / rest} END) OVER ()).l END AS target FROM f),
q AS (SELECT d.*, source_size, place, target, sum(size) OVER (PARTITION BY no_source, src ORDER BY o, size, tie ROWS UNBOUNDED PRECEDING)::BIGINT AS so_far FROM d JOIN t USING (no_source, src)),
due AS (SELECT doc_id, o, size, tie, place, so_far, turn, (turn * source_size + so_far)::DOUBLE / target AS finish FROM q, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0),
filled AS (SELECT *, sum(size) OVER (ORDER BY finish, place, o, so_far, turn ROWS UNBOUNDED PRECEDING) AS filled FROM due),
took AS (SELECT doc_id, o, place, so_far, sum(CASE WHEN filled <= (SELECT sum(size) FROM d) THEN size ELSE 0 END)::BIGINT AS taken FROM filled GROUP BY ALL)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(took.taken, 0) AS taken FROM q LEFT JOIN took ON q.o = took.o AND q.place = took.place AND q.so_far = took.so_far AND q.size > 0
"""

URLS = r"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
base AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
worst AS (SELECT doc_id AS page_id, max(greatest(CASE WHEN quality = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END, CASE WHEN toxic = 1 THEN 1 WHEN toxic IS NOT NULL THEN 0 END)) AS bad FROM labels
          WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1),
hosts AS (SELECT host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, string_split(host, '.') AS l FROM base JOIN worst USING (page_id) WHERE host <> '' GROUP BY host),
cut AS (SELECT host, n, bad, l, CASE WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS deep FROM hosts),
named AS (SELECT host, n, bad, array_to_string(l[greatest(1, len(l) - deep + 1):], '.') AS suffix, array_to_string(l[greatest(1, len(l) - deep):], '.') AS domain FROM cut),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY ALL),
m0 AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS m FROM domains),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM domains, m0 GROUP BY suffix),
k1 AS (SELECT coalesce(greatest(1, least(1000, 1 / greatest(sum(n * pow(bad / n - m, 2) - m * (1 - m)) / nullif(sum(m * (1 - m) * (n - 1)), 0), 1e-9) - 1)), 1000) AS k FROM s),
s1 AS (SELECT suffix, (bad + k * m) / (n + k) AS m FROM s, k1),
d AS (SELECT domain, n, bad, m FROM domains JOIN s1 USING (suffix)),
k2 AS (SELECT coalesce(greatest(1, least(1000, 1 / greatest(sum(n * pow(bad / n - m, 2) - m * (1 - m)) / nullif(sum(m * (1 - m) * (n - 1)), 0), 1e-9) - 1)), 1000) AS k FROM d),
d1 AS (SELECT domain, (bad + k * m) / (n + k) AS m FROM d, k2),
h AS (SELECT host, named.n, named.bad, m FROM named JOIN d1 USING (domain)),
k3 AS (SELECT coalesce(greatest(1, least(1000, 1 / greatest(sum(n * pow(bad / n - m, 2) - m * (1 - m)) / nullif(sum(m * (1 - m) * (n - 1)), 0), 1e-9) - 1)), 1000) AS k FROM h),
h1 AS (SELECT host, n, k, (bad + k * m) / (n + k) AS m FROM h, k3),
low AS (SELECT host, n, m - 1.6449 * sqrt(m * (1 - m) / (n + k + 1)) AS lower FROM h1),
r AS (SELECT page_id, host, path, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM base)
SELECT page_id, r.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN low.lower > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       coalesce(low.n, 0)::BIGINT AS n_labelled FROM r LEFT JOIN low ON r.host = low.host
"""

LINES = r"""
WITH d AS (SELECT coalesce(doc_id, 9223372036854775807) AS k, doc_id, text, row_number() OVER () AS r FROM documents),
l AS (SELECT r, k, doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text IS NOT NULL),
w AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY i) AS pos FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
v AS (SELECT r, k, text, pos, [line, lead(line) OVER o, lead(line, 2) OVER o] AS win, lead(pos, 2) OVER o AS far FROM w WINDOW o AS (PARTITION BY r ORDER BY pos)),
f AS (SELECT win, min({'k': k, 't': md5(text), 'a': pos}) AS first FROM v WHERE far IS NOT NULL GROUP BY win),
late AS (SELECT v.r, v.pos FROM v JOIN f ON v.win = f.win WHERE v.far IS NOT NULL AND {'k': v.k, 't': md5(v.text), 'a': v.pos} > f.first),
gone AS (SELECT DISTINCT r, pos + x AS pos FROM late, (SELECT unnest([0, 1, 2]) AS x)),
lost AS (SELECT w.r, w.i FROM w JOIN gone USING (r, pos)),
kept AS (SELECT l.r, string_agg(line, chr(10) ORDER BY l.i) AS text FROM l LEFT JOIN lost ON l.r = lost.r AND l.i = lost.i WHERE lost.r IS NULL GROUP BY l.r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_lines_removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_VALUES = _ASSIGN.replace("=-]+", "=-]{6,}")
_ACCESS, _HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
_FOUND = "SELECT r, {rank} AS rank, regexp_extract_all(t, '{pattern}', 0) AS f, string_split_regex(t, '{pattern}') AS g FROM d"

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_FOUND.format(rank=0, pattern=_ASSIGN)} UNION ALL {_FOUND.format(rank=1, pattern=_ACCESS)} UNION ALL {_FOUND.format(rank=2, pattern=_HEX)} UNION ALL {_FOUND.format(rank=3, pattern="[A-Za-z0-9+/_=-]{16,}")}),
e AS (SELECT r, rank, f, g, unnest(generate_series(1, len(f))) AS i FROM m WHERE len(f) > 0),
a AS (SELECT r, rank, f[i] AS v, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0) AS s FROM e),
b AS (SELECT r, rank, v, s::BIGINT AS s, (s + length(v))::BIGINT AS e FROM a WHERE rank > 0 OR length(regexp_extract(v, '{_ASSIGN}', 2)) >= 6),
samples AS (SELECT true AS secret, unnest(list_concat(list_concat(regexp_extract_all(t, '{_VALUES}', 2), regexp_extract_all(t, '{_ACCESS}', 0)), regexp_extract_all(t, '{_HEX}', 0))) AS token FROM d
            UNION ALL SELECT false, unnest(regexp_extract_all(regexp_replace(t, '{_VALUES}|{_ACCESS}|{_HEX}', ' ', 'g'), '[A-Za-z0-9+/_=-]{{8,}}', 0)) FROM d),
syms AS (SELECT secret, list_filter(list_transform(string_split(token, ''), lambda c: instr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-', c)), lambda x: x > 0) AS q FROM samples),
seen AS (SELECT secret, unnest(list_transform(q, lambda c, i: (CASE WHEN i = 1 THEN 0 ELSE q[i-1] END) * 67 + c - 1)) AS cell FROM syms),
filled AS (SELECT cell, cell // 67 AS before, count(*) FILTER (WHERE seen.secret) AS n_r, count(*) FILTER (WHERE NOT seen.secret) AS n_o FROM (SELECT unnest(range(68 * 67)) AS cell) LEFT JOIN seen USING (cell) GROUP BY ALL),
odds AS (SELECT cell, floor(ln(((n_r + 1.0::DOUBLE) / (sum(n_r) OVER w + 67.0::DOUBLE)) / ((n_o + 1.0::DOUBLE) / (sum(n_o) OVER w + 67.0::DOUBLE))) * 1000000 + 0.5)::BIGINT AS o FROM filled WINDOW w AS (PARTITION BY before)),
runs AS (SELECT r, v, s, e, list_transform(string_split(v, ''), lambda c: instr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-', c)) AS q FROM b WHERE rank = 3),
steps AS (SELECT r, s, e, unnest(list_transform(q, lambda c, i: (CASE WHEN i = 1 THEN 0 ELSE q[i-1] END) * 67 + c - 1)) AS cell FROM runs),
added AS (SELECT r, 3 AS rank, s, e FROM steps JOIN odds USING (cell) GROUP BY ALL HAVING sum(o) >= 10000000),
spans AS (SELECT r, rank, s, e FROM b WHERE rank < 3 UNION ALL SELECT r, rank, s, e FROM added x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.rank < 3 AND b.r = x.r AND b.s <= x.s AND b.e >= x.e)),
k AS (SELECT r, rank, s, e, ['assign', 'access', 'hex', 'markov'][rank + 1] || ':' || s || ':' || e AS w FROM spans),
o AS (SELECT r, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex, count(*) FILTER (WHERE rank = 3) AS n_markov,
             string_agg(w, ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base, string_agg(w, ',' ORDER BY s, rank) AS spans FROM k GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_markov, 0) AS n_markov, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (r)
"""

PHRASES = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
starts AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w WHERE len(ws) > 0),
g AS (SELECT lang, m, ws[i:i+m-1] AS words, count(*) AS f FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(ws) GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, words, f, ' ' || array_to_string(words, ' ') || ' ' AS s FROM g WHERE f >= 100),
kept AS (SELECT * FROM c WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM c x WHERE x.lang = c.lang AND x.m > c.m AND 100 * x.f >= 100 * c.f AND contains(x.s, c.s))),
cut AS (SELECT kept.lang, kept.s, kept.f AS a, k, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * kept.f * n.n) // (l.f::HUGEINT * r.f) AS score
        FROM kept, (SELECT unnest([1, 2, 3, 4]) AS k), c l, c r, n WHERE k < kept.m AND l.lang = kept.lang AND r.lang = kept.lang AND n.lang = kept.lang AND l.words = kept.words[1:k] AND r.words = kept.words[k+1:]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM best)
SELECT lang, rank, trim(s, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

ORACLES = {"op3_chat": CHAT, "op7_mixing": MIXING, "op8_urls": URLS, "op9_lines": LINES, "op11_secrets": SECRETS, "op12_phrases": PHRASES}

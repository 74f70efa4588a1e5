"""DuckDB SQL of the operator queries, where SQL can express them."""

from __future__ import annotations

from pitchlake.llm.decontaminate import MIN_COVERED, MIN_ITEM, MIN_LITERAL, RULES, WINDOW
from pitchlake.llm.line_dedup import MIN_WORDS
from pitchlake.llm.mixing import MAX_USES, SHARE, WEIGHTS
from pitchlake.llm import filter_audit as audit
from pitchlake.llm import quality_rules as rules
from pitchlake.llm.queries import N_SHARDS
from pitchlake.llm.sharding import even_tree
from pitchlake.llm.url_filter import URL
from pitchlake.llm.url_lists import FIRST_DAY, LISTS

ORACLE: dict[str, str] = {}

#: Table of crc32 (reflected polynomial 0xEDB88320), one row with a list of 256.
CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def crc32(text: str) -> str:
    """Unsigned crc32 of a text (needs ``crc_table`` in FROM)."""
    by = f"list_transform(regexp_extract_all(hex(encode(coalesce({text}, ''))), '..'), lambda x: ('0x' || x)::BIGINT)"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {by}), "
            "lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)")


def _nearest(n: int) -> str:
    """Shard with the earliest clock; all weights are 1, so it has the largest draw."""
    leaves = sorted(even_tree(n), key=lambda x: (x.region, x.rack, x.shard))
    return ("(list_sort(list_transform([" + ", ".join(str(x.shard) for x in leaves) + "]::INT[], lambda s: "
            "{'t': -ln((('0x' || substr(md5(s || '/' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)"
            f" / {float(1 << 52)}), 's': s}}))[1]).s")


ORACLE["op7_sharding"] = f"""
WITH {CRC_TABLE}, placed AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {crc32('text')} AS text_crc32,
         {_nearest(N_SHARDS)} AS shard, {_nearest(N_SHARDS + 1)} AS grown_shard
  FROM documents, crc_table)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM placed"""

#: Words of a text (null: none).
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op9_mixing"] = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5('mix/' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{', '.join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}) + 1] AS w
  FROM d GROUP BY source),
-- the targets that stop are those with the least of cap / weight: rate if the first k stop
r AS (
  SELECT *, {MAX_USES} * source_size AS cap, row_number() OVER (ORDER BY {MAX_USES} * source_size / w::DOUBLE, source) AS k FROM s),
f AS (
  SELECT *, (SELECT sum(source_size) FROM s) * {SHARE}::DOUBLE AS total,
         coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
  FROM r),
g AS (SELECT min(k) AS k FROM f WHERE w * ((total - capped) / left_w) <= cap),
x AS (SELECT (total - capped) / left_w AS rate, k FROM f WHERE k = (SELECT k FROM g)),
t AS (
  SELECT f.source, source_size, (CASE WHEN f.k < x.k THEN cap ELSE w * rate END)::DOUBLE AS target FROM f, x),
u AS (
  SELECT source, source_size, target, floor(target)::BIGINT AS used,
         CASE WHEN source_size = 0 THEN 0 ELSE floor(target)::BIGINT // source_size END AS whole
  FROM t),
o AS (
  SELECT d.*, u.source_size, u.target, u.used, u.whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.size ROWS UNBOUNDED PRECEDING) AS run
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM (
  SELECT *, least(whole + (2 * run - size <= 2 * (used - whole * source_size))::INT, {MAX_USES})::BIGINT AS copies FROM o)"""


def _canonical(raw: str) -> str:
    text = f"array_to_string({raw}, ' ')"
    for pattern, new in RULES:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return f"string_split(lower({text}), ' ')"


_VALUE = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
_WINDOW_TEXT = "array_to_string(canon[{p} + 1 : {p} + {n}], ' ')"

ORACLE["op5_decontamination"] = f"""
WITH it AS (
  SELECT item_id, raw, {_canonical('raw')} AS canon, len(raw) AS n_item, least(len(raw), {WINDOW}) AS n
  FROM (SELECT item_id, {WORDS} AS raw FROM benchmark) WHERE len(raw) >= {MIN_ITEM}),
iw AS (
  SELECT item_id, raw, n, n_item, pos, canon[pos + 1 : pos + n] AS w
  FROM (SELECT *, unnest(range(0, n_item - n + 1)) AS pos FROM it)),
iw2 AS (
  SELECT item_id, n, n_item, pos, n || ' ' || array_to_string(w, ' ') AS key,
         list_transform(list_filter(range(0, n), lambda j: contains(w[j + 1], '\u0002')),
                        lambda j: {{'at': pos + j, 'item': {_VALUE.format('raw[pos + j + 1]')}}}) AS slots
  FROM iw WHERE len(list_filter(w, lambda x: x <> '' AND NOT contains(x, '\u0002'))) >= least({MIN_LITERAL}, n)),
sizes AS (SELECT DISTINCT n FROM iw2 UNION SELECT {WINDOW}),
d AS (SELECT doc_id, raw, {_canonical('raw')} AS canon FROM (SELECT doc_id, {WORDS} AS raw FROM documents)),
dw AS (
  SELECT doc_id, raw, start, n, n || ' ' || {_WINDOW_TEXT.format(p='start', n='n')} AS key
  FROM (SELECT doc_id, raw, canon, sizes.n, unnest(range(0, len(raw) - sizes.n + 1)) AS start FROM d, sizes WHERE len(raw) >= sizes.n)),
hits AS (
  SELECT doc_id, item_id, start - pos AS shift, pos, iw2.n, n_item,
         list_transform(slots, lambda s: {{'at': s.at, 'item': s.item, 'doc': {_VALUE.format('raw[start + s.at - pos + 1]')}}}) AS filled
  FROM dw JOIN iw2 USING (key)),
by_shift AS (
  SELECT doc_id, item_id, shift, count(DISTINCT pos) AS n_windows, max(n_item) AS n_item,
         list_distinct(flatten(list(range(pos, pos + n)))) AS cover, list_distinct(flatten(list(filled))) AS filled
  FROM hits GROUP BY ALL)
SELECT doc_id, item_id, max(len(cover))::BIGINT AS n_covered, max(n_windows)::BIGINT AS n_windows, max(len(filled))::BIGINT AS n_slots
FROM by_shift
WHERE len(cover) >= least({MIN_COVERED}, n_item)
  AND len(list_distinct(list_transform(filled, lambda s: {{'i': s.item, 'd': s.doc}}))) = len(list_distinct(list_transform(filled, lambda s: s.item)))
GROUP BY doc_id, item_id"""


ORACLE["op6_quality_rules"] = f"""
WITH {CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
ids AS (
  SELECT doc_id FROM good, crc_table WHERE (SELECT count(*) FROM good) <= {rules.MAX_TRUSTED}
     OR {crc32('doc_id::VARCHAR')} < (1::BIGINT << 32) * {rules.MAX_TRUSTED} // (SELECT count(*) FROM good)),
code AS (
  SELECT x AS word, {crc32('x')} AS c FROM (SELECT DISTINCT unnest(w) AS x FROM d), crc_table),
tok AS (SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
coded AS (SELECT r, doc_id, i, c, lead(c) OVER (PARTITION BY r ORDER BY i) AS c2 FROM tok JOIN code USING (word)),
grams AS (
  SELECT r, doc_id, c % {rules.K} AS bucket FROM coded UNION ALL
  SELECT r, doc_id, {rules.K} + (c * 31 + c2) % {rules.K} FROM coded WHERE c2 IS NOT NULL),
counts AS (
  SELECT bucket, count(*) AS n_raw, count(ids.doc_id) AS n_target FROM grams LEFT JOIN ids USING (doc_id) GROUP BY bucket),
tot AS (SELECT sum(n_raw) AS n_raw, sum(n_target) AS n_target FROM counts),
wt AS (
  SELECT bucket, CASE WHEN tot.n_target = 0 THEN 0 ELSE round_even((ln(counts.n_target + {rules.SMOOTHING}::DOUBLE) - ln(counts.n_raw + {rules.SMOOTHING}::DOUBLE)
    + (ln(tot.n_raw + {rules.SMOOTHING * 2 * rules.K}::DOUBLE) - ln(tot.n_target + {rules.SMOOTHING * 2 * rules.K}::DOUBLE))) * {rules.UNIT}, 0) END::BIGINT AS v
  FROM counts, tot),
llr AS (SELECT r, sum(v)::BIGINT AS llr FROM grams JOIN wt USING (bucket) GROUP BY r),
win AS (
  SELECT r, i, array_to_string(w[i : i + 2], ' ') AS t
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (
  SELECT r, count(DISTINCT j) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS j FROM (SELECT *, count(*) OVER (PARTITION BY r, t) AS k FROM win) WHERE k > 1)
  GROUP BY r),
base AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(translate(text, '{rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(llr.llr, 0)::BIGINT AS llr
  FROM d LEFT JOIN rep USING (r) LEFT JOIN llr USING (r)),
f AS (
  SELECT *, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr,
       NOT base_failed AND llr >= {round(rules.LEAST * rules.UNIT)} * greatest(2 * n_words - 1, 1) AS kept
FROM f"""


_HOST = f"lower(rtrim(regexp_extract(coalesce(url, ''), '{URL}', 1), '.'))"
_DAY = f"(DATE '{FIRST_DAY}' + ({{}})::INT)"
_TURNS = " UNION ALL ".join(f"""
  SELECT '{name}' AS list_name, '{verdict}' AS verdict, kind, value, c, unnest([
    {{'action': 'add', 'on': {_DAY.format(f'c % {first}')}, 'k': 0}},
    {{'action': 'remove', 'on': {_DAY.format(f'c % {first} + 1 + c % {stay}')}, 'k': 1}},
    {{'action': 'add', 'on': {_DAY.format(f'c % {first} + 1 + c % {stay} + c % {pause}')}, 'k': 2}}]) AS e
  FROM crcs WHERE kind = '{kind}' AND c % 6 = {part}""" for name, verdict, kind, part, first, stay, pause in LISTS)

ORACLE["op1_url_filter"] = f"""
WITH {CRC_TABLE}, p AS (
  SELECT page_id, {_HOST} AS host, rtrim(regexp_extract(coalesce(url, ''), '{URL}', 2), '/') AS path FROM pages),
caps AS (SELECT page_id, host, CASE WHEN host <> '' THEN host || path END AS address, {_DAY.format(crc32('page_id::VARCHAR') + ' % 366')} AS d FROM p, crc_table),
names AS (
  SELECT DISTINCT 'domain' AS kind, unnest([host, regexp_replace(host, '^[^.]+\\.(.+\\..+)$', '\\1')]) AS value FROM p WHERE host <> ''
  UNION SELECT 'url', host || path FROM p WHERE host <> ''),
crcs AS (SELECT kind, value, {crc32('value')} AS c FROM names, crc_table),
turns AS ({_TURNS}),
es AS (SELECT list_name, verdict, kind, value, e.action AS action, e.on AS d FROM turns WHERE e.k < 1 + c % 3),
state AS (
  SELECT page_id, list_name, verdict, kind, value, arg_max(es.action, (es.d, es.action = 'add')) AS action
  FROM caps JOIN es ON es.d <= caps.d AND CASE WHEN kind = 'url' THEN address = value
                                            ELSE host = value OR ends_with(host, '.' || value) END
  GROUP BY ALL),
best AS (
  SELECT page_id, count(*) AS n, min({{'r': CASE WHEN kind = 'url' THEN 0 ELSE 1000000 - length(value) END,
                                       'b': CASE WHEN verdict = 'allow' THEN 0 ELSE 1 END,
                                       'list_name': list_name, 'value': value, 'verdict': verdict}}) AS f
  FROM state WHERE action = 'add' GROUP BY page_id)
SELECT page_id, host, caps.d::DATE AS fetched_on, coalesce(n, 0)::BIGINT AS n_active, f.list_name AS list_name, f.value AS value,
       coalesce(f.verdict, 'none') AS verdict, coalesce(f.verdict, 'none') <> 'block' AS kept
FROM caps LEFT JOIN best USING (page_id)"""


# every pair of distinct lines that share a variant, tested on their words
ORACLE["op8_line_dedup"] = f"""
WITH l AS (
  SELECT doc_id, i - 1 AS line_no, line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
u AS (
  SELECT line, min((doc_id, line_no)) AS least, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM l GROUP BY line),
v AS (
  SELECT line, least, j, md5(array_to_string(list_concat(w[1 : j - 1], w[j + 1 :]), ' ')) AS part
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS j FROM u WHERE len(w) >= {MIN_WORDS})),
whole AS (SELECT line, least, md5(array_to_string(w, ' ')) AS part FROM u WHERE len(w) >= {MIN_WORDS}),
near AS (
  SELECT a.line FROM v a JOIN v b ON a.part = b.part AND a.j = b.j AND b.least < a.least
  UNION SELECT v.line FROM v JOIN whole USING (part) WHERE whole.least < v.least
  UNION SELECT whole.line FROM v JOIN whole USING (part) WHERE v.least < whole.least
  UNION SELECT a.line FROM whole a JOIN whole b ON a.part = b.part AND b.least < a.least),
f AS (
  SELECT doc_id, line_no, (doc_id, line_no) > u.least AS eq, (doc_id, line_no) <= u.least AND near.line IS NOT NULL AS nr
  FROM l JOIN u USING (line) LEFT JOIN near USING (line)),
c AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (eq) AS n_equal, count(*) FILTER (nr) AS n_near,
         string_agg(line_no, ',' ORDER BY line_no) FILTER (eq OR nr) AS dropped
  FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near,
       coalesce(n_lines - n_equal - n_near, 0) AS n_kept, coalesce(dropped, '') AS dropped
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN c USING (doc_id)"""


_ORDERED = " || ".join(f"{x}.f" for x in "abcde")
_DIFFERENT = " AND ".join(f"{x}.f <> {y}.f" for i, x in enumerate("abcde") for y in "abcde"[:i])

# every document under every order, by the letters of the filters that it fails
ORACLE["op11_filter_audit"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < {audit.MIN_WORDS} THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < {audit.MIN_DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {audit.MAX_UPPER_PERCENT} * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '{audit.SYMBOLS}') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM d JOIN least USING (t) LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT {_ORDERED} AS filter_order FROM x a, x b, x c, x d, x e WHERE {_DIFFERENT}),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
s2 AS (SELECT *, filter_order[step] AS filter, filter_order[1 : step - 1] AS earlier FROM s),
r AS (
  SELECT part, filter_order, step::INT AS step, filter,
         sum(CASE WHEN translate(fails, earlier || filter, '') = fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN contains(fails, filter) AND translate(fails, earlier, '') = fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN contains(fails, filter) AND translate(fails, earlier, '') <> fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = filter THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN contains(fails, filter) AND translate(fails, earlier, '') = fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN contains(fails, filter) AND translate(fails, earlier, '') = fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM g, s2 GROUP BY ALL)
SELECT *, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM r"""


# every prefix of every rebuilt conversation as a list of turns
ORACLE["op13_prefix_trie"] = f"""
WITH {CRC_TABLE}, turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text)) AS ts
  FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, ts, {crc32('conv_id::VARCHAR')} % 4 AS h FROM own, crc_table),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.ts[1 : h], []), h.ts[h + 1 :]) AS t
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, d, t[1 : d] AS path, len(t) = d AS ends FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM r)),
n AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS e
  FROM m GROUP BY path, d),
kids AS (SELECT path[1 : d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
w AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN kids USING (path)),
below AS (
  SELECT path[1 : k] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM w) GROUP BY 1)
SELECT w.conv_id, w.d::BIGINT AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(w.e) AS ends_sha256
FROM w JOIN below USING (path) LEFT JOIN n up ON w.d > 0 AND up.d = w.d - 1 AND up.path = w.path[1 : w.d - 1]"""

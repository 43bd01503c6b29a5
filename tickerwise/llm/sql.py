"""DuckDB twins of the queries: each states the result directly, not the operator's method."""

from html import unescape
from html.entities import html5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUBSTRING = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, r, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13),
wins AS (SELECT doc_id, r, i, array_to_string(ws[i:i + 12], ' ') AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS m FROM wins GROUP BY k),
hits AS (SELECT r, i FROM wins JOIN firsts USING (k) WHERE m < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM hits),
words AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)
  UNION SELECT doc_id, array_to_string(ws, ' ') || ' |' FROM d WHERE len(ws) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 90 * (x.n + y.n - p.c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

LINES = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, r, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
common AS (SELECT key, max(doc_id) AS m FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
stay AS (SELECT k.r, string_agg(k.line, chr(10) ORDER BY k.p) AS t, count(*) AS n FROM k LEFT JOIN common c ON c.key = k.key
         WHERE c.m IS NULL OR k.doc_id >= c.m GROUP BY k.r)
SELECT d.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN stay USING (r)
"""

CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS k
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM b WHERE len(ws) > 0)),
s AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
      FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)),
m AS (SELECT s.r, s.i, s.n, w.item_id FROM s JOIN w ON s.n = w.n AND s.k = w.k),
h AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

CHAT = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '~', '~0'), '[INST]', '~1'), '[/INST]', '~2'),
                '<s>', '~3'), '</s>', '~4'), '<<SYS>>', '~5'), '<</SYS>>', '~6'), '[TURN ', '~7'), '[/TURN]', '~8') AS safe,
            replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(role, '~', '~0'), '[INST]', '~1'), '[/INST]', '~2'),
                '<s>', '~3'), '</s>', '~4'), '<<SYS>>', '~5'), '<</SYS>>', '~6'), '[TURN ', '~7'), '[/TURN]', '~8'), ']', '~9') AS safe_role FROM src),
one AS (
  SELECT *, CASE role WHEN 'user' THEN '[INST] ' || text || ' [/INST]' WHEN 'assistant' THEN '<s> ' || text || ' </s>'
                      WHEN 'system' THEN '<<SYS>> ' || text || ' <</SYS>>' ELSE '[TURN ' || role || '] ' || text || ' [/TURN]' END AS plain,
            CASE role WHEN 'user' THEN '[INST] ' || safe || ' [/INST]' WHEN 'assistant' THEN '<s> ' || safe || ' </s>'
                      WHEN 'system' THEN '<<SYS>> ' || safe || ' <</SYS>>' ELSE '[TURN ' || safe_role || '] ' || safe || ' [/TURN]' END AS careful FROM esc),
conv AS (
  SELECT conv_id, count(*) AS n_turns, list(plain ORDER BY turn, role, text) AS turns, string_agg(plain, '' ORDER BY turn, role, text) AS plain,
         string_agg(careful, '' ORDER BY turn, role, text) AS careful,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss
  FROM one GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(2 + CASE WHEN regexp_extract_all(plain, '(?s)<<SYS>> .*? <</SYS>>|\[INST\] .*? \[/INST\]|<s> .*? </s>|\[TURN [^\]]*\] .*? \[/TURN\]') = turns
                     THEN length(plain) ELSE length(careful) END AS BIGINT) AS formatted_chars, true AS round_trip
FROM conv
"""

_TEXT = r"""coalesce(html, '')"""
for _p, _t in [(r"(?s)<!--.*?-->", "''"), (r"(?is)<script\b.*?</script\s*>", "''"), (r"(?is)<style\b.*?</style\s*>", "''"),
               (r"(?i)</?(?:address|article|aside|blockquote|body|br|div|dl|dt|dd|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section"
                r"|table|title|td|th|tr|ul)\b[^>]*>", "chr(10)"), (r"<[^>]*>", "''")]:
    _TEXT = f"regexp_replace({_TEXT}, '{_p}', {_t}, 'g')"
_SPACED = "string_agg(decoded, '' ORDER BY i)"
for _p, _t in [(r"[ \t\r\f]+", "' '"), (r" ?\n[ \n]*", "chr(10)"), (r"^[ \n]+", "''"), (r"[ \n]+$", "''")]:
    _SPACED = f"regexp_replace({_SPACED}, '{_p}', {_t}, 'g')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# character references by the tables of the standard library: all names, and the numbers that do not stand for themselves
_NAMES = "MAP {" + ", ".join(f"{_quoted(k)}: {_quoted(v.replace(chr(0xa0), ' '))}" for k, v in html5.items()) + "}"
_ODD = {i: unescape(f"&#{i};") for i in [*range(161), *range(0xFDD0, 0xFDF0), *(p << 16 | x for p in range(17) for x in (0xFFFE, 0xFFFF))]}
_NUMBERS = "MAP {" + ", ".join(f"{i}: {_quoted(v.replace(chr(0xa0), ' '))}" for i, v in _ODD.items() if v != chr(i) or i == 0xA0) + "}"
_REFERENCES = rf"""
raw AS (SELECT row_number() OVER () AS r, page_id, url, coalesce(html, '') AS payload, {_TEXT} AS stripped FROM pages),
part AS (SELECT r, unnest(string_split(stripped, '&')) AS part, generate_subscripts(string_split(stripped, '&'), 1) AS i FROM raw),
ref AS (SELECT *, regexp_extract(part, '^[a-zA-Z][a-zA-Z0-9]*;?') AS name, regexp_extract(part, '^#0*([0-9]+);?', 1) AS dec, regexp_extract(part, '^#[xX]0*([0-9a-fA-F]+);?', 1) AS hex,
               regexp_extract(part, '^#(?:[0-9]+|[xX][0-9a-fA-F]+);?') AS digits FROM part),
val AS (SELECT *, CASE WHEN dec <> '' AND length(dec) <= 7 THEN CAST(dec AS BIGINT)
                       WHEN hex <> '' AND length(hex) <= 7 THEN list_reduce(list_transform(string_split('0' || lower(hex), ''), lambda x: CAST(instr('0123456789abcdef', x) - 1 AS BIGINT)), lambda x, y: x * 16 + y)
                       WHEN digits <> '' THEN 1114112 END AS code,
               CASE WHEN name <> '' THEN list_max(list_filter(range(2, least(length(name), 40) + 1), lambda k: len(map_extract(names, substr(name, 1, k))) > 0)) END AS known
        FROM ref, (SELECT {_NAMES} AS names)),
done AS (SELECT r, i, CASE WHEN i = 1 THEN part
              WHEN code IS NOT NULL THEN CASE WHEN len(map_extract(numbers, code)) > 0 THEN map_extract(numbers, code)[1]
                   WHEN code > 1114111 OR code BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr(CAST(code AS INT)) END || substr(part, length(digits) + 1)
              WHEN known IS NOT NULL THEN map_extract(names, substr(name, 1, known))[1] || substr(part, known + 1)
              ELSE '&' || part END AS decoded
         FROM val, (SELECT {_NUMBERS} AS numbers)),
spaced AS (SELECT r, {_SPACED} AS plain FROM done GROUP BY r)"""


def _uuid(text: str) -> str:
    h = f"md5({text})"
    return f"'<urn:uuid:' || concat_ws('-', {', '.join(f'substr({h}, {a}, {n})' for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))}) || '>'"


WARC = rf"""
WITH {_REFERENCES},
src AS (
  SELECT page_id, payload, plain,
         replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS target_uri,
         {_uuid("concat_ws(chr(31), 'response', coalesce(CAST(page_id AS VARCHAR), ''), coalesce(url, ''))")} AS refers_to FROM raw JOIN spaced USING (r)),
rec AS (
  SELECT page_id, refers_to, target_uri, payload, 'conversion' AS kind, 'metadata' AS other, 'text/plain; charset=UTF-8' AS content_type, plain AS block FROM src
  UNION ALL
  SELECT page_id, refers_to, target_uri, payload, 'metadata', 'conversion', 'application/warc-fields',
         'source-header: Content-Type: text/html; charset=UTF-8' || chr(13) || chr(10) || 'source-length: ' || CAST(strlen(payload) AS VARCHAR) || chr(13) || chr(10)
         || 'source-digest: sha256:' || sha256(payload) || chr(13) || chr(10) FROM src)
SELECT page_id, kind, {_uuid("concat_ws(chr(31), kind, refers_to)")} AS record_id, refers_to, {_uuid("concat_ws(chr(31), other, refers_to)")} AS concurrent_to,
       target_uri, content_type, 'sha256:' || sha256(block) AS block_digest, 'sha256:' || sha256(payload) AS payload_digest,
       CAST(strlen(block) AS BIGINT) AS content_length, block
FROM rec
"""

COLLOCATIONS = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
sizes AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
          FROM p, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
spans AS (SELECT c.lang, c.a, c.w, c.m, i.i, j.j FROM cand c, (SELECT unnest(range(1, 6)) AS i) i, (SELECT unnest(range(1, 6)) AS j) j
          WHERE i.i < j.j AND j.j <= c.m AND j.j - i.i + 1 < c.m),
inner_ AS (SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS longer FROM spans GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inner_ x USING (lang, phrase) WHERE coalesce(100 * x.longer >= 100 * c.a, false) = false),
cuts AS (SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n, (1000 * c.a * n) // (l.a * r.a) AS score
         FROM kept c CROSS JOIN (SELECT unnest(range(1, 5)) AS k) JOIN sizes USING (lang)
         JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.m], ' ')
         WHERE k < c.m),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

TRIE = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n, CAST(conv_id AS VARCHAR) AS dec FROM t GROUP BY ALL),
h AS (SELECT conv_id, base, n, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(dec, ''),
        lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END), 4294967295::BIGINT) % 9 AS h FROM c),
z AS (SELECT h.*, least(h.h, coalesce(x.n, 0)) AS head FROM h LEFT JOIN c x ON x.conv_id = h.base),
r AS (SELECT z.conv_id, t.pos, t.role, t.text FROM z JOIN t ON t.conv_id = z.base AND t.pos <= z.h
      UNION ALL SELECT z.conv_id, t.pos - z.h + z.head, t.role, t.text FROM z JOIN t ON t.conv_id = z.conv_id AND t.pos > z.h),
k AS (SELECT conv_id, pos AS depth, strlen(text) AS bytes,
             string_agg(sha256(role || chr(0) || text), '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS key FROM r),
p AS (SELECT conv_id, depth, key, substr(key, 1, 64 * (depth - 1)) AS parent, bytes FROM k
      UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c),
node AS (SELECT key, depth, min(conv_id) AS conv_id, any_value(parent) AS parent, any_value(bytes) AS bytes, count(*) AS n_convs FROM p GROUP BY key, depth),
kids AS (SELECT parent AS key, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
w AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (key)),
sub AS (SELECT a.key, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved
        FROM w u JOIN p a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.key),
lens AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
ends AS (SELECT p.key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS e FROM p JOIN lens USING (conv_id, depth) GROUP BY p.key)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(w.n_convs AS BIGINT) AS n_convs, CAST(w.n_children AS BIGINT) AS n_children,
       CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, coalesce(ends.e, sha256('')) AS ends_sha256
FROM w JOIN sub USING (key) LEFT JOIN ends USING (key) LEFT JOIN node up ON up.key = w.parent
"""

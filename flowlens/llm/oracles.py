"""DuckDB SQL for the queries that SQL can express."""

from flowlens.llm.quality import STOP_WORDS

_BLANK = r"\x20\x09-\x0D"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORDS}') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORDS}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS p FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, n, p FROM dw JOIN bw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM m) GROUP BY doc_id),
i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

OP2 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[{_BLANK}]+'),
                             lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""

OP4 = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(line, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g'), '{_UP}', '{_LOW}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, owner IS NOT NULL AND doc_id > owner AS dropped FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
OP6 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[{_BLANK}]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{_BLANK}]')) AS ln
  FROM documents),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
g AS (
  SELECT doc_id, pos, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS win
  FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS times FROM g WHERE win IS NOT NULL),
c AS (SELECT doc_id, count(DISTINCT pos + step) AS n FROM r, (SELECT unnest([0, 1, 2]) AS step) WHERE times > 1 GROUP BY doc_id),
b AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[{_BLANK}]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ln) AS BIGINT) AS n_full_lines,
         CAST(len(list_intersect(list_transform(w, lambda x: translate(x, '{_UP}', '{_LOW}')), [{_STOPS}])) AS BIGINT) AS n_stop_words
  FROM d LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed
       AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words
       AND 100 * n_symbols <= 50 * n_words
       AND n_stop_words >= 2
       AND 100 * n_dup_lines <= 30 * n_full_lines AS kept
FROM f
"""

OP9 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS esc,
         replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS esc_role FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(esc_role) + length(esc)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

#: CRC-32 of the UTF-8 bytes of a column ``s``: its table from the polynomial, then byte by byte.
_CRC_TABLE = """
crc AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS t FROM range(256) r(n))"""


def _crc(column: str) -> str:
    octets = f"list_transform(range(octet_length(encode({column}))), lambda i: CAST('0x' || substr(hex(encode({column})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


OP11 = rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (
  SELECT doc_id, translate(run, '{_UP}', '{_LOW}') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
h AS (SELECT run, times, {_crc("doc_id || ':' || run")} AS h FROM r, crc),
o AS (
  SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM h),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM o WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
c AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS other, b.n AS m FROM c a JOIN c b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM c JOIN w ON c.cut = w.word
  UNION SELECT w.word, c.word, c.n FROM c JOIN w ON c.cut = w.word),
b AS (SELECT word, count(*) AS n_near, max(m) AS m FROM p GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n,
         CASE WHEN b.m >= 10 * w.n THEN (SELECT min(p.other) FROM p WHERE p.word = w.word AND p.m = b.m) END AS form
  FROM w LEFT JOIN b USING (word)),
z(word, root, steps) AS (
  SELECT word, word, 0 FROM f UNION ALL SELECT z.word, f.form, steps + 1 FROM z JOIN f ON f.word = z.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(z.root, z.steps) AS root, f.n, f.n_near, f.form_n
FROM f JOIN z USING (word) GROUP BY ALL
"""

OP12 = rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORDS}') AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORDS}')) AS word FROM benchmark),
k AS (
  SELECT word, {_crc("word")} % 10000 AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN k USING (word) GROUP BY bucket),
g AS (
  SELECT bucket,
         CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM dw) + 10000 AS DOUBLE)
              / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM bw) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
x AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN k USING (word) JOIN g USING (bucket) GROUP BY doc_id),
y AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN x USING (doc_id)),
z AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS eligible FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM z
"""

ORACLES = {
    "op1_decontamination": OP1,
    "op2_ngram_jaccard": OP2,
    "op4_line_dedup": OP4,
    "op9_chat_formatting": OP9,
    "op6_quality_rules": OP6,
    "op11_spelling_variants": OP11,
    "op12_importance_resampling": OP12,
}

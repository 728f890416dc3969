"""The same results as SQL for DuckDB, over the whole tables."""

from __future__ import annotations

from sluiceway.llm.quality_rules import STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

QUALITY_RULES = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
t AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3),
u AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM t),
c AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM u WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclaims, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words
  FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words >= 50 AND word_chars / n_words BETWEEN 1.5 AND 20 AND n_symbols / n_words <= 0.25
    AND n_exclaims / n_words <= 0.5 AND n_dup_lines / n_lines <= 0.6 AND n_stop_words / n_words >= 0.01 AS kept
FROM f
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(md5(doc_id::VARCHAR), '~') AS key,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place FROM r),
b AS (
  SELECT *, sum(source_size) OVER () AS total, 2 * source_size AS most, 2 * coalesce(sum(source_size) OVER (
    ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM o),
k AS (SELECT min(place) AS place FROM b WHERE NOT (most * 100 * weights <= weight * (150 * total - 100 * used))),
e AS (SELECT b.* FROM b JOIN k USING (place)),
t AS (
  SELECT source, source_size, CASE WHEN k.place IS NULL OR b.place < k.place THEN most::DOUBLE
    ELSE (weight * (SELECT 150 * total - 100 * used FROM e))::DOUBLE / ((SELECT weights FROM e) * 100)::DOUBLE END AS target
  FROM b CROSS JOIN k),
u AS (
  SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (CASE WHEN size > 0 AND 2 * start + size <= 2 * target THEN 1 ELSE 0 END
  + CASE WHEN size > 0 AND 2 * (start + source_size) + size <= 2 * target THEN 1 ELSE 0 END)::BIGINT AS taken
FROM u
"""

LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(x, 1) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
b AS (
  SELECT *, CASE WHEN i > 1 AND ((lag(h) OVER (PARTITION BY doc_id ORDER BY i) * 31 + h) % 4294967296) % 3 = 0 THEN 1 ELSE 0 END AS opens FROM h),
c AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM b),
k AS (
  SELECT doc_id, chunk, min(i) AS i, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text,
    count(*) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS wordy
  FROM c GROUP BY doc_id, chunk),
f AS (SELECT *, CASE WHEN wordy >= 2 THEN row_number() OVER (PARTITION BY text ORDER BY doc_id, i) ELSE 1 END AS nth FROM k),
o AS (
  SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (WHERE nth > 1), 0)::BIGINT AS n_removed,
    count(*) FILTER (WHERE nth > 1) AS n_chunks, coalesce(string_agg(text, chr(10) ORDER BY i) FILTER (WHERE nth = 1), '') AS kept
  FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_chunks, 0) AS n_chunks,
  CASE WHEN documents.text IS NOT NULL THEN sha256(o.kept) END AS kept_sha256
FROM documents LEFT JOIN o USING (doc_id)
"""

DECONTAMINATION = r"""
WITH i AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS gram
  FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
h AS (SELECT doc_id, k, s, item FROM s JOIN g USING (k, gram)),
p AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, s, array_to_string(w[s:s + 34], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM w)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY gram) AS n FROM s) WHERE n > 1),
p AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(s, s + 35)) AS p FROM r) GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w) ANTI JOIN (SELECT doc_id, unnest(gone) AS i FROM p) USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN p USING (doc_id) LEFT JOIN k USING (doc_id)
"""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

MANIFEST = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, concat(coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-'),
      coalesce(strlen(source)::VARCHAR || ':' || source, '-'), coalesce(strlen(lang)::VARCHAR || ':' || lang, '-'),
      coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-')) AS head,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS body,
    list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [256 + ascii(c), 1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[])),
      lambda c, x: CASE WHEN x >= 256 THEN xor(c, x - 256) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
  FROM documents),
r AS (
  SELECT doc_id, lang, sha256(head || body) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) END AS other,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS place
  FROM d),
n AS (
  SELECT lang, 0 AS lev, place, leaf AS node FROM r
  UNION ALL
  SELECT lang, lev + 1, place // 8, sha256(string_agg(node, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS c FROM n) WHERE c > 1 GROUP BY lang, lev, place // 8),
m AS (SELECT lang, max(lev) AS top, arg_max(node, lev) AS subroot FROM n GROUP BY lang),
s AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM m),
k AS (
  SELECT 0 AS lev, place, subroot AS node FROM s
  UNION ALL
  SELECT lev + 1, place // 8, sha256(string_agg(node, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER () AS c FROM k) WHERE c > 1 GROUP BY lev, place // 8),
w AS (SELECT max(lev) AS top, arg_max(node, lev) AS root FROM k),
steps AS (
  SELECT r.lang, r.place, n.lev, coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place < r.place >> (3 * n.lev)), '') AS l,
    coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place > r.place >> (3 * n.lev)), '') AS r
  FROM r JOIN m ON r.lang IS NOT DISTINCT FROM m.lang JOIN n ON n.lang IS NOT DISTINCT FROM r.lang AND n.lev < m.top
    AND n.place >> 3 = r.place >> (3 * n.lev + 3) GROUP BY ALL
  UNION ALL
  SELECT r.lang, r.place, 1000 + k.lev, coalesce(string_agg(k.node, '' ORDER BY k.place) FILTER (k.place < s.place >> (3 * k.lev)), ''),
    coalesce(string_agg(k.node, '' ORDER BY k.place) FILTER (k.place > s.place >> (3 * k.lev)), '')
  FROM r JOIN s ON r.lang IS NOT DISTINCT FROM s.lang JOIN k ON k.lev < (SELECT top FROM w) AND k.place >> 3 = s.place >> (3 * k.lev + 3) GROUP BY ALL),
p AS (SELECT lang, place, list(l || '|' || r ORDER BY lev) AS path, string_agg(l || r, '' ORDER BY lev) AS siblings FROM steps GROUP BY lang, place),
f AS (
  SELECT r.*, m.subroot, w.root, sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce([coalesce(other, leaf)] || coalesce(path, []::VARCHAR[]), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
  FROM r JOIN m ON r.lang IS NOT DISTINCT FROM m.lang CROSS JOIN w LEFT JOIN p ON p.lang IS NOT DISTINCT FROM r.lang AND p.place = r.place)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f
"""


def _repair_step() -> str:
    """Cheapest suffix of edits by state (e, s, u, a) before a turn, from those after it, with the texts that it leaves."""
    def edit(letter: str, cost: str, after: str, line: str | None) -> str:
        lines = f"v.{after}.r" if line is None else f"list_prepend({line}, v.{after}.r)"
        return f"{{'c': {cost} + v.{after}.c, 'a': '{letter}' || v.{after}.a, 'r': {lines}}}"

    parts = []
    for state in "esua":
        after, name = ("a", "assistant") if state == "u" else ("u", "user")
        options = [edit("D", "2", state, None), f"CASE WHEN NOT gone THEN {edit('R', '1 + extra', after, f"'{name}:' || text")} END"]
        options.append(f"CASE WHEN NOT gone AND initial = '{after}' THEN {edit('K', 'extra', after, "role || ':' || text")} END")
        if state == "e":
            options.append(f"CASE WHEN NOT gone AND initial = 's' THEN {edit('K', 'extra', 's', "role || ':' || text")} END")
        parts.append(f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1] AS {state}")
    return ",\n      ".join(parts)


def _repair_inserts() -> str:
    user = "{'c': 5 + u.c, 'a': 'I' || u.a, 'r': list_prepend('user:', u.r)}"
    both = "{'c': 10 + a.c, 'a': 'II' || a.a, 'r': list_prepend('user:', list_prepend('assistant:', a.r))}"
    assistant = "{'c': 5 + a.c, 'a': 'I' || a.a, 'r': list_prepend('assistant:', a.r)}"
    return f"list_sort([e, {user}, {both}])[1] AS e, list_sort([s, {user}, {both}])[1] AS s, list_sort([u, {assistant}])[1] AS u, list_sort([a, {user}])[1] AS a"


CONVERSATION_REPAIR = rf"""
WITH RECURSIVE b AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda c: [256 + ascii(c), 1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[])),
      lambda c, x: CASE WHEN x >= 256 THEN xor(c, x - 256) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) % 20 AS f
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM b WHERE f <> 0),
o AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS initial, left(role, 1) || lead(left(role, 1)) OVER w AS pair,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, CASE WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 0 ELSE 5 END AS extra
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
p AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM o),
z AS (SELECT *, blank OR again AS gone FROM p),
v AS (
  SELECT conv_id, max(i) + 1 AS i, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS e, {{'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']}} AS s,
    {{'c': 5, 'a': 'I', 'r': ['assistant:']}} AS u, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS a FROM z GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, {_repair_inserts()}
  FROM (
    SELECT z.conv_id, z.i, {_repair_step()}
    FROM v JOIN z ON z.conv_id IS NOT DISTINCT FROM v.conv_id AND z.i = v.i - 1)),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
    count(*) FILTER (NOT gone AND extra > 0) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM z GROUP BY conv_id),
n AS (SELECT DISTINCT conv_id FROM conversations)
SELECT n.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.e.c, 0)::BIGINT AS cost, coalesce(v.e.a, '') AS audit,
  sha256(coalesce(array_to_string(v.e.r, chr(10)), '')) AS repaired_sha256
FROM n LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM n.conv_id AND v.i = 1
"""

ORACLES = {
    "op12_conversation_repair": CONVERSATION_REPAIR,
    "op13_merkle_manifest": MANIFEST,
    "op2_decontamination": DECONTAMINATION,
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op4_minhash_near_dedup": NEAR_DEDUP,
    "op1_line_dedup": LINE_DEDUP,
    "op5_mixing": MIXING,
    "op10_quality_rules": QUALITY_RULES,
}

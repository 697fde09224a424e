"""SQL of the queries that SQL can express, for DuckDB over the same parquet tables."""

from __future__ import annotations

#: The reversed polynomial and the start value of CRC-32.
_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::UBIGINT], list_transform(range(8), lambda x: 0::UBIGINT)),
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def _crc(text: str) -> str:
    """CRC-32 of ASCII text, beside ``crc_table``."""
    return f"""xor(list_reduce(list_concat([4294967295::UBIGINT],
      list_transform(range(1, length({text}) + 1), lambda k: ord(substr({text}, k, 1))::UBIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)"""


def _framed(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_framed(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels(name: str, start: str) -> str:
    """All levels of the trees that start with (tree, slot, n, digest)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, slot, n, digest FROM {start}
  UNION ALL
  SELECT tree, level + 1, slot // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY slot))
  FROM {name} WHERE n > 1 GROUP BY tree, level, slot // 2, n)"""


def _paths(name: str, start: str, levels: str) -> str:
    """One row per level of each wanted leaf (id, tree, rank): what stands beside it."""
    return f"""{name} AS (
  SELECT w.id, w.tree, v.level, w.rank // CAST(power(2, v.level) AS BIGINT) % 2 AS digit, s.digest AS beside
  FROM {start} w JOIN (SELECT DISTINCT tree, level, n FROM {levels} WHERE n > 1) v USING (tree)
  LEFT JOIN {levels} s ON s.tree = w.tree AND s.level = v.level
    AND s.slot = xor(w.rank // CAST(power(2, v.level) AS BIGINT), 1))"""


MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS altered
  FROM documents, crc_table),
low AS (
  SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS slot,
    count(*) OVER (PARTITION BY tree) AS n FROM d),
{_levels("tree_levels", "low")},
subroots AS (
  SELECT 'top' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS slot, count(*) OVER () AS n
  FROM tree_levels WHERE n = 1),
{_levels("top_levels", "subroots")},
wanted AS (SELECT id, tree, slot AS rank FROM low),
wanted_top AS (SELECT name AS id, tree, slot AS rank FROM subroots),
{_paths("lower", "wanted", "tree_levels")},
{_paths("upper", "wanted_top", "top_levels")},
beside AS (
  SELECT id, level, digit, beside FROM lower
  UNION ALL
  SELECT l.id, 1000 + u.level, u.digit, u.beside FROM low l JOIN upper u ON u.id = l.tree),
path AS (
  SELECT id, list(struct_pack(digit := digit, beside := coalesce(beside, '')) ORDER BY level) AS steps FROM beside GROUP BY id),
fold AS (
  SELECT l.id, 1 AS k, coalesce(altered, leaf) AS own, coalesce(steps, []) AS steps FROM low l LEFT JOIN path USING (id)
  UNION ALL
  SELECT id, k + 1, sha256(CASE WHEN steps[k].digit = 1 THEN steps[k].beside || own ELSE own || steps[k].beside END), steps
  FROM fold WHERE k <= len(steps))
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root,
  sha256(array_to_string(list_transform(f.steps, lambda x: x.beside), '')) AS proof_sha256,
  f.own AS folded_root, f.own = r.digest AS verified
FROM low l JOIN subroots s ON s.name = l.tree JOIN (SELECT digest FROM top_levels WHERE n = 1) r ON true
JOIN fold f ON f.id = l.id AND f.k = len(f.steps) + 1
"""

_BLANK = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_BLANK}') AS w FROM documents),
lines AS (SELECT id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_BLANK}')) AS l FROM d),
windows AS (
  SELECT id, i, array_to_string(w[i:i + 4], ' ') AS five FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT id, i, count(*) OVER (PARTITION BY id, five) AS n FROM windows),
covered AS (SELECT id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) WHERE twice.n > 1 GROUP BY id),
m AS (
  SELECT d.id, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(l) AS n_lines,
    coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '\p{{Ll}}'))) AS n_upper_words,
    len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) AS n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '([.][.][.]|…)[ \t\r]*$'))) AS n_open_lines
  FROM d JOIN lines USING (id) LEFT JOIN covered ON covered.id = d.id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  n_words >= 10 AND word_chars BETWEEN 3 * n_words AND 10 * n_words AND longest_word <= 1000 AND 10 * n_symbols <= n_words
    AND 2 * n_dup_lines <= n_lines AND 100 * n_repeat_words <= 20 * n_words AND 10 * n_letter_words >= 6 * n_words
    AND 10 * n_upper_words <= 3 * n_words AND 10 * n_bullet_lines <= 9 * n_lines AND 10 * n_open_lines <= 3 * n_lines AS kept
FROM m
"""

TRIE = f"""
WITH RECURSIVE {_CRC_TABLE},
t AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT conv_id, list(turn ORDER BY k) AS turns FROM t GROUP BY conv_id),
spec AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS base_id, CAST({_crc("CAST(conv_id AS VARCHAR)")} % 4 AS BIGINT) AS h
  FROM whole, crc_table),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns, [])[1:h], s.turns[h + 1:]) AS turns
  FROM spec s LEFT JOIN whole b ON b.conv_id = s.base_id),
prefixes AS (SELECT conv_id, len(turns) AS n, d, turns[1:d] AS path FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) > d AS inside,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].x, '{_BLANK}')) END AS words
  FROM prefixes GROUP BY path, d),
above AS (SELECT path, path[1:a] AS top, a FROM (SELECT path, unnest(range(0, depth + 1)) AS a FROM nodes)),
sums AS (
  SELECT a.top, count(*) FILTER (NOT v.inside) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens,
    count(*) FILTER (v.depth = a.a + 1) AS n_children
  FROM above a JOIN nodes v ON v.path = a.path GROUP BY a.top)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, u.n_convs, s.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
FROM nodes u JOIN sums s ON s.top = u.path LEFT JOIN nodes p ON u.depth > 0 AND p.path = u.path[1:u.depth - 1]
"""

ORACLE = {"op11_merkle_manifest": MANIFEST, "op12_prefix_trie": TRIE, "op13_quality_rules": QUALITY}

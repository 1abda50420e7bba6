"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from palate.llm import common, license_rules, license_scan, merkle, pii, secrets, sharding, winnowing


def re2(pattern: str) -> str:
    """The pattern without possessive marks, as a SQL string; what they forbid never matters for these patterns."""
    for mark in ("}+", "*+", "++"):
        pattern = pattern.replace(mark, mark[0])
    return "'" + pattern.replace("'", "''") + "'"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def placed_matches(source: str, columns: str, rules: list[tuple[int, str, str, int]], text: str = "t") -> str:
    """(columns, o, k, s, e, f) of all matches of (order, kind, pattern, group) rules in source.text."""
    parts = " UNION ALL ".join(
        f"SELECT {columns}, {order} AS o, '{kind}' AS k, regexp_extract_all({text}, {p}) AS w, string_split_regex({text}, {p}) AS g, "
        f"regexp_extract_all({text}, {p}, {group}) AS fs FROM {source} WHERE regexp_matches({text}, {p})"
        for order, kind, p, group in rules)
    return f"""
SELECT {columns}, o, k, f, s, s + n AS e FROM (
  SELECT {columns}, o, k, fs[i] AS f, length(w[i]) AS n,
    CAST(list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN w[1:i - 1]]), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM ({parts})))"""


def digest(columns: str, order: str, base: str) -> str:
    """The result rows from base (r, doc_id) and spans (r, o, k, s, e)."""
    joined = "string_agg(k || ':' || s || ':' || e, ',' ORDER BY {order})".format(order=order)
    return f"""
SELECT b.doc_id, {columns}, sha256(coalesce({joined} FILTER (WHERE {base}), '')) AS base_sha256, coalesce({joined}, '') AS spans
FROM base b LEFT JOIN spans z ON b.r = z.r GROUP BY b.r, b.doc_id"""


def counts(kinds) -> str:
    return ", ".join(f"count(*) FILTER (WHERE k = '{kind}') AS n_{kind}" for kind in kinds)


def license_sql() -> str:
    """A detection goes if any better one contains it: what keeps it from mattering contains it too."""
    words = "regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    hits = " || ".join(
        "[{'p': i, 'l': '%s'} FOR i IN range(1, len(w) + 1) IF %s]" % (label, " AND ".join(f"w[i + {n}] = '{word}'" for n, word in enumerate(phrase)))
        for phrase, label in license_scan.PHRASES)
    rules = [(number, rule, re2(license_scan.spaced(rule[3]))) for number, rule in enumerate(license_rules.all_rules())]
    found = " UNION ALL ".join(
        f"SELECT r, {number} AS o, {priority} AS k, '{label}' AS l, regexp_extract_all(t, {p}) AS w, string_split_regex(t, {p}) AS g "
        f"FROM texts WHERE contains(t, {quoted(license_scan.filter_word(keyword, license_scan.spaced(pattern)))}) AND regexp_matches(t, {p})"
        for number, (label, priority, keyword, pattern), p in rules)
    sure = " ".join(f"WHEN {priority} THEN {value}" for priority, value in license_scan.CONFIDENCE.items())
    return f"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
worded AS (SELECT r, doc_id, {words} AS w FROM texts),
phrased AS MATERIALIZED (SELECT r, doc_id, len(w) AS n, {hits} AS h FROM worded),
raw AS ({found}),
placed AS MATERIALIZED (
  SELECT r, o, k, l, s, s + length(m) AS e FROM (
    SELECT r, o, k, l, w[i] AS m, list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN w[1:i - 1]]), 0) AS s
    FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM raw))),
kept AS (
  SELECT * FROM placed a WHERE NOT EXISTS (
    SELECT 1 FROM placed b WHERE b.r = a.r AND b.s <= a.s AND a.e <= b.e
      AND (-b.k, b.s - b.e, b.s, b.o) < (-a.k, a.s - a.e, a.s, a.o))),
rules AS (SELECT r, list(l) AS ls, max(CASE k {sure} END) AS c FROM kept GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(h) AS BIGINT) AS n_base,
  CAST(list_min([x.p FOR x IN h]) - 1 AS BIGINT) AS first_word, CAST(list_max([x.p FOR x IN h]) - 1 AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct([x.l FOR x IN h])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct([x.l FOR x IN h] || coalesce(ls, []))), ',') AS labels,
  CAST(greatest(CASE WHEN len(h) > 0 THEN {license_scan.BASE_CONFIDENCE} ELSE 0 END, coalesce(c, 0)) AS DOUBLE) AS score
FROM phrased LEFT JOIN rules USING (r)"""


BASE = "base AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"

SECRETS = f"""
WITH {BASE},
found AS ({placed_matches("base", "r", [(n, rule.kind, re2(rule.pattern), rule.group) for n, rule in enumerate(secrets.RULES)])}),
spans AS (SELECT * FROM found WHERE CASE k WHEN 'assign' THEN length(f) >= 6 WHEN 'access' THEN length(f) >= 20 ELSE true END)
{digest(counts(rule.kind for rule in secrets.RULES[:3]), "s, o", "o < 3")}
"""

ENTITIES = [
    (0, "email", r"'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'", 0), (1, "ip", r"'[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'", 0),
    (2, "card", r"'[0-9]([\x20-]?[0-9])+'", 0), (3, "phone", r"'\+[0-9][\x20().0-9-]+[0-9]'", 0)]

PERSONAL = f"""
WITH {BASE},
found AS ({placed_matches("base", "r", ENTITIES)}),
numbers AS (SELECT *, regexp_replace(f, '[^0-9]', '', 'g') AS d FROM found),
spans0 AS MATERIALIZED (
  SELECT r, o, k, s, e, k || ':' || CASE k WHEN 'email' THEN lower(f) WHEN 'ip' THEN f ELSE d END AS entity FROM numbers
  WHERE CASE k WHEN 'email' THEN true
    WHEN 'ip' THEN len([x FOR x IN string_split(f, '.') IF CAST(x AS HUGEINT) > 255]) = 0
    WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
    ELSE length(d) BETWEEN 13 AND 19 AND list_sum([CASE
      WHEN i % 2 = 1 THEN CAST(d[length(d) - i + 1] AS INT) WHEN CAST(d[length(d) - i + 1] AS INT) > 4
      THEN 2 * CAST(d[length(d) - i + 1] AS INT) - 9 ELSE 2 * CAST(d[length(d) - i + 1] AS INT) END FOR i IN range(1, length(d) + 1)]) % 10 = 0 END),
blanked AS MATERIALIZED (
  SELECT r, t, array_to_string([CASE WHEN len([x FOR x IN ss IF x.s < i AND i <= x.e]) > 0 THEN ' ' ELSE cs[i] END FOR i IN range(1, len(cs) + 1)], '') AS b
  FROM (SELECT r, t, regexp_extract_all(t, '(?s).') AS cs FROM base)
  JOIN (SELECT r, list({{'s': s, 'e': e}}) AS ss FROM spans0 GROUP BY r) USING (r)),
words AS ({placed_matches("blanked", "r, t", [(4, "term", re2(pii.TERM), 0)], "b")}),
near AS MATERIALIZED (SELECT r, t, lower(f) AS term, s, e FROM words),
held AS (SELECT DISTINCT r, entity FROM spans0),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM base),
entities AS (SELECT entity, count(DISTINCT r) AS n_e FROM spans0 GROUP BY entity),
pairs AS (SELECT entity, term, count(DISTINCT r) AS n_te FROM near JOIN held USING (r) GROUP BY entity, term HAVING count(DISTINCT t) >= {pii.SUPPORT}),
terms AS (
  SELECT term, count(*) AS n_t FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(t), {re2(pii.TERM)}))) AS term FROM base)
  GROUP BY term),
bad AS (
  SELECT entity, term FROM pairs JOIN terms USING (term) JOIN entities USING (entity), total
  WHERE n_e < n AND ln(n_te * n / (n_t * n_e)) / ln(n / n_e) >= {pii.DISCLOSURE}),
spans AS (
  SELECT r, o, k, s, e FROM spans0
  UNION ALL SELECT DISTINCT r, 4, 'term', s, e FROM near JOIN held USING (r) JOIN bad USING (entity, term))
{digest(counts(pii.KINDS), "o, s", "o < 4")}
"""

JACCARD = """
WITH RECURSIVE words AS (
  SELECT rowid AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
shingles AS MATERIALIZED (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.r AS x, b.r AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT x, y FROM pairs UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, min(t.doc_id)) AS component_id
FROM sets s LEFT JOIN reach ON reach.x = s.r LEFT JOIN sets t ON t.r = reach.y GROUP BY s.r, s.doc_id, s.s
"""


def shards_sql(shards: int = 16, seed: int = 7) -> str:
    """Checksums by table and reduce, the Feistel rounds as nested selects, the cycle walk as a recursive query."""
    word = "18446744073709551616"
    table = "range(256)"
    for _ in range(8):
        table = f"[CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END FOR x IN {table}]"

    def rounds(source: str) -> str:
        select = f"SELECT row_no, n, half, low, place >> half AS l, place & low AS h FROM {source}"
        for number in range(sharding.ROUNDS):
            key = (seed * sharding.ROUNDS + number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
            keep = "row_no, n, half, low, l, h"
            select = f"SELECT {keep}, CAST((h::UHUGEINT + {key}::UHUGEINT) % {word}::UHUGEINT AS UBIGINT) AS m FROM ({select})"
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                select = (f"SELECT {keep}, CAST((xor(m, m >> {shift})::UHUGEINT * {factor}::UHUGEINT) % {word}::UHUGEINT AS UBIGINT) AS m "
                          f"FROM ({select})")
            select = f"SELECT row_no, n, half, low, h AS l, xor(l, xor(m, m >> 31) & low) AS h FROM ({select})"
        return f"SELECT row_no, n, half, low, (l << half) | h AS place FROM ({select})"

    return f"""
WITH RECURSIVE crc AS (SELECT {table} AS t),
rows AS MATERIALIZED (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    CAST(xor(list_reduce([4294967295] || [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS BIGINT) AS text_crc32
  FROM documents, crc),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY substr(md5(concat_ws('|', doc_id, size, text_crc32)), 1, {sharding.CELL_DIGITS}),
    doc_id NULLS FIRST, size, text_crc32) - 1 AS row_no FROM rows),
span AS (SELECT count(*) AS n, CAST(greatest(1, (length(bin(greatest(count(*) - 1, 1))) + 1) // 2) AS UBIGINT) AS half FROM rows),
starts AS (SELECT row_no, n, half, (1::UBIGINT << half) - 1 AS low, CAST(row_no AS UBIGINT) AS place FROM numbered, span),
walk AS ({rounds("starts")} UNION ALL {rounds("(SELECT * FROM walk WHERE place >= n)")})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place % {shards} AS INTEGER) AS shard, CAST(place // {shards} AS BIGINT) AS slot, row_no,
  CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (row_no) WHERE place < n"""


WORD = 2 ** 64


def wrapped(expression: str) -> str:
    return f"CAST(({expression}) % {WORD}::UHUGEINT AS UBIGINT)"


def fingerprint_sql() -> str:
    """Runs' hashes by Horner's rule over the following characters, windows by a moving minimum of (hash, place from the right)."""
    gram, window, base = winnowing.GRAM, winnowing.WINDOW, int(common.BASE)
    following = ", ".join(f"lead(code, {n}) OVER w AS c{n}" for n in range(1, gram))
    steps = "SELECT *, CAST(code + 1 AS UBIGINT) AS h0 FROM ahead WHERE place < greatest(n - {0}, 1)".format(gram - 1)
    for n in range(1, gram):
        step = wrapped(f"h{n - 1}::UHUGEINT * {base}::UHUGEINT + c{n}::UHUGEINT + 1::UHUGEINT")
        steps = f"SELECT * EXCLUDE (h{n - 1}), CASE WHEN c{n} IS NULL THEN h{n - 1} ELSE {step} END AS h{n} FROM ({steps})"
    mixed = f"SELECT text_id, place, n, h{gram - 1} AS h FROM ({steps})"
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        step = wrapped(f"xor(h, h >> {shift})::UHUGEINT * {factor}::UHUGEINT")
        mixed = f"SELECT text_id, place, n, {step} AS h FROM ({mixed})"
    return f"""
WITH firsts AS MATERIALIZED (SELECT DISTINCT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS m FROM documents),
ordered AS MATERIALIZED (
  SELECT *, length(t) AS n, coalesce(lead(t) OVER o, first_value(t) OVER o) AS next
  FROM firsts WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, m DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edited AS MATERIALIZED (
  SELECT *, substr(t, 1, CAST(n - n // 2 AS BIGINT)) || substr(next, 1, CAST(n // 2 AS BIGINT)) AS e, md5(next) AS next_id FROM ordered),
texts AS MATERIALIZED (
  SELECT md5(t) AS text_id, any_value(t) AS t FROM (SELECT t FROM edited UNION ALL SELECT e FROM edited) GROUP BY 1),
places AS (
  SELECT text_id, n, unnest(range(n)) AS place, unnest(cs) AS code FROM (
    SELECT text_id, CAST(length(t) AS BIGINT) AS n, [unicode(c) FOR c IN regexp_extract_all(t, '(?s).')] AS cs FROM texts)),
ahead AS (SELECT *, {following} FROM places WINDOW w AS (PARTITION BY text_id ORDER BY place)),
hashed AS (SELECT text_id, place, greatest(n - {gram - 1}, 1) AS runs, least(xor(h, h >> 31), {WORD - 2}::UBIGINT) AS h FROM ({mixed})),
least_ones AS (
  SELECT text_id, place, runs, min((h::UHUGEINT << 32) + (4294967295 - place)::UHUGEINT) OVER (
    PARTITION BY text_id ORDER BY place ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS best FROM hashed),
chosen AS (SELECT DISTINCT text_id, best FROM least_ones WHERE place <= greatest(runs - {window}, 0)),
split AS (SELECT text_id, CAST(best >> 32 AS UBIGINT) AS h, CAST(4294967295 - CAST(best & 4294967295::UHUGEINT AS BIGINT) AS BIGINT) AS place FROM chosen),
printed AS MATERIALIZED (
  SELECT text_id, string_agg(printf('%016x:%08x', h, place), ',' ORDER BY place) AS f, list(DISTINCT h) AS hs FROM split GROUP BY text_id),
met AS (
  SELECT r.doc_id, r.m, CAST(r.n AS BIGINT) AS n_chars, sha256(r.e) AS edited_sha256, coalesce(a.f, '') AS fingerprint,
    coalesce(b.f, '') AS edited_fingerprint, coalesce(a.hs, []) AS x, coalesce(b.hs, []) AS y, coalesce(c.hs, []) AS z
  FROM edited r LEFT JOIN printed a ON a.text_id = r.m LEFT JOIN printed b ON b.text_id = md5(r.e) LEFT JOIN printed c ON c.text_id = r.next_id)
SELECT d.doc_id, met.n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN len(x) + len(y) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(x, y))::DOUBLE / (len(x) + len(y) - len(list_intersect(x, y))) END AS near_edited,
  CASE WHEN len(x) + len(z) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(x, z))::DOUBLE / (len(x) + len(z) - len(list_intersect(x, z))) END AS near_next
FROM documents d JOIN met ON d.doc_id IS NOT DISTINCT FROM met.doc_id AND md5(coalesce(d.text, '')) = met.m"""


def manifest_sql(levels: int = 7) -> str:
    """Levels one after the other, for at most 8 ** `levels` rows of a language and so many languages."""
    fan = merkle.FAN

    def field(column: str) -> str:
        return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || {column}, '-')"

    def leaf(text: str) -> str:
        return "sha256({})".format(" || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {field(text)}")

    def tree(name: str, leaves: str) -> str:
        """Nodes of every level of the trees (g) over leaves (g, i, d), finished trees once more on each later level."""
        parts = [f"{name}0 AS MATERIALIZED ({leaves})"]
        for level in range(levels):
            parts.append(f"""{name}{level + 1} AS MATERIALIZED (
  SELECT g, i // {fan} AS i, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{level}) GROUP BY g, i // {fan})""")
        return ",\n".join(parts)

    def climb(first: str, name: str, group: str, place: str, carried: str) -> tuple[str, str]:
        """One CTE per level, and the last one's name: rows' siblings on the left (a) and right (b), their digests so far (p) and the folded value (f)."""
        parts, before = [], first
        for level in range(levels):
            node = f"""
  SELECT r.* EXCLUDE (p, f), r.p || coalesce(string_agg(s.d, '' ORDER BY s.i), '') AS p,
    CASE WHEN any_value(k.n) = 1 THEN r.f ELSE sha256(coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (WHERE s.i < r.{place} // {fan ** level}), '') || r.f ||
      coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (WHERE s.i > r.{place} // {fan ** level}), '')) END AS f
  FROM {before} r JOIN (SELECT g, count(*) AS n FROM {name}{level} GROUP BY g) k ON k.g = r.{group}
  LEFT JOIN {name}{level} s ON s.g = r.{group} AND s.i // {fan} = r.{place} // {fan ** (level + 1)} AND s.i <> r.{place} // {fan ** level}
  GROUP BY {carried}, r.p, r.f"""
            before = f"{first}_{level}"
            parts.append(f"{before} AS MATERIALIZED ({node})")
        return ",\n".join(parts), before

    table = "range(256)"
    for _ in range(8):
        table = f"[CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END FOR x IN {table}]"
    carried = "r.r, r.doc_id, r.leaf, r.g, r.i, r.top"
    inner, after = climb("start", "node", "g", "i", carried)
    outer, last = climb("middle", "crown", "top", "g", carried)
    return f"""
WITH crc AS (SELECT {table} AS t),
hashed AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, {leaf("text")} AS leaf, {leaf("shown")} AS shown FROM (
    SELECT *, CASE WHEN xor(list_reduce([4294967295] || [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..')],
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 3 = 0
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown FROM documents, crc)),
placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM hashed),
{tree("node", "SELECT g, i, leaf AS d FROM placed")},
{tree("crown", f"SELECT 0 AS g, g AS i, d FROM node{levels}")},
start AS (SELECT r, doc_id, leaf, g, i, 0 AS top, '' AS p, shown AS f FROM placed),
{inner},
middle AS (SELECT * FROM {after}),
{outer}
SELECT doc_id, leaf, n.d AS subroot, c.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = c.d AS verified
FROM {last} l JOIN node{levels} n ON n.g = l.g, crown{levels} c"""

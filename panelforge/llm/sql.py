"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from . import licenses, secretscan

_OP3 = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM grams),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)
),
hits AS (SELECT p.doc_id, p.i, p.n, g.item_id FROM places p JOIN grams g ON p.gram = g.gram AND p.n = g.n),
counted AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP5 = r"""
WITH named AS (
  SELECT page_id, regexp_replace(lower(regexp_extract(coalesce(url, ''),
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)', 1)), '\.+$', '') AS host,
         DATE '2024-01-01' + CAST((page_id * 37) % 365 AS INTEGER) AS day
  FROM pages
),
hosted AS (SELECT page_id, day, CASE WHEN length(host) <= 253 THEN host ELSE '' END AS host FROM named),
labels_ AS (
  SELECT DISTINCT host, CASE WHEN regexp_matches(host, '^(?:[0-9.]+|\[.*)$') THEN [host] ELSE string_split(host, '.') END AS p
  FROM hosted WHERE host <> ''
),
suffix AS (
  SELECT host, array_to_string(list_slice(p, i, len(p)), '.') AS pattern
  FROM (SELECT host, p, unnest(range(1, greatest(len(p) - 1, 1) + 1)) AS i FROM labels_)
),
listed AS (
  SELECT pattern, CAST('0x' || substr(h, 1, 2) AS INTEGER) AS a, CAST('0x' || substr(h, 3, 2) AS INTEGER) AS b,
         CAST('0x' || substr(h, 5, 2) AS INTEGER) AS c, CAST('0x' || substr(h, 7, 2) AS INTEGER) AS d
  FROM (SELECT DISTINCT pattern, md5(pattern) AS h FROM suffix WHERE pattern <> '')
),
log AS (
  SELECT CASE WHEN d % 2 = 0 THEN 'hosts' ELSE 'abuse' END AS list, pattern,
         CASE WHEN d % 4 = 0 THEN 'allow' ELSE 'block' END AS verdict, event, DATE '2024-01-01' + CAST(n AS INTEGER) AS day
  FROM (
    SELECT *, 'add' AS event, b AS n FROM listed WHERE a < 128
    UNION ALL SELECT *, 'remove', b + c FROM listed WHERE a < 128 AND c % 3 < 2
    UNION ALL SELECT *, 'add', b + c + 30 FROM listed WHERE a < 128 AND c % 3 = 1
  )
),
valid AS (
  SELECT * FROM (
    SELECT list, pattern, verdict, event, day AS valid_from,
           lead(day) OVER (PARTITION BY list, pattern ORDER BY day, event, verdict) AS valid_to FROM log
  ) WHERE event = 'add' AND (valid_to IS NULL OR valid_to > valid_from)
),
ranked AS (
  SELECT x.host, x.day, v.*, row_number() OVER (
           PARTITION BY x.host, x.day ORDER BY length(v.pattern) DESC, v.verdict, v.list, v.pattern, v.valid_from) AS r
  FROM (SELECT DISTINCT host, day FROM hosted WHERE day IS NOT NULL) x
  JOIN suffix s ON x.host = s.host
  JOIN valid v ON v.pattern = s.pattern AND v.valid_from <= x.day AND (v.valid_to IS NULL OR x.day < v.valid_to)
)
SELECT h.page_id, h.host, h.day, coalesce(r.verdict, 'none') AS verdict, r.pattern AS rule, r.list AS rule_list, r.valid_from AS rule_from
FROM hosted h LEFT JOIN (SELECT * FROM ranked WHERE r = 1) r ON h.host = r.host AND h.day = r.day
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _located(name: str, pattern: str) -> str:
    """(doc_id, s, e, m): matches of a pattern with their places."""
    p = _quoted(pattern)
    return f"""
{name} AS (
  SELECT doc_id, list_sum(list_slice(g, 1, i)) + coalesce(list_sum(list_slice(n, 1, i - 1)), 0) AS s,
         list_sum(list_slice(g, 1, i)) + list_sum(list_slice(n, 1, i)) AS e, m[i] AS m
  FROM (
    SELECT doc_id, m, unnest(range(1, len(m) + 1)) AS i, list_transform(m, lambda x: length(x)) AS n,
           list_transform(string_split_regex(text, {p}), lambda x: length(x)) AS g
    FROM (SELECT doc_id, text, regexp_extract_all(text, {p}) AS m FROM doc)
  )
)"""


def _entropy(k: int, cls: secretscan.CharClass, window: int) -> str:
    import math

    most = window * (math.log2(window) - cls.bits) + 1e-9
    allow = " OR ".join(
        [f"regexp_matches(m, {_quoted(p)})" for p in secretscan.ALLOWED_PATTERNS]
        + [f"lower(m) IN ({', '.join(map(_quoted, secretscan.ALLOWED_TEXTS))})"]
    )
    body = "lower(m)" if cls.fold else "m"
    return f"""
{_located(f"cand{k}", cls.pattern)},
win{k} AS (
  SELECT doc_id, s, m, i, string_split(substr({body}, CAST(i AS INTEGER) + 1, {window}), '') AS w
  FROM (SELECT *, unnest(range(0, length(m) - {window} + 1)) AS i FROM cand{k} WHERE NOT ({allow}))
),
high{k} AS (
  SELECT doc_id, s, i FROM (
    SELECT doc_id, s, i, sum(c * log2(c)) AS t FROM (
      SELECT doc_id, s, i, ch, CAST(count(*) AS DOUBLE) AS c FROM (SELECT doc_id, s, i, unnest(w) AS ch FROM win{k}) GROUP BY ALL
    ) GROUP BY doc_id, s, i
  ) WHERE t <= {most!r}
),
run{k} AS (
  SELECT *, sum(CASE WHEN was IS NULL OR i > was + {window} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, s ORDER BY i) AS r
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id, s ORDER BY i) AS was FROM high{k})
),
span{k} AS (
  SELECT doc_id, s + min(i) AS s, s + max(i) + {window} AS e, {3 + k} AS k, '{cls.kind}' AS kind FROM run{k} GROUP BY doc_id, s, r
)"""


def secrets_sql() -> str:
    c = secretscan
    parts = [
        "doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)",
        _located("assign0", c.ASSIGN.replace("(?i:", "(?i:")),
        _located("access0", c.ACCESS),
        _located("hex0", "[0-9a-f]+"),
        f"""
base AS (
  SELECT doc_id, s, e, 0 AS k, 'assign' AS kind FROM assign0
  WHERE length(regexp_extract(m, {_quoted(c.ASSIGN_VALUE)}, 1)) >= {c.ASSIGN_CHARS}
  UNION ALL SELECT doc_id, s, e, 1, 'access' FROM access0 WHERE length(m) >= {c.ACCESS_CHARS}
  UNION ALL SELECT doc_id, s, e, 2, 'hex' FROM hex0 WHERE length(m) >= {c.HEX_CHARS}
)""",
        *[_entropy(k, cls, c.WINDOW) for k, cls in enumerate(c.CLASSES)],
        "spans AS (SELECT doc_id, s, e, k, kind FROM base "
        + " ".join(f"UNION ALL SELECT doc_id, s, e, k, kind FROM span{k}" for k in range(len(c.CLASSES)))
        + ")",
        """
listed AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ',' ORDER BY s, k, e) FILTER (k < 3) AS base,
         string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ',' ORDER BY s, k, e) AS spans
  FROM spans GROUP BY doc_id
)""",
    ]
    return (
        "WITH " + ",".join(parts) + "\nSELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, "
        "coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans "
        "FROM doc LEFT JOIN listed USING (doc_id)"
    )


def licenses_sql() -> str:
    def canonical(c: str) -> str:
        c = rf"regexp_replace(lower({c}), {_quoted(licenses.COPYRIGHT_LINE)}, '\1', 'g')"
        c = f"regexp_replace({c}, {_quoted(licenses.BETWEEN)}, ' ', 'g')"
        for odd, usual in licenses.SPELLINGS:
            c = rf"regexp_replace({c}, '\b{odd}\b', '{usual}', 'g')"
        return f"trim(regexp_replace({c}, ' +', ' ', 'g'), ' ')"

    known = ", ".join(f"({_quoted(d)}, {_quoted(n)})" for d, n in sorted(licenses.known_digests().items()))
    return rf"""
WITH known(digest, id) AS (VALUES {known}),
doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
unit AS (
  SELECT doc_id, 1 AS whole, text AS u FROM doc
  UNION ALL SELECT doc_id, 0, unnest(string_split_regex(text, '\n[ \t\r]*\n')) FROM doc
  UNION ALL SELECT doc_id, 0, unnest(string_split(text, chr(10))) FROM doc
),
found AS (SELECT doc_id, whole, digest, id FROM (SELECT doc_id, whole, sha256({canonical("u")}) AS digest FROM unit) JOIN known USING (digest)),
named AS (
  SELECT doc_id, max(CASE WHEN whole = 1 THEN id END) AS license_id, count(DISTINCT digest) FILTER (whole = 0) AS n_notices
  FROM found GROUP BY doc_id
),
listed AS (SELECT doc_id, string_agg(id, ',' ORDER BY id) AS notices FROM (SELECT DISTINCT doc_id, id FROM found) GROUP BY doc_id)
SELECT doc_id, license_id, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM doc LEFT JOIN named USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


_OP10 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (
  SELECT page_id, strlen(payload) AS n, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""

_OP12 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
word AS (SELECT d, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT lang, source, term, count(*) AS c FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
gtotal AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
ltotal AS (SELECT lang, sum(n) AS n FROM gtotal GROUP BY lang),
share AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1) // CAST(g.n + s.v AS HUGEINT) AS p
  FROM gtotal g JOIN kept k ON g.lang = k.lang JOIN size s ON g.lang = s.lang
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
whole AS (
  SELECT k.lang, k.term, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(sum(c.c), 0) + 1) // CAST(any_value(l.n + s.v) AS HUGEINT) AS q
  FROM kept k JOIN ltotal l ON k.lang = l.lang JOIN size s ON k.lang = s.lang LEFT JOIN cnt c ON c.lang = k.lang AND c.term = k.term
  GROUP BY k.lang, k.term
),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
term AS (
  SELECT s.lang, s.source, s.term AS item, (p - q) * (p - q) // q AS value
  FROM share s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE s.c > 0 AND p > q
),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""

SQL: dict[str, str] = {
    "op3_decontamination": _OP3.strip(),
    "op5_url_filter": _OP5.strip(),
    "op6_secrets": secrets_sql(),
    "op9_licenses": licenses_sql().strip(),
    "op10_warc": _OP10.strip(),
    "op12_source_divergence": _OP12.strip(),
}

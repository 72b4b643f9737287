"""The numbered operators that SQL can express, written once more as SQL."""

from __future__ import annotations

from wardlight.llm.license_texts import DIGESTS, SPELLINGS
from wardlight.llm.licenses import notices

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LINKS = f"""
    WITH RECURSIVE split AS (
        SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS gram
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i
              FROM split WHERE len(ws) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id),
    links AS (
        SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * c >= 90 * (p.n + q.n - c)),
    reach AS (
        SELECT doc_id AS root, doc_id AS node FROM documents
        UNION SELECT r.root, l.y FROM reach r JOIN links l ON l.x = r.node)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id
"""

_LINES = rf"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents),
    keyed AS (
        SELECT doc_id, line, place, {_LOWER.format(
            "regexp_replace(line, '^[" + chr(92) + "x20" + chr(92) + "x09-" + chr(92) + "x0D]+|["
            + chr(92) + "x20" + chr(92) + "x09-" + chr(92) + "x0D]+$', '', 'g')")} AS key
        FROM lines),
    owners AS (
        SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) > 1)
    SELECT k.doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE o.owner <> k.doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                           FILTER (WHERE o.owner IS NULL OR o.owner = k.doc_id), ''))
               AS kept_sha256
    FROM keyed k LEFT JOIN owners o ON o.key = k.key
    GROUP BY k.doc_id
"""

_NEAREST = """
    WITH parts AS (
        SELECT vec_id, unnest(embedding)::DOUBLE AS x,
               generate_subscripts(embedding, 1) AS d FROM embeddings),
    good AS (
        SELECT vec_id FROM parts GROUP BY vec_id
        HAVING count(*) = count(x) AND bool_and(isfinite(x))),
    grid AS (
        SELECT vec_id, d, floor(64 * x)::BIGINT AS v FROM parts SEMI JOIN good USING (vec_id)),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, sum(q.v * c.v)::BIGINT AS score
        FROM grid q JOIN grid c ON c.d = q.d AND c.vec_id <> q.vec_id
        WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, c.vec_id),
    ranked AS (
        SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER
               AS rank FROM scores)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _canonical(line: str) -> str:
    text = rf"' ' || trim(regexp_replace(lower({line}), '[^\p{{L}}\p{{N}}]+', '  ', 'g')) || ' '"
    for old, new in SPELLINGS.items():
        text = f"replace({text}, ' {old} ', ' {new} ')"
    gone = r"^[^\p{L}\p{N}(©]*(copyright|\(c\)|©|all rights reserved)"
    clause = (r"^[^\p{L}\p{N}(©]*copyright[^\p{L}\p{N}]+(notice|notices|holder|holders|owner|owners|law|laws|license|"
              r"licenses|licence|statement|statements|interest|interests|and|or|in|to|is|act|treaty|protection|"
              r"claims|infringement|disclaimer|permission)([^\p{L}\p{N}]|$)")
    return (f"CASE WHEN regexp_matches(lower({line}), '{gone}') AND NOT regexp_matches(lower({line}), '{clause}') "
            f"THEN '' ELSE trim({text}) END")


def _licenses() -> str:
    known = ", ".join(f"({i}, {_quoted(spdx)}, {_quoted(text)})"
                      for i, (spdx, text) in enumerate(notices()))
    digests = ", ".join(f"({_quoted(spdx)}, {_quoted(digest)})" for spdx, digest in DIGESTS.items())
    return f"""
    WITH sources AS (
        SELECT doc_id AS id, NULL AS spdx, coalesce(text, '') AS body FROM documents
        UNION ALL SELECT -1 - n, spdx, body FROM (VALUES {known}) v(n, spdx, body)),
    raw AS (
        SELECT id, spdx, unnest(string_split(body, chr(10))) AS line,
               generate_subscripts(string_split(body, chr(10)), 1) AS place FROM sources),
    lines AS (
        SELECT * FROM (SELECT id, spdx, place, {_canonical('line')} AS line FROM raw)
        WHERE line <> ''),
    texts AS (
        SELECT id, spdx, string_agg(line, '  ' ORDER BY place) AS body FROM lines
        GROUP BY id, spdx),
    known AS (SELECT body, min(spdx) AS spdx FROM texts WHERE id < 0 GROUP BY body),
    hits AS (
        SELECT l.id, k.spdx, 1 AS in_line FROM lines l JOIN known k ON k.body = l.line
        WHERE l.id >= 0
        UNION ALL SELECT t.id, k.spdx, 0 FROM texts t JOIN known k ON k.body = t.body
        WHERE t.id >= 0
        UNION ALL SELECT t.id, k.spdx, 0 FROM texts t JOIN (VALUES {digests}) k(spdx, digest)
        ON k.digest = sha256(t.body) WHERE t.id >= 0),
    found AS (
        SELECT id, string_agg(DISTINCT spdx, ',' ORDER BY spdx) AS licenses,
               sum(in_line) AS n_notices, bool_or(in_line = 0) AS whole_text
        FROM hits GROUP BY id)
    SELECT d.doc_id, coalesce(f.licenses, '') AS licenses,
           coalesce(f.n_notices, 0)::BIGINT AS n_notices,
           coalesce(f.whole_text, false) AS whole_text
    FROM documents d LEFT JOIN found f ON f.id = d.doc_id
    """


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TERM = r"[\p{L}\p{N}]+"


def _found(table: str, keys: str, text: str, pattern: str, kind: str, order: int) -> str:
    """Matches with their places: lengths of matches and of what lies between, added up."""
    matches = f"regexp_extract_all({text}, '{pattern}')"
    return f"""
        SELECT {keys}, '{kind}' AS kind, {order} AS k, m,
               sum(length(g) + length(m)) OVER w - length(m) AS a,
               sum(length(g) + length(m)) OVER w AS b
        FROM (SELECT {keys}, unnest({matches}) AS m,
                     unnest(list_slice(string_split_regex({text}, '{pattern}'), 1,
                                       len({matches}))) AS g,
                     generate_subscripts({matches}, 1) AS i FROM {table})
        WINDOW w AS (PARTITION BY {keys} ORDER BY i)"""


def _valid_spans(table: str, keys: str, text: str) -> str:
    every = " UNION ALL ".join(_found(table, keys, text, pattern, kind, i)
                               for i, (kind, pattern) in enumerate(_PATTERNS.items()))
    return f"""
        SELECT * FROM (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM ({every}))
        WHERE CASE kind
            WHEN 'ip' THEN list_max(list_transform(string_split(m, '.'),
                                                   lambda x: x::HUGEINT)) <= 255
            WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(
                list_reverse(string_split(digits, '')), lambda c, i: CASE WHEN i % 2 = 1
                THEN c::INTEGER ELSE c::INTEGER * 2 - CASE WHEN c::INTEGER > 4 THEN 9 ELSE 0 END
                END)) % 10 = 0
            WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
            ELSE true END"""


def _bare(line: str) -> str:
    for pattern in _PATTERNS.values():
        line = f"regexp_replace({line}, '{pattern}', ' ', 'g')"
    return line


_PRIVACY = f"""
    WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    lines AS (
        SELECT doc_id, unnest(string_split(body, chr(10))) AS line,
               generate_subscripts(string_split(body, chr(10)), 1) AS place FROM bodies),
    entities AS (
        SELECT DISTINCT doc_id, place, kind || ':' || lower(m) AS entity
        FROM ({_valid_spans("lines", "doc_id, place", "line")})),
    terms AS (
        SELECT DISTINCT doc_id, place, term FROM (
            SELECT doc_id, place, unnest(regexp_extract_all(lower(line), '{_TERM}')) AS term
            FROM lines)),
    near AS (
        SELECT DISTINCT doc_id, place, line, term FROM (
            SELECT l.doc_id, l.place, l.line,
                   unnest(regexp_extract_all(lower({_bare("l.line")}), '{_TERM}')) AS term
            FROM lines l SEMI JOIN entities e ON e.doc_id = l.doc_id AND e.place = l.place)),
    pairs AS (
        SELECT DISTINCT entity, line, term FROM near n
        JOIN entities e ON e.doc_id = n.doc_id AND e.place = n.place),
    spread AS (SELECT entity, count(DISTINCT line) AS n_lines FROM pairs GROUP BY entity),
    common AS (
        SELECT p.entity, p.term FROM pairs p JOIN spread s ON s.entity = p.entity
        GROUP BY p.entity, p.term, s.n_lines HAVING 2 * count(*) > s.n_lines),
    held AS (
        SELECT p.entity, p.line, 100 * count(c.term) >= 80 * count(*) AS copied
        FROM pairs p LEFT JOIN common c ON c.entity = p.entity AND c.term = p.term
        GROUP BY p.entity, p.line),
    contexts AS (
        SELECT p.entity, p.term, count(*) FILTER (WHERE NOT copied) + max(copied::INTEGER) AS contexts
        FROM pairs p JOIN held h ON h.entity = p.entity AND h.line = p.line GROUP BY p.entity, p.term),
    met AS (
        SELECT e.entity, n.term, count(*) AS n_both FROM near n
        JOIN entities e ON e.doc_id = n.doc_id AND e.place = n.place
        JOIN contexts c ON c.entity = e.entity AND c.term = n.term AND c.contexts >= 2
        GROUP BY e.entity, n.term),
    shares AS (
        SELECT m.entity, m.term, ln(n_both * total::DOUBLE / (n_term * n_entity))
               / ln(total::DOUBLE / n_entity) AS share
        FROM met m
        JOIN (SELECT entity, count(*) AS n_entity FROM entities GROUP BY entity) e
            ON e.entity = m.entity
        JOIN (SELECT term, count(*) AS n_term FROM terms GROUP BY term) t ON t.term = m.term,
        (SELECT count(*) AS total FROM lines) WHERE total > n_entity),
    telling AS (SELECT DISTINCT term FROM shares WHERE share >= 0.8),
    told AS (
        SELECT b.doc_id, b.body FROM bodies b
        SEMI JOIN (SELECT t.doc_id FROM terms t JOIN telling g ON g.term = t.term) h
            ON h.doc_id = b.doc_id),
    base AS ({_valid_spans("bodies", "doc_id", "body")}),
    more AS (
        SELECT w.* FROM ({_found("told", "doc_id", "body", _TERM, "term", 4)}) w
        JOIN telling g ON g.term = lower(w.m)
        WHERE NOT EXISTS (SELECT 1 FROM base p
                          WHERE p.doc_id = w.doc_id AND p.a < w.b AND w.a < p.b)),
    spans AS (
        SELECT doc_id, kind, k, a, kind || ':' || a::BIGINT || ':' || b::BIGINT AS span FROM base
        UNION ALL SELECT doc_id, kind, k, a, kind || ':' || a::BIGINT || ':' || b::BIGINT FROM more)
    SELECT d.doc_id, count(*) FILTER (WHERE kind = 'email') AS n_email,
           count(*) FILTER (WHERE kind = 'ip') AS n_ip,
           count(*) FILTER (WHERE kind = 'card') AS n_card,
           count(*) FILTER (WHERE kind = 'phone') AS n_phone,
           sha256(coalesce(string_agg(span, ',' ORDER BY k, a) FILTER (WHERE k < 4), ''))
               AS base_sha256,
           coalesce(string_agg(span, ',' ORDER BY k, a), '') AS spans,
           count(*) FILTER (WHERE kind = 'term') AS n_term
    FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


_DIVERGENCE = rf"""
    WITH listed AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all({_LOWER.format("coalesce(text, '')")},
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    counts AS (
        SELECT lang, source, term, sum(n) AS n, count(*) AS docs
        FROM (SELECT lang, source, row, term, count(*) AS n
              FROM (SELECT lang, source, row, unnest(terms) AS term
                    FROM (SELECT *, row_number() OVER () AS row FROM listed))
              GROUP BY lang, source, row, term)
        GROUP BY lang, source, term),
    kept AS (
        SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY lang, term HAVING sum(docs) >= 10),
    langs AS (
        SELECT g.lang, count(k.term) AS v, coalesce(sum(lang_n), 0) AS lang_total
        FROM (SELECT DISTINCT lang FROM listed) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
    groups AS (
        SELECT g.lang, g.source, l.v, l.lang_total, coalesce(sum(c.n), 0) AS total
        FROM (SELECT DISTINCT lang, source FROM listed) g JOIN langs l ON l.lang = g.lang
        LEFT JOIN (SELECT c.* FROM counts c JOIN kept k ON k.lang = c.lang AND k.term = c.term) c
            ON c.lang = g.lang AND c.source = g.source
        GROUP BY g.lang, g.source, l.v, l.lang_total),
    shares AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
               1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 2)) // (g.total + 2 * g.v) AS p,
               1 + (1000000000 * (k.lang_n::HUGEINT + 2)) // (g.lang_total + 2 * g.v) AS q
        FROM groups g JOIN kept k ON k.lang = g.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source),
    items AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q)
        FROM shares WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
          FROM items)
    WHERE part = 'pair' OR rank <= 10
"""

_CLUSTER_ROUND = """
    assigned{0} AS MATERIALIZED (
        SELECT row, c, d2 FROM (
            SELECT p.row, m.c, sum((p.x - m.x) * (p.x - m.x)) AS d2,
                   row_number() OVER (PARTITION BY p.row
                                      ORDER BY sum((p.x - m.x) * (p.x - m.x)), m.c) AS place
            FROM parts p JOIN centroids{0} m ON m.i = p.i GROUP BY p.row, m.c)
        WHERE place = 1),"""

_CLUSTER_MOVE = """
    sums{1} AS MATERIALIZED (
        SELECT a.c, p.i, sum(p.x) AS s, count(*)::HUGEINT AS n
        FROM assigned{0} a JOIN parts p ON p.row = a.row GROUP BY a.c, p.i),
    centroids{1} AS MATERIALIZED (
        SELECT m.c, m.i, CASE WHEN t.n IS NULL THEN m.x
                              ELSE (t.s - ((t.s % t.n) + t.n) % t.n) // t.n END AS x
        FROM centroids{0} m LEFT JOIN sums{1} t ON t.c = m.c AND t.i = m.i),"""


def _clusters(rounds: int = 10) -> str:
    steps = "".join(_CLUSTER_ROUND.format(r) + _CLUSTER_MOVE.format(r, r + 1) for r in range(rounds))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, embedding, row_number() OVER () AS row FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT row, i, floor(1024 * embedding[i]::DOUBLE)::HUGEINT AS x
        FROM kept, (SELECT unnest(range(1, 65)) AS i)),
    seeds AS MATERIALIZED (
        SELECT row, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, embedding) - 1 AS c
        FROM kept),
    centroids0 AS MATERIALIZED (
        SELECT s.c, p.i, p.x FROM seeds s JOIN parts p ON p.row = s.row WHERE s.c < 8),
    {steps}
    {_CLUSTER_ROUND.format(rounds)}
    marks AS (
        SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256
        FROM centroids{rounds} GROUP BY c)
    SELECT k.vec_id, a.c::INTEGER AS cluster, a.d2::BIGINT AS distance,
           (sum(a.d2) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
           (sum(a.d2) OVER ())::BIGINT AS inertia, m.centroid_sha256
    FROM assigned{rounds} a JOIN kept k ON k.row = a.row JOIN marks m ON m.c = a.c
"""


ORACLES: dict[str, str] = {
    "op1_similar_documents": _LINKS,
    "op2_repeated_lines": _LINES,
    "op4_personal_data": _PRIVACY,
    "op7_nearest_vectors": _NEAREST,
    "op9_licenses": _licenses(),
    "op11_source_divergence": _DIVERGENCE,
    "op13_centroid_clusters": _clusters(),
}

"""DuckDB statements for the operators that SQL can express exactly."""

from __future__ import annotations

from tidewater.llm import merkle, secret_scan, vector_codes

SORTED_PROJECTIONS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), r AS (
  SELECT vec_id, vec_id AS reach FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.reach
), c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links,
       CAST(c.component_id AS BIGINT) AS component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.a = c.vec_id
"""


def vector_code_sql() -> str:
    """The rounds written out, one distance table a round."""
    v = vector_codes
    steps = [
        f"""x AS MATERIALIZED (
  SELECT row, vec_id, label, (d - 1) // w AS part, (d - 1) % w AS place, CAST(floor({v.SCALE}::DOUBLE * e[d]) AS BIGINT) AS x
  FROM (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, embedding AS e, len(embedding) // {v.PARTS} AS w,
               unnest(generate_series(1, len(embedding))) AS d
        FROM embeddings
        WHERE len(embedding) = list_count(embedding) AND list_max(embedding) < 'infinity' AND list_min(embedding) > '-infinity')
)""",
        f"b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, place, x FROM x WHERE row <= {v.ENTRIES})",
    ]
    for k in range(v.ROUNDS + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
  SELECT row, part, min(dist * {v.ENTRIES} + entry) AS best FROM (
    SELECT x.row, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x)) AS dist
    FROM x JOIN b{k} b ON b.part = x.part AND b.place = x.place GROUP BY x.row, x.part, b.entry) AS distances
  GROUP BY row, part
)"""
        )
        if k < v.ROUNDS:
            steps.append(
                f"""b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.x) AS x
  FROM b{k} b LEFT JOIN (
    SELECT x.part, a.best % {v.ENTRIES} AS entry, x.place, CAST(sum(x.x) AS BIGINT) AS s, count(*) AS n
    FROM x JOIN a{k} a ON a.row = x.row AND a.part = x.part GROUP BY 1, 2, 3) AS m
  ON m.part = b.part AND m.entry = b.entry AND m.place = b.place
)"""
            )
    last = v.ROUNDS
    return f"""
WITH {", ".join(steps)},
o AS (
  SELECT row, string_agg(printf('%02x', CAST(best % {v.ENTRIES} AS INTEGER)), '' ORDER BY part) AS code,
         CAST(sum(best // {v.ENTRIES}) AS BIGINT) AS error
  FROM a{last} GROUP BY row
), h AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS sha FROM b{last}),
v AS (SELECT DISTINCT row, vec_id, label FROM x)
SELECT v.vec_id AS vec_id, o.code AS code, o.error AS error,
       CAST(sum(o.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, h.sha AS codebooks_sha256
FROM v JOIN o ON o.row = v.row CROSS JOIN h
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def merkle_sql() -> str:
    """Trees level by level; a path's siblings by the last bit of the place."""
    original = " || ".join(_field(f"d.{f}") for f in merkle.FIELDS)
    changed = " || ".join(_field("d.n_chars + 1" if f == "n_chars" else f"d.{f}") for f in merkle.FIELDS)
    digest = "sha256(string_agg(h, '' ORDER BY i))"
    return f"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT i, i, 0 FROM range(256) AS r(i)
  UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
crc(doc_id, s, pos, c) AS (
  SELECT doc_id, s, 0, 4294967295 FROM ids
  UNION ALL
  SELECT crc.doc_id, crc.s, crc.pos + 1, xor(crc.c >> 8, bits.c)
  FROM crc JOIN bits ON bits.k = 8 AND bits.n = xor(crc.c, ascii(substr(crc.s, crc.pos + 1, 1))::BIGINT) % 256
  WHERE crc.pos < strlen(crc.s)
), hit AS (SELECT doc_id FROM crc WHERE pos = strlen(s) AND xor(c, 4294967295) % 7 = 0),
leaves AS MATERIALIZED (
  SELECT d.doc_id, d.lang, sha256({original}) AS h, CASE WHEN hit.doc_id IS NOT NULL THEN sha256({changed}) END AS changed
  FROM documents d LEFT JOIN hit ON hit.doc_id = d.doc_id
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, h FROM placed
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, {digest} FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n
), subroots AS (
  SELECT lang, level AS levels, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), top(level, i, n, h) AS (
  SELECT 0, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, {digest} FROM top WHERE n > 1 GROUP BY level, i // 2, n
), root AS (SELECT h FROM top WHERE n = 1),
steps AS MATERIALIZED (
  SELECT p.doc_id, p.h AS leaf, p.lang, p.i AS place, a.level, (p.i >> a.level) % 2 = 1 AS left, s.h AS sibling
  FROM placed p JOIN nodes a ON a.lang IS NOT DISTINCT FROM p.lang AND a.i = p.i >> a.level AND a.n > 1
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = a.level AND s.i = xor(a.i, 1)
  UNION ALL
  SELECT p.doc_id, p.h, p.lang, p.i, r.levels + a.level, (r.i >> a.level) % 2 = 1, s.h
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  JOIN top a ON a.i = r.i >> a.level AND a.n > 1 LEFT JOIN top s ON s.level = a.level AND s.i = xor(a.i, 1)
), proofs AS (
  SELECT lang, place, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof FROM steps GROUP BY lang, place
), folded(lang, place, level, h) AS (
  SELECT lang, i, 0, coalesce(changed, h) FROM placed
  UNION ALL
  SELECT f.lang, f.place, f.level + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.h WHEN s.left THEN s.sibling || f.h ELSE f.h || s.sibling END)
  FROM folded f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.place = f.place AND s.level = f.level
), ends AS (SELECT lang, place, arg_max(h, level) AS h FROM folded GROUP BY lang, place)
SELECT p.doc_id AS doc_id, p.h AS leaf, r.h AS subroot, root.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       e.h AS folded_root, e.h = root.h AS verified
FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN root
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.place = p.i
JOIN ends e ON e.lang IS NOT DISTINCT FROM p.lang AND e.place = p.i
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def secret_scan_sql() -> str:
    """Matches are placed by the lengths of the pieces between them; windows
    are counted one by one."""
    s = secret_scan
    shapes = [("assign", s.ASSIGN), ("access", s.ACCESS), ("hex", s.HEX)]
    runs = [(kind, f"{s.char_class(cs)}{{{w},}}") for kind, cs, w, _ in s.CLASSES]
    found = " UNION ALL ".join(
        f"""SELECT row, {i} AS rank, '{kind}' AS kind, m, v, CAST(sum(len(r) + len(m)) OVER (PARTITION BY row ORDER BY k) AS INTEGER) - len(m) AS start
FROM (SELECT row, unnest(regexp_extract_all(text, {_text(p)})) AS m, unnest(regexp_extract_all(text, {_text(p)}, {2 if kind == "assign" else 0})) AS v,
             unnest(string_split_regex(text, {_text(p)})) AS r, generate_subscripts(string_split_regex(text, {_text(p)}), 1) AS k FROM d) AS t
WHERE m IS NOT NULL"""
        for i, (kind, p) in enumerate(shapes + runs)
    )
    weights = " ".join(f"WHEN {c} THEN {s.weight(c)}" for c in range(max(w for _, _, w, _ in s.CLASSES) + 1))
    width = " ".join(f"WHEN '{kind}' THEN {w}" for kind, _, w, _ in s.CLASSES)
    most = " ".join(f"WHEN '{kind}' THEN {s.most_weight(w, bits)}" for kind, _, w, bits in s.CLASSES)
    harmless = " OR ".join(f"regexp_matches(m, {_text(p)})" for p in s.ALLOW)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS MATERIALIZED ({found}),
base AS MATERIALIZED (SELECT row, rank, kind, start, start + len(m) AS stop FROM found WHERE rank < 3 AND (rank > 0 OR len(v) >= {s.LEAST_VALUE})),
windows AS (
  SELECT row, rank, kind, start, m, w, unnest(generate_series(0, len(m) - w)) AS a
  FROM (SELECT *, CASE kind {width} END AS w FROM found WHERE rank >= 3 AND NOT ({harmless})) AS t
), counts AS (
  SELECT row, rank, kind, start, w, a, c, count(*) AS n
  FROM (SELECT row, rank, kind, start, w, a, substr(m, a + unnest(generate_series(1, w)), 1) AS c FROM windows) AS t
  GROUP BY row, rank, kind, start, w, a, c
), hot AS (
  SELECT row, rank, kind, start, w, a FROM counts GROUP BY row, rank, kind, start, w, a
  HAVING sum(CASE n {weights} END) <= CASE kind {most} END
), islands AS (
  SELECT *, sum(new) OVER (PARTITION BY row, rank, start ORDER BY a) AS island
  FROM (SELECT *, CASE WHEN a <= lag(a) OVER (PARTITION BY row, rank, start ORDER BY a) + w THEN 0 ELSE 1 END AS new FROM hot) AS t
), more AS (
  SELECT row, rank, kind, start + min(a) AS start, start + max(a) + min(w) AS stop FROM islands GROUP BY row, rank, kind, start, island
), spans AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM more m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = m.row AND b.start <= m.start AND m.stop <= b.stop)
), lists AS (
  SELECT row, count(*) FILTER (rank = 0) AS n0, count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every
  FROM spans GROUP BY row
)
SELECT d.doc_id AS doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN lists ON lists.row = d.row
"""

"""DuckDB SQL of the queries whose statements are built from repeated steps."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: The table of CRC-32, one entry a byte value, as a one-row relation ``c32(t)``.
CRC_TABLE = """c32 AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b,
  list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
  FROM range(0, 256) r(b)))"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, with the column ``t`` of ``c32`` in scope."""
    return (f"xor(4294967295::BIGINT, list_reduce(list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT), "
            f"lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT))")


def _merkle(fields: tuple[str, ...], fanout: int = 16, levels: int = 7) -> str:
    """Trees of up to ``fanout ** levels`` leaves, built level by level from the leaves up; proofs folded likewise."""
    part = "coalesce(octet_length(encode({0}))::VARCHAR || ':' || {0}, '-')"
    leaf = " || ".join(part.format(f"{c}::VARCHAR") for c in fields)
    claim = " || ".join(part.format(f"translate(text, {_AZ})" if c == "text" else f"{c}::VARCHAR") for c in fields)
    steps = [CRC_TABLE, f"""d AS (SELECT doc_id, source, sha256({leaf}) AS leaf,
  CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({claim}) ELSE sha256({leaf}) END AS claim FROM documents, c32)""",
             """r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k,
  count(*) OVER (PARTITION BY source) AS n FROM d)"""]

    def grow(name: str) -> None:
        for i in range(levels):
            steps.append(f"""{name}s{i} AS (SELECT g, k,
  CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (PARTITION BY g, k // {fanout} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS b,
  CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (PARTITION BY g, k // {fanout} ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS a
  FROM {name}{i})""")
            steps.append(f"""{name}{i + 1} AS (SELECT g, k // {fanout} AS k, (max(n) + {fanout - 1}) // {fanout} AS n,
  CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY k)) ELSE max(d) END AS d FROM {name}{i} GROUP BY g, k // {fanout})""")

    steps.append("n0 AS (SELECT source AS g, k, n, leaf AS d FROM r)")
    grow("n")
    steps.append(f"""u AS (SELECT g AS source, d AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS top,
  count(*) OVER () AS tops FROM n{levels})""")
    steps.append("t0 AS (SELECT 0 AS g, top AS k, tops AS n, subroot AS d FROM u)")
    grow("t")
    steps.append("""f0 AS (SELECT r.doc_id, r.source, r.k, r.leaf, u.subroot, u.top, '' AS proof, r.claim AS node
  FROM r JOIN u ON r.source IS NOT DISTINCT FROM u.source)""")
    last = 0
    for name, key, group in (("n", "f.k", "f.source"), ("t", "f.top", "0")):
        for i in range(levels):
            steps.append(f"""f{last + 1} AS (SELECT f.doc_id, f.source, f.k, f.leaf, f.subroot, f.top,
  proof || coalesce(s.b || s.a, '') AS proof, CASE WHEN s.b IS NULL THEN node ELSE sha256(s.b || node || s.a) END AS node
  FROM f{last} f JOIN {name}s{i} s ON s.g IS NOT DISTINCT FROM {group} AND s.k = {key} // {fanout ** i})""")
            last += 1
    return "WITH " + ",\n".join(steps) + f"""
SELECT f.doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = t.d AS verified
FROM f{last} f, t{levels} t"""


OP11 = _merkle(("doc_id", "source", "lang", "n_chars", "text"))

#: Every node is charged to all prefixes of its smallest member, so no step goes level by level.
OP13 = f"""
WITH {CRC_TABLE},
o AS (SELECT conv_id AS c, octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS v,
    length(coalesce(text, '')) AS chars, turn FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, sha256(v) AS v, chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(v)) AS k FROM o),
h AS (SELECT c, c - c % 100 AS base, {crc32("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM t), c32),
r AS (SELECT h.c, t.k, t.v, t.chars FROM h JOIN t ON t.c = h.base AND t.k <= h.h
      UNION ALL
      SELECT h.c, t.k - h.h + (SELECT count(*) FROM t b WHERE b.c = h.base AND b.k <= h.h), t.v, t.chars
      FROM h JOIN t ON t.c = h.c AND t.k > h.h),
p AS (SELECT c, k AS d, sha256(string_agg(v, '' ORDER BY k) OVER (PARTITION BY c ORDER BY k)) AS key, chars FROM r
      UNION ALL SELECT c, 0, '', 0 FROM h),
n AS (SELECT key, d, min(c) AS c, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY key, d),
up AS (SELECT n.key, n.c, n.d, q.key AS parent FROM n JOIN p q ON q.c = n.c AND q.d = n.d - 1),
ch AS (SELECT parent AS key, count(*) AS n_children FROM up GROUP BY parent),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (key)),
s AS (SELECT a.key, count(*) FILTER (w.n_children = 0) AS n_leaves, sum((w.n_convs - 1) * w.chars) AS saved
      FROM w JOIN p a ON a.c = w.c AND a.d <= w.d GROUP BY a.key),
e AS (SELECT key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
      FROM (SELECT c, max(d) AS d FROM p GROUP BY c) JOIN p USING (c, d) GROUP BY key)
SELECT w.c AS conv_id, w.d::BIGINT AS depth, pn.c AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
  s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM w JOIN s USING (key) LEFT JOIN e USING (key) LEFT JOIN up ON up.key = w.key LEFT JOIN n pn ON pn.key = up.parent
"""

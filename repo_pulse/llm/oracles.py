"""SQL for the operators that can be said in it."""

from __future__ import annotations

DUPLICATES = """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""


def _clusters(clusters: int, rounds: int) -> str:
    """Rounds of assignment (a0, a1, ...) and centroids (c0, c1, ...), one after the other."""
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, q) - 1 AS INTEGER) AS c, q AS m
  FROM (SELECT sha256('2:' || vec_id) AS h, q FROM v ORDER BY h, q LIMIT {clusters})
)""",
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (
  SELECT r, min(vec_id) AS vec_id, min(struct_pack(d := d, c := c)) AS best
  FROM (
    SELECT r, vec_id, c, CAST(list_sum(list_transform(
             list_zip(q, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{n}
  )
  GROUP BY r
)"""
        )
        if n < rounds:
            parts.append(
                f"""s{n} AS (
  SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{n} JOIN v USING (r))
  GROUP BY c, i
),
c{n + 1} AS MATERIALIZED (
  SELECT c, coalesce(new.m, old.m) AS m
  FROM c{n} old LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{n} GROUP BY c
  ) new USING (c)
)"""
            )
    last = f"a{rounds}"
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, best.c AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} ON c{rounds}.c = best.c"""
    )


CLUSTERS = _clusters(40, 5)

# A state is the least text of cost (ten digits) and audit that leads to it, null if none does:
# z nothing read, y after a system turn, u after a user, a after an assistant. A text of cost and
# audit orders like the pair.
_ADDED = "lpad(CAST(CAST(left({state}, 10) AS INTEGER) + {cost} AS VARCHAR), 10, '0') || substr({state}, 11) || '{edit}'"


def _then(state: str, cost: str, edit: str) -> str:
    return _ADDED.format(state=state, cost=cost, edit=edit)


_DELETED = {s: _then(s, "2", "D") for s in "zyua"}
_KEPT = {s: _then(s, "stays", "K") for s in "zyua"}
_REROLED = {s: _then(s, "stays + 1", "R") for s in "zyua"}

CONVERSATIONS = f"""WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)),
    lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t
),
given AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations
),
hashed AS (
  SELECT given.*, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(place, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda h, b: xor(h >> 8, t[CAST(xor(h, b) & 255 AS BIGINT) + 1]))) % 20 AS damage
  FROM given, crc_table
),
rows AS (
  SELECT conv_id, turn, r, copy, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN damage = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed)
  WHERE damage <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, r, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut
  FROM rows
),
faulty AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN cut = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated'
              ELSE '' END AS fault
  FROM placed
),
faults AS MATERIALIZED (
  SELECT *, fault IN ('blank', 'duplicate') AS must_go,
         CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS stays,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM faulty
),
counted AS (
  SELECT conv_id,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n
  FROM faults GROUP BY conv_id
),
states AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '0000000000' AS z, CAST(NULL AS VARCHAR) AS y,
         '0000000005I' AS u, '0000000010II' AS a
  FROM counted
  UNION ALL
  SELECT conv_id, i, z, y, least(u, {_then("z", "5", "I")}, {_then("y", "5", "I")}, {_then("a", "5", "I")}),
         least(a, {_then(f"least(u, {_then('z', '5', 'I')}, {_then('y', '5', 'I')})", "5", "I")})
  FROM (
    SELECT s.conv_id, f.i AS i, {_DELETED["z"]} AS z,
           least({_DELETED["y"]}, CASE WHEN NOT must_go AND initial = 's' THEN {_KEPT["z"]} END) AS y,
           least({_DELETED["u"]},
                 CASE WHEN NOT must_go AND initial = 'u' THEN least({_KEPT["z"]}, {_KEPT["y"]}, {_KEPT["a"]}) END,
                 CASE WHEN NOT must_go THEN least({_REROLED["z"]}, {_REROLED["y"]}, {_REROLED["a"]}) END) AS u,
           least({_DELETED["a"]},
                 CASE WHEN NOT must_go AND initial = 'a' THEN {_KEPT["u"]} END,
                 CASE WHEN NOT must_go THEN {_REROLED["u"]} END) AS a
    FROM states s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1
  ) q(conv_id, i, z, y, u, a)
),
repairs AS (
  SELECT c.*, CAST(left(least(z, a), 10) AS BIGINT) AS cost, substr(least(z, a), 11) AS audit
  FROM counted c JOIN states s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n
),
steps AS MATERIALIZED (
  SELECT *, sum(CAST(edit <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY p) AS i
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS p
        FROM repairs)
),
left_over AS (
  SELECT s.conv_id, row_number() OVER (PARTITION BY s.conv_id ORDER BY p) AS k, edit,
         CASE WHEN edit <> 'I' THEN f.role END AS role, CASE WHEN edit <> 'I' THEN f.text ELSE '' END AS text
  FROM steps s LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i
  WHERE edit IN ('K', 'R', 'I')
),
shifted AS (
  SELECT *, max(CASE WHEN edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS system
  FROM left_over
),
texts AS (
  SELECT conv_id, string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (k - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY k) AS whole
  FROM shifted GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN repairs r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id"""

"""SQL pieces shared by the check queries."""

from __future__ import annotations

from vecquery.functions.text import WHITESPACE

DOT = "list_reduce(list_transform(list_zip({a}, {b}), lambda z: z[1]*z[2]), lambda p, r: p+r)"
NORM = "sqrt(list_reduce(list_transform({v}, lambda x: x::DOUBLE*x::DOUBLE), lambda p, r: p+r))"


def dot(a: str, b: str) -> str:
    return DOT.format(a=a, b=b)


def norm(v: str) -> str:
    return NORM.format(v=v)


def unit(v: str, n: str) -> str:
    """Stored form: divided by the norm, kept as 4-byte floats."""
    return (
        f"list_transform({v}, lambda x: (x::DOUBLE / CASE WHEN {n} = 0 THEN 1 ELSE {n} END)::FLOAT::DOUBLE)"
    )


def query_unit(v: str, n: str) -> str:
    return f"list_transform({v}, lambda x: x::DOUBLE / ({n} + 1e-10))"


def score(d: str) -> str:
    return f"round(greatest(0.0, least(1.0, {d} / 2 + 0.5)), 4)"


# stored vectors and the same vectors as queries
INDEX = f"""
n AS (SELECT vec_id, label, embedding, {norm('embedding')} AS nn FROM embeddings),
ix AS (SELECT vec_id, label, {unit('embedding', 'nn')} AS u FROM n),
q AS (SELECT vec_id AS query_id, {query_unit('embedding', 'nn')} AS v FROM n)
"""


def hashed(name: str, source: str, dim: int = 64) -> str:
    """CTEs ending in ``name(id, v)``: hashed word counts of ``source(id, text)``."""
    return f"""
{name}_t AS (SELECT id, unnest(list_filter(string_split_regex(text, '{WHITESPACE}'), lambda t: t <> '')) AS t
   FROM ({source})),
{name}_c AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dim} AS b, count(*) AS c
   FROM {name}_t GROUP BY ALL),
{name} AS (SELECT s.id, list(coalesce(c, 0)::DOUBLE ORDER BY g.b) AS v
   FROM ({source}) s CROSS JOIN (SELECT unnest(range({dim})) AS b) g
   LEFT JOIN {name}_c USING (id, b) GROUP BY s.id)
"""


def top_k(pairs: str, k: int) -> str:
    """``pairs(query_id, vec_id, d)`` to ranked hits."""
    return f"""
SELECT query_id, rank, vec_id, {score('d')} AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d DESC, vec_id) AS rank FROM ({pairs}))
WHERE rank <= {k}"""

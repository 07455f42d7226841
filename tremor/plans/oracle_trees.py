"""DuckDB SQL that trains and applies the tree models, level by level.

Written from the rules stated in ``operators.trees``: split candidates from
ranks, bootstrap weights and feature subsets from sha256, exact sums, the best
split by whole-number scores.  The test tables stay below ``sample_rows``, so
all rows give candidates.
"""

from __future__ import annotations

import math

# Seed, trees, rounds, depth and bins as the models have them.
SEED, TREES, ROUNDS, DEPTH, BINS = 42, 20, 20, 5, 32
UNIT = 1000000000

_POISSON = [int(2**32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(16)]
_FLOOR = "((({s}) - ((({s}) % ({w})) + ({w})) % ({w})) // ({w}))"


def _floor(s: str, w: str) -> str:
    return _FLOOR.format(s=s, w=w)


def prepared(test: str) -> str:
    """``rows``: the training rows binned; ``ask``: the rows of the CTE ``test`` to predict, binned alike."""
    key = " || ':' || ".join(f"round({x} * 1000000e0)::BIGINT" for x in ("x1", "x2", "x3", "y"))
    below = lambda x, f: f"len(list_filter((SELECT xs FROM cuts WHERE f = {f}), lambda c: c < {x}))"
    return f""",
keyed AS MATERIALIZED (SELECT row_number() OVER () AS id, x1, x2, x3, round(y * {UNIT}e0)::BIGINT AS y, {key} AS key FROM train),
cuts AS MATERIALIZED (
  SELECT f, list(x ORDER BY x) AS xs FROM (
    SELECT f, x, c, sum(c) OVER (PARTITION BY f ORDER BY x) AS upto, sum(c) OVER (PARTITION BY f) AS n FROM (
      SELECT f, x, count(*) AS c FROM (
        SELECT 0 AS f, x1 AS x FROM keyed UNION ALL SELECT 1, x2 FROM keyed UNION ALL SELECT 2, x3 FROM keyed) GROUP BY ALL))
  WHERE upto < n AND upto * {BINS} // n > (upto - c) * {BINS} // n GROUP BY f),
rows AS MATERIALIZED (SELECT id, key, y, {below('x1', 0)} AS b0, {below('x2', 1)} AS b1, {below('x3', 2)} AS b2 FROM keyed),
ask AS MATERIALIZED (SELECT row_number() OVER () AS id, *, {below('x1', 0)} AS b0, {below('x2', 1)} AS b1, {below('x3', 2)} AS b2 FROM {test})"""


_BIN = "CASE {f} WHEN 0 THEN b0 WHEN 1 THEN b1 ELSE b2 END"


def _grown(name: str, start: str, subset: int, value: str) -> str:
    """CTEs ``{name}_split`` and ``{name}_leaf`` from ``start`` (tree, id, w, goal, b0, b1, b2)."""
    out = [f"{name}_a0 AS MATERIALIZED (SELECT *, 1 AS node FROM ({start}) WHERE w > 0)"]
    features = "(VALUES (0), (1), (2)) v(f)"
    if subset < 3:
        rank = f"row_number() OVER (PARTITION BY tree, node ORDER BY sha256('{SEED}:' || tree || ':' || node || ':' || f))"
        features = f"(SELECT tree, node, f FROM (SELECT tree, node, f, {rank} AS r FROM range({TREES}) t(tree), range(1, {2**DEPTH}) n(node), {features}) WHERE r <= {subset})"
    for d in range(DEPTH):
        on = "v ON v.tree = a.tree AND v.node = a.node" if subset < 3 else "ON true"
        out.append(f"""{name}_h{d} AS MATERIALIZED (
  SELECT a.tree, a.node, f, {_BIN.format(f='f')} AS b, sum(w)::HUGEINT AS w, sum(w * goal::HUGEINT)::HUGEINT AS s
  FROM {name}_a{d} a JOIN {features} {on} WHERE a.node >= {2**d} GROUP BY ALL)""")
        out.append(f"""{name}_s{d} AS MATERIALIZED (
  SELECT tree, node, f, b FROM (
    SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, f, b) AS r FROM (
      SELECT tree, node, f, b, ws, ss, sl * sl // wl + (ss - sl) * (ss - sl) // (ws - wl) AS score FROM (
        SELECT tree, node, f, b, sum(w) OVER u AS wl, sum(s) OVER u AS sl, sum(w) OVER (PARTITION BY tree, node, f) AS ws, sum(s) OVER (PARTITION BY tree, node, f) AS ss
        FROM {name}_h{d} WINDOW u AS (PARTITION BY tree, node, f ORDER BY b)) WHERE wl < ws))
  WHERE r = 1 AND score >= ss * ss // ws + 2)""")
        step = f"CASE WHEN s.f IS NULL THEN a.node WHEN {_BIN.format(f='s.f')} <= s.b THEN 2 * a.node ELSE 2 * a.node + 1 END"
        out.append(f"""{name}_a{d + 1} AS MATERIALIZED (
  SELECT a.* REPLACE ({step} AS node) FROM {name}_a{d} a LEFT JOIN {name}_s{d} s ON s.tree = a.tree AND s.node = a.node)""")
    splits = " UNION ALL ".join(f"SELECT * FROM {name}_s{d}" for d in range(DEPTH))
    out.append(f"{name}_split AS MATERIALIZED ({splits})")
    out.append(f"{name}_leaf AS MATERIALIZED (SELECT tree, node, {value} AS value FROM (SELECT tree, node, sum(w)::HUGEINT AS w, sum(w * goal::HUGEINT)::HUGEINT AS s FROM {name}_a{DEPTH} GROUP BY ALL))")
    return ",\n".join(out)


def _scored(name: str, rows: str) -> str:
    """``id, value``: the sum of the leaves that a row of ``rows`` falls into."""
    at = f"(SELECT r.id, r.b0, r.b1, r.b2, t.tree, 1 AS node FROM {rows} r, (SELECT DISTINCT tree FROM {name}_leaf) t)"
    for _ in range(DEPTH):
        step = f"CASE WHEN s.f IS NULL THEN a.node WHEN {_BIN.format(f='s.f')} <= s.b THEN 2 * a.node ELSE 2 * a.node + 1 END"
        at = f"(SELECT a.* REPLACE ({step} AS node) FROM {at} a LEFT JOIN {name}_split s ON s.tree = a.tree AND s.node = a.node)"
    return f"SELECT a.id, sum(l.value)::BIGINT AS value FROM {at} a LEFT JOIN {name}_leaf l ON l.tree = a.tree AND l.node = a.node GROUP BY a.id"


def forest(name: str = "rf") -> str:
    """CTE ``{name}_pred (id, p)`` of a random forest over ``ask``."""
    number = f"('0x' || substr(sha256('{SEED}:' || (tree // 8) || ':' || key), 8 * (tree % 8) + 1, 8))::BIGINT"
    weight = " + ".join(f"(u >= {s})::INTEGER" for s in _POISSON if s < 2**32)
    start = f"SELECT tree, id, ({weight}) AS w, y AS goal, b0, b1, b2 FROM (SELECT *, {number} AS u FROM rows, range({TREES}) t(tree))"
    return f"""{_grown(name, start, 1, 's // w')},
{name}_pred AS MATERIALIZED (SELECT id, coalesce(value, 0)::DOUBLE / {TREES * UNIT}e0 AS p FROM ({_scored(name, 'ask')}))"""


def single(name: str = "dt") -> str:
    return f"""{_grown(name, 'SELECT 0 AS tree, id, 1 AS w, y AS goal, b0, b1, b2 FROM rows', 3, 's // w')},
{name}_pred AS MATERIALIZED (SELECT id, value::DOUBLE / {UNIT}e0 AS p FROM ({_scored(name, 'ask')}))"""


def boosted(name: str = "gb") -> str:
    out, left, total = [], "rows", []
    for r in range(ROUNDS):
        one = f"{name}{r}"
        goal = "y" if r == 0 else "2 * y"
        value = "s // w" if r == 0 else _floor(_floor("s", "w"), "10")
        out.append(_grown(one, f"SELECT 0 AS tree, id, 1 AS w, {goal} AS goal, b0, b1, b2 FROM {left}", 3, value))
        if r + 1 < ROUNDS:
            out.append(f"{one}_left AS MATERIALIZED (SELECT r.id, r.b0, r.b1, r.b2, (r.y - v.value)::BIGINT AS y FROM {left} r JOIN ({_scored(one, left)}) v USING (id))")
            left = f"{one}_left"
        total.append(f"SELECT id, value FROM ({_scored(one, 'ask')})")
    out.append(f"{name}_pred AS MATERIALIZED (SELECT id, sum(value)::DOUBLE / {UNIT}e0 AS p FROM ({' UNION ALL '.join(total)}) GROUP BY id)")
    return ",\n".join(out)

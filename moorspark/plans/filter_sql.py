"""SQL text of the zero-phase recursion: one row per sample and pass, the states of the sections as columns."""

from __future__ import annotations

import math

from moorspark.operators.filters import butterworth, pad_length

_NAMES = ("b0", "b1", "b2", "a1", "a2")


def constant(order: int, kind: str, fs: float, fc) -> list[tuple[str, ...]]:
    """Coefficients as numbers, for one sampling rate."""
    return [tuple(f"CAST({float(s[i])!r} AS DOUBLE)" for i in (0, 1, 2, 4, 5)) for s in butterworth(order, kind, fs, fc)]


def low_six(tan: str) -> list[tuple[str, ...]]:
    """Coefficients of the sixth-order low-pass from the prewarped cut-off ``tan`` (an SQL expression), pole pair by pole pair."""
    out = []
    for degrees in (15, 45, 75):
        q = f"CAST({2 * math.cos(math.radians(degrees))!r} AS DOUBLE)"
        d = f"(1 + {q} * {tan} + {tan} * {tan})"
        b = f"({tan} * {tan} / {d})"
        out.append((b, f"(2 * {b})", b, f"(2 * ({tan} * {tan} - 1) / {d})", f"((1 - {q} * {tan} + {tan} * {tan}) / {d})"))
    return out


def zero_phase(order: int, kind: str, sections: list[tuple[str, ...]]) -> str:
    """CTEs from ``seg(k, i, v)`` (position from 0) and ``rate(k, tan)`` to ``flt(k, i, y)``; segments are longer than the extension."""
    pad, n = pad_length(order, kind), len(sections)
    known = ", ".join(f"{e} AS {name}_{s}" for s, c in enumerate(sections) for name, e in zip(_NAMES, c, strict=True))
    steady, gain = [], "1"
    for s in range(n):
        steady += [f"{gain} * (b0_{s} + b1_{s} + b2_{s}) / (1 + a1_{s} + a2_{s}) AS o_{s}", f"o_{s} - b0_{s} * {gain} AS p_{s}", f"b2_{s} * {gain} - a2_{s} * o_{s} AS q_{s}"]
        gain = f"o_{s}"
    states = ", ".join(f"s_{s}, t_{s}" for s in range(n))

    def one_way(name: str, source: str) -> str:
        first = ", ".join(f"p_{s} * v, q_{s} * v" for s in range(n))
        steps, x = [], "e.v"
        for s in range(n):
            steps += [f"b0_{s} * {x} + f.s_{s} AS y_{s}", f"b1_{s} * {x} - a1_{s} * y_{s} + f.t_{s} AS n_{s}", f"b2_{s} * {x} - a2_{s} * y_{s} AS m_{s}"]
            x = f"y_{s}"
        nxt = ", ".join(f"n_{s}, m_{s}" for s in range(n))
        return f"""{name}(k, j, y, {states}) AS (SELECT k, CAST(-1 AS BIGINT), CAST(0 AS DOUBLE), {first} FROM co JOIN {source} USING (k) WHERE j = 0 UNION ALL
 SELECT k, j, y_{n - 1}, {nxt} FROM (SELECT e.k, e.j, {', '.join(steps)} FROM {name} f JOIN {source} e ON e.k = f.k AND e.j = f.j + 1 JOIN co c ON c.k = e.k))"""

    return f"""co AS MATERIALIZED (SELECT *, {', '.join(steady)} FROM (SELECT k, {known} FROM rate)),
 wh AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY k) AS n, first_value(v) OVER w AS x0, last_value(v) OVER w AS x1 FROM seg
  WINDOW w AS (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
 ex AS MATERIALIZED (SELECT k, CAST(i + {pad} AS BIGINT) AS j, v FROM wh UNION ALL SELECT k, {pad} - i, 2 * x0 - v FROM wh WHERE i BETWEEN 1 AND {pad}
  UNION ALL SELECT k, {pad} + n + (n - 2 - i), 2 * x1 - v FROM wh WHERE i BETWEEN n - 1 - {pad} AND n - 2),
 {one_way('fw', 'ex')},
 re AS MATERIALIZED (SELECT k, CAST(max(j) OVER (PARTITION BY k) - j AS BIGINT) AS j, y AS v FROM fw WHERE j >= 0),
 {one_way('bw', 're')},
 flt AS (SELECT b.k, n + 2 * {pad} - 1 - b.j - {pad} AS i, y FROM bw b JOIN (SELECT DISTINCT k, n FROM wh) USING (k)
  WHERE n + 2 * {pad} - 1 - b.j - {pad} BETWEEN 0 AND n - 1)"""

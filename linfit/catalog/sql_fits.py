"""Iterative fits written out as plain SQL: one common table expression per iteration."""

from __future__ import annotations

from collections.abc import Sequence

from linfit.catalog.base import sql_rounded


def gradient_steps(
    source: str,
    points: str,
    terms: Sequence[tuple[str, int]],
    iterations: int,
    rate: str,
    tol: float = 1e-6,
) -> str:
    """CTEs ``s0 .. s<iterations>`` with the state of every gradient-descent fit.

    ``source`` has ``label`` and ``fold``; ``points`` has ``fit``, ``held``, ``l2``, ``degree``.
    ``terms`` lists each feature expression with the lowest degree that includes it. A state
    row has ``t0 ..``, ``b``, the last two losses and whether the fit has stopped.
    """
    d = range(len(terms))
    zero = "CAST(0 AS DOUBLE)"
    ctes = [
        "basis AS MATERIALIZED (SELECT label, fold, "
        + ", ".join(f"{e} AS f{i}" for i, (e, _) in enumerate(terms))
        + f" FROM {source})",
        "s0 AS MATERIALIZED (SELECT fit, held, l2, degree, "
        + ", ".join(f"{zero} AS t{i}" for i in d)
        + f", {zero} AS b, {rate} AS rate, CAST(NULL AS DOUBLE) AS last, "
        + f"CAST(NULL AS DOUBLE) AS before, FALSE AS stopped FROM {points})",
    ]
    for step in range(iterations):
        z = " + ".join([f"f{i} * t{i}" for i in d] + ["b"])
        halved = "CASE WHEN last > before THEN rate / 2 ELSE rate END"
        sums = ", ".join(
            [f"sum((1 / (1 + exp(-z)) - label) * f{i}) AS g{i}" for i in d]
            + [
                "sum(1 / (1 + exp(-z)) - label) AS gb",
                "avg(CASE WHEN label = 1 THEN ln(1 + exp(-z)) ELSE ln(1 + exp(z)) END) AS loss",
            ]
        )
        ctes.append(
            f"p{step} AS MATERIALIZED (SELECT fit, {sums} FROM (SELECT *, {z} AS z "
            f"FROM basis JOIN s{step} ON held <> fold) GROUP BY fit)"
        )

        def keep(new: str, old: str) -> str:
            return f"CASE WHEN stopped THEN {old} ELSE {new} END AS {old}"

        moved = ", ".join(
            [
                keep(
                    f"t{i} - step * (CASE WHEN degree >= {low} THEN g{i} + l2 * t{i} ELSE 0 END)",
                    f"t{i}",
                )
                for i, (_, low) in enumerate(terms)
            ]
            + [
                keep("b - step * gb", "b"),
                keep("step", "rate"),
                "CASE WHEN stopped THEN before ELSE last END AS before",
                "CASE WHEN stopped THEN last ELSE loss END AS last",
                f"stopped OR coalesce(abs(loss - last) <= {tol}, FALSE) AS stopped",
            ]
        )
        ctes.append(
            f"s{step + 1} AS MATERIALIZED (SELECT fit, held, l2, degree, {moved} FROM "
            f"(SELECT *, {halved} AS step FROM s{step} JOIN p{step} USING (fit)))"
        )
    return ", ".join(ctes)


def solve3(m: str, v: str) -> list[str]:
    """Cramer's rule for a symmetric 3x3 system ``m00 m10 m11 m20 m21 m22``, ``v0 v1 v2``."""
    a, b, c, e, f, i = (f"{m}{k}" for k in ("00", "10", "20", "11", "21", "22"))
    v0, v1, v2 = (f"{v}{k}" for k in range(3))
    whole = f"({a}*({e}*{i}-{f}*{f})-{b}*({b}*{i}-{f}*{c})+{c}*({b}*{f}-{e}*{c}))"
    return [
        f"({v0}*({e}*{i}-{f}*{f})-{b}*({v1}*{i}-{f}*{v2})+{c}*({v1}*{f}-{e}*{v2}))/{whole}",
        f"({a}*({v1}*{i}-{f}*{v2})-{v0}*({b}*{i}-{f}*{c})+{c}*({b}*{v2}-{v1}*{c}))/{whole}",
        f"({a}*({e}*{v2}-{v1}*{f})-{b}*({b}*{v2}-{v1}*{c})+{v0}*({b}*{f}-{e}*{c}))/{whole}",
    ]


def newton_steps(source: str, iterations: int, weight: str = "1") -> str:
    """CTEs ``n0 .. n<iterations>`` for a fit on ``x0``, ``x1`` and an intercept ``t2``."""
    zero = "CAST(0 AS DOUBLE)"
    ctes = [f"n0 AS MATERIALIZED (SELECT {zero} AS t0, {zero} AS t1, {zero} AS t2, {zero} AS loss)"]
    x = ["x0", "x1", "1"]
    moved = solve3("h", "g")
    for step in range(iterations):
        sums = ", ".join(
            [
                f"sum(w * s * (1 - s) * {x[i]} * {x[j]}) AS h{i}{j}"
                for i in range(3)
                for j in range(i + 1)
            ]
            + [f"sum(w * (s - label) * {x[i]}) AS g{i}" for i in range(3)]
            + ["avg(CASE WHEN label = 1 THEN ln(1 + exp(-z)) ELSE ln(1 + exp(z)) END) AS loss"]
        )
        ctes.append(
            f"q{step} AS MATERIALIZED (SELECT {sums} FROM (SELECT *, 1 / (1 + exp(-z)) AS s FROM "
            f"(SELECT x0, x1, label, {weight} AS w, x0 * t0 + x1 * t1 + t2 AS z "
            f"FROM {source}, n{step})))"
        )
        ctes.append(
            f"n{step + 1} AS MATERIALIZED (SELECT "
            + ", ".join(f"t{i} - {moved[i]} AS t{i}" for i in range(3))
            + f", q{step}.loss AS loss FROM n{step}, q{step})"
        )
    return ", ".join(ctes)


def named_rows(source: str, values: Sequence[tuple[str, str]], digits: int) -> str:
    """``(name, value)`` rows out of one wide row."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, {sql_rounded(e, digits)} AS value FROM {source}" for n, e in values
    )

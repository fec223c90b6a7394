"""Small SQL text helpers and the composition of named queries.

A query names the datasets it reads; ``compose`` puts those it needs, in order,
in front of it as common table expressions.
"""

from __future__ import annotations

import re


def S(c, scale=4):
    """Exact sum as a double."""
    return f"CAST(sum(CAST({c} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def T(c):
    """Exact sum, zero when there is nothing to add."""
    return f"coalesce({S(c)}, 0.0)"


def A(c):
    """Exact mean of the non-null values."""
    return f"{S(c)} / nullif(count({c}), 0)"


def R(c, n):
    """Half-up rounding in the decimal domain."""
    return f"CAST(round(CAST({c} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def ratio(num, den, times=None):
    return f"CASE WHEN {den} > 0 THEN {num} / {den}" + (f" * {times}" if times else "") + " END"


def trim(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def newest(keys, columns):
    """QUALIFY clause keeping the newest row per key."""
    rest = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    return f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"


def compose(sql: str, library: dict[str, str]) -> str:
    """``sql`` with every library entry it needs, directly or not, as a CTE."""
    names = sorted(library, key=len, reverse=True)
    finder = re.compile(r"\b(" + "|".join(map(re.escape, names)) + r")\b")
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(finder.findall(text)):
            if name not in ordered and name not in visiting:
                visiting.add(name)
                visit(library[name])
                ordered.append(name)

    visiting: set[str] = set()
    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({library[n]})" for n in ordered)
    return f"WITH {ctes}\n{sql}"

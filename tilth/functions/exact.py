"""Order-independent sums and means.

Adding doubles gives a different last bit for every order the rows arrive in,
and a different third decimal whenever a mean sits on a rounding tie, so a
re-run over the same data would not write the same mart. Farm measures are
fixed-point at the source. A measure summed here must have at most ``scale``
decimals (four unless told otherwise); durations, which do not, are summed as
whole seconds (``exact_hours``). Values are added as scaled
64-bit integers instead: exact, as fast as adding doubles, and combined on the
map side. A group may total 9.2e14 units; beyond that ANSI mode raises, it
never wraps. ``wide_sum`` uses a decimal for totals that can span a whole table.

Measures are given as SQL expressions; a second argument names the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 4


def named(text: str, name: str | None) -> Column:
    return F.expr(f"{text} AS {name}" if name else text)


def fixed_text(c: str, scale: int = SCALE) -> str:
    return f"cast(rint(({c}) * {10**scale}D) as bigint)"


def unfixed_text(units: str, scale: int = SCALE) -> str:
    return f"(cast({units} as double) / {10**scale}D)"


def fixed(c: str, scale: int = SCALE) -> Column:
    """The value as a whole number of 10^-scale units."""
    return F.expr(fixed_text(c, scale))


def sum_text(c: str, scale: int = SCALE) -> str:
    return unfixed_text(f"sum({fixed_text(c, scale)})", scale)


def exact_sum(c: str, name: str | None = None, scale: int = SCALE) -> Column:
    """Sum; null when every value is null."""
    return named(sum_text(c, scale), name)


def exact_total(c: str, name: str | None = None, scale: int = SCALE) -> Column:
    """Sum; zero when every value is null ("nothing happened")."""
    return named(f"coalesce({sum_text(c, scale)}, 0D)", name)


def exact_avg(c: str, name: str | None = None, scale: int = SCALE) -> Column:
    """Mean of the non-null values; null when there are none."""
    return named(f"{sum_text(c, scale)} / count({c})", name)


def exact_hours(c: str, name: str | None = None) -> Column:
    """Sum of durations in hours that are whole seconds; zero without any."""
    return named(f"coalesce(cast(sum(cast(rint(({c}) * 3600D) as bigint)) as double) / 3600D, 0D)", name)


def wide_units(c: str, scale: int = SCALE) -> str:
    """``cast(c as decimal(18, scale))`` as a whole number of units. Near a whole
    unit, where measures of so many decimals lie, no decimal need be made."""
    units = f"(({c}) * {10**scale}D)"
    return (f"CASE WHEN abs({c}) < 1e{14 - scale}D AND abs({units} - rint({units})) < 0.25D THEN cast(rint({units}) as bigint) "
            f"ELSE cast(cast(({c}) as decimal(18,{scale})) * {10**scale} as bigint) END")


def wide_text(c: str, scale: int = SCALE) -> str:
    """The sum as two of 64-bit integers, of the units' upper and lower halves,
    put together as a decimal once per group."""
    units, digits = wide_units(c, scale), f"0.{1:0{scale}d}BD"
    halves = [f"cast(sum({half}) as decimal(20,0))" for half in (f"shiftright({units}, 32)", f"({units}) & 4294967295L")]
    return f"cast(({halves[0]} * 4294967296BD + {halves[1]}) * {digits} as double)"


def wide_sum(c: str, name: str | None = None) -> Column:
    """Sum with 24 whole digits of room, for totals over many groups."""
    return named(wide_text(c), name)


def wide_avg(c: str, name: str | None = None) -> Column:
    return named(f"{wide_text(c)} / count({c})", name)


def rounded(c: str, digits: int, name: str | None = None) -> Column:
    """Half-up rounding in the decimal domain, so ties do not depend on how a
    double happens to be stored. Of a named column, only values near a tie, or
    too large to tell, go through decimals: the others have one nearest step,
    and a whole number over a power of ten is the double nearest to it."""
    exact = f"cast(round(cast(({c}) as decimal(38,12)), {digits}) as double)"
    if c.isidentifier():
        steps = f"({c} * {10**digits}D)"
        exact = (f"CASE WHEN abs({c}) < 1e{12 - digits}D AND abs({steps} - floor({steps}) - 0.5D) > 0.001D "
                 f"THEN cast(rint({steps}) as bigint) / {10**digits}D ELSE {exact} END")
    return named(exact, name)


def round_columns(df, columns, digits: int):
    """Round the named measures, leaving everything else alone."""
    return df.withColumns({name: rounded(name, digits) for name in columns})


def guarded_ratio_text(num: str, den: str, times: float = 1.0) -> str:
    scaled = f" * {times}D" if times != 1.0 else ""
    return f"CASE WHEN {den} > 0 THEN {num} / {den}{scaled} END"


def guarded_ratio(num: str, den: str, times: float = 1.0) -> Column:
    """``num / den * times`` where the denominator is positive, else null."""
    return F.expr(guarded_ratio_text(num, den, times))


def with_exprs(df, **columns: str):
    """Add or replace columns given as SQL expressions."""
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})

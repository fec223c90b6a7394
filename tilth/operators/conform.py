"""Conforming: a raw table becomes a typed, cleaned, deduplicated one.

A ``ConformSpec`` says what to do; the order is fixed: join, filter, rename,
clean, cast, derive, dedupe, select. Deduplication comes before the select
because the change stamps that say which copy is newest are not kept.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from tilth.contracts import Contract
from tilth.functions.text import strip_text
from tilth.operators.latest import latest_per_key

NEWEST = ["ingest_date", "updated_at"]


@dataclass(frozen=True)
class Lookup:
    """Bring ``columns`` from ``dataset`` by equality on ``on``."""

    dataset: str
    on: tuple[str, ...]
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ConformSpec:
    dataset: str
    source: str
    contract: Contract
    incremental: bool = False
    lookups: tuple[Lookup, ...] = ()
    keep: tuple = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    trim: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    derive: Mapping[str, str] = field(default_factory=dict)
    dedupe_on: tuple[str, ...] = ()


def lookup_join(df: DataFrame, lookup: DataFrame, on, columns) -> DataFrame:
    """Inner join that brings attributes in; rows without a parent drop out.
    Where both sides carry a column, the looked-up copy wins. The join strategy
    is left to table sizes: Spark broadcasts a lookup only below its threshold,
    and adaptive execution splits a hot parent."""
    missing = [c for c in (*on, *columns) if c not in lookup.columns]
    if missing:
        raise KeyError(f"lookup is missing join columns {missing}")
    return df.drop(*[c for c in columns if c in df.columns]).join(lookup.selectExpr(*on, *columns), list(on), "inner")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Names that are not there are ignored."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def clean_text(df: DataFrame, trim=(), lower=(), upper=()) -> DataFrame:
    held = df.columns
    plan = {
        n: f"{case}({strip_text(n)})"
        for names, case in ((trim, ""), (lower, "lower"), (upper, "upper")) for n in names if n in held
    }
    return _replace(df, plan)


def _replace(df: DataFrame, plan: Mapping[str, str]) -> DataFrame:
    """Columns of the plan get their expression, in place; new ones follow."""
    if not plan:
        return df
    held = df.columns
    kept = [f"{plan[c]} AS {c}" if c in plan else c for c in held]
    return df.selectExpr(*kept, *[f"{e} AS {c}" for c, e in plan.items() if c not in held])


def cast_to(df: DataFrame, types: Mapping[str, object]) -> DataFrame:
    """Strict casts: under ANSI a value that does not fit raises."""
    held = dict(df.dtypes)
    wanted = {n: t.simpleString() for n, t in types.items()}
    return _replace(df, {n: f"cast({n} as {t})" for n, t in wanted.items() if n in held and held[n] != t})


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Named SQL expressions over the cast columns."""
    return _replace(df, columns)


def select_contract(df: DataFrame, contract: Contract) -> DataFrame:
    absent = [c for c in contract.columns if c not in df.columns]
    if absent:
        raise KeyError(f"{contract.name}: source is missing {absent}; check renames, lookups and derivations")
    return df.selectExpr(*contract.columns)


def columns_for(spec: ConformSpec, wanted) -> list[str]:
    """The contract's columns without which some of ``wanted`` could come out
    differently: those and what decides before them which copy of a key stays.
    What a lookup brings by columns that decide earlier is the same in all
    copies that are still level, so it decides nothing."""
    names = spec.contract.columns
    unknown = set(wanted) - set(names)
    if unknown:
        raise KeyError(f"{spec.dataset} has no columns {sorted(unknown)}")
    names = names[:1 + max(names.index(c) for c in (*wanted, *spec.dedupe_on))]
    brought = {c: lk.on for lk in spec.lookups for c in lk.columns}
    return [c for i, c in enumerate(names) if c in wanted or not (c in brought and set(brought[c]) <= set(names[:i]))]


def conform(spec: ConformSpec, read, columns=None) -> DataFrame:
    """Apply ``spec``; ``read(name)`` gives a raw table by name. With ``columns``
    the same rows with these alone, and only what they depend on is moved."""
    if columns:
        if spec.keep:
            raise ValueError(f"{spec.dataset} is filtered by what it does not keep; take it whole")
        needed = columns_for(spec, columns)
        narrow = replace(
            spec, contract=replace(spec.contract, rules=tuple(r for r in spec.contract.rules if r.name in needed)),
            lookups=tuple(replace(lk, columns=tuple(c for c in lk.columns if c in needed or c not in spec.contract.columns)) for lk in spec.lookups),
            derive={c: e for c, e in spec.derive.items() if c in needed})
        return conform(narrow, read).select(*columns)
    df = read(spec.source)
    for lk in spec.lookups:
        df = lookup_join(df, read(lk.dataset), lk.on, lk.columns)
    for condition in spec.keep:
        df = df.filter(condition)
    df = rename(df, spec.rename)
    df = clean_text(df, spec.trim, spec.lower, spec.upper)
    df = cast_to(df, {r.name: r.dtype for r in spec.contract.rules})
    df = derive(df, spec.derive)
    # Only what is kept, or decides which copy is newest, goes through the shuffle.
    kept = set(spec.contract.columns) | set(NEWEST)
    df = df.selectExpr(*[c for c in df.columns if c in kept])
    if spec.dedupe_on:
        df = latest_per_key(df, list(spec.dedupe_on), NEWEST, spec.contract.columns)
    return select_contract(df, spec.contract)

"""Columns of a table never clash with those an operator works with."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame

NEW_NAMES = ("out", "prev_name", "prefix", "suffix")      # arguments that name new columns


def any_names(fn=None, *, handed_on: tuple[str, ...] = ()):
    """Operators name their working columns with a leading underscore. Columns of
    the input that are named so are called otherwise while the operator runs,
    also where an argument names them, and get their names back after it. A column
    that the operator itself returns under such a name wins. ``handed_on`` are
    working columns that the operator takes over from the one before it."""
    if fn is None:
        return functools.partial(any_names, handed_on=handed_on)

    @functools.wraps(fn)
    def run(df: DataFrame, *args, **kw) -> DataFrame:
        aside = {}
        for c in df.columns:
            if c.startswith("_") and c not in handed_on:
                other = f"kept{c}"
                while other.lower() in {x.lower() for x in (*df.columns, *aside.values())}:
                    other += "_"
                aside[c] = other
        if not aside:
            return fn(df, *args, **kw)

        def of(x):
            if isinstance(x, str):
                return aside.get(x, x)
            if isinstance(x, dict):
                return {k: of(v) for k, v in x.items()}
            return type(x)(of(v) for v in x) if isinstance(x, (list, tuple)) else x

        out = fn(df.withColumnsRenamed(aside), *map(of, args),
                 **{k: v if k in NEW_NAMES else of(v) for k, v in kw.items()})
        made = {c.lower() for c in out.columns}
        out = out.drop(*[o for c, o in aside.items() if c.lower() in made])
        return out.withColumnsRenamed({o: c for c, o in aside.items()})
    return run


def private(columns, name: str) -> str:
    """``name``, lengthened until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name

"""Helpers on rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def once(df: DataFrame, /, **made: str) -> DataFrame:
    """Adds columns, given as SQL, that are computed once a row: the optimizer moves nothing across
    a generator, so what reads them doesn't repeat their expressions."""
    own = [f"`{c}`" for c in df.columns]
    struct = ", ".join(f"{sql} as {k}" for k, sql in made.items())
    return df.selectExpr(*own, f"explode(array(struct({struct}))) as _made").selectExpr(*own, *[f"_made.{k} as {k}" for k in made])

"""Lookup joins whose left side may hold a large share of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join ``left`` to the lookup table ``right`` on ``key`` (inner, left_semi, left_anti).

    A lookup table that Catalyst finds small is broadcast. Else adaptive execution splits a
    left partition that a hot key makes large (all three kinds allow that) and gives each
    part its own copy of the lookup rows, by measured sizes.
    """
    return left.join(right, key, how)

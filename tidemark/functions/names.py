"""Column-name rules."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame


def lower_name(name: str) -> str:
    """``PULocationID`` -> ``pulocationid``; a space or a hyphen becomes ``_``."""
    return re.sub(r"[ -]", "_", name.lower())


def snake_name(name: str) -> str:
    """``LocationID`` -> ``location_id``."""
    split = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name.strip())
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]+", "_", split)).strip("_").lower()


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``rule``; two columns must not end up the same."""
    names = [rule(c) for c in df.columns]
    twice = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if twice:
        raise ValueError(f"columns collide after renaming: {twice}")
    return df.toDF(*names)

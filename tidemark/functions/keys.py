"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def composite_key(*columns: str) -> Column:
    """The non-NULL parts joined by ``|``."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def surrogate_key(*columns: str) -> Column:
    """md5 over all parts, each behind its length, so that it tells rows apart by every part.

    NULL has a length of its own, so it differs from any text.
    """
    parts = [F.col(c).cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws("|", *marked))

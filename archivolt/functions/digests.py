"""Digest spelling."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def canonical_digest(digest: Column) -> Column:
    """One spelling per digest: no algorithm prefix, lower case; blank becomes NULL."""
    bare = F.regexp_replace(F.lower(F.trim(digest)), r"^[a-z0-9-]+:", "")
    return F.when(bare != "", bare)

"""Seeded randomness from row keys.

``rand(seed)`` depends on how rows are spread over partitions. Hashing the row key with the
seed does not, is the same after a lost executor is recomputed, and can be written in any SQL
dialect, so every sample, split, fold and oversampling pick is drawn from here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def order_hash(keys: str | Sequence[str], seed: int | str) -> Column:
    """Hex md5 of ``seed:key`` (several keys are joined by ``|``): a random but fixed row order."""
    names = [keys] if isinstance(keys, str) else list(keys)
    parts = [F.col(name).cast("string") for name in names]
    text = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def uniform(hash_column: Column, word: int = 0) -> Column:
    """A double in [0, 1) from the ``word``-th group of eight hex digits of an md5."""
    digits = F.substring(hash_column, 1 + 8 * word, 8)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)

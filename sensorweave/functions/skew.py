"""Joining rows to a per-key table when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.settings import setting

SALT = "_salt"


def salts(count: str, split_rows: int) -> Column:
    """The salts of a key with `count` rows, as an array."""
    pieces = F.ceil(F.col(count) / split_rows).cast("int")
    return F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1)


def spread_hot_keys(
    rows: DataFrame,
    counts: DataFrame,
    keys: Sequence[str],
    by: str,
    count: str = "n",
) -> tuple[DataFrame, DataFrame]:
    """Add `_salt` to both sides of a join on `keys`, so that no key exceeds `splitRows` per salt.

    `counts` has one row per key with its row count. A key above the limit gets
    ceil(count / splitRows) salts: its rows are dealt out by a hash of `by`, its `counts`
    row is repeated once per salt. The list of such keys is broadcast; it holds at most
    (row count / splitRows) entries.
    """
    split_rows = setting(rows, "splitRows")
    pieces = F.ceil(F.col(count) / split_rows).cast("int")
    hot = counts.where(F.col(count) > split_rows).select(*keys, pieces.alias("_pieces"))
    dealt = F.pmod(F.xxhash64(by), F.col("_pieces")).cast("int")
    rows = (
        rows.join(F.broadcast(hot), list(keys), "left")
        .withColumn(SALT, F.coalesce(dealt, F.lit(0)))
        .drop("_pieces")
    )
    return rows, counts.withColumn(SALT, F.explode(salts(count, split_rows)))

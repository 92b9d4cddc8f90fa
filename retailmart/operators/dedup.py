"""One row per key, reproducibly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_WORDS = 1 << 20  # 64 bits each: the marks are at most 16 MB, whatever the tables hold


def _marked(rows: DataFrame, value: str, among: DataFrame, other: str) -> DataFrame:
    """Rows whose ``value`` may be among the values of ``other``: all that are, and few of the rest.

    The values are hashed to bits of a table of bounded size, so it can go to every task and no row is shuffled to be
    dropped. The more values, the more bits are set; when all are, every row stays.
    """

    def word(column: str) -> Column:
        return F.pmod(F.shiftrightunsigned(F.xxhash64(column), 6), F.lit(_WORDS))

    def bit(column: str) -> Column:
        return F.xxhash64(column).bitwiseAND(63).cast("int")

    bits = among.groupBy(word(other).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(other))).alias("_bits"))
    is_set = F.call_function("getbit", "_bits", bit(value)) == 1
    return rows.join(F.broadcast(bits), (word(value) == F.col("_word")) & is_set, "left_semi")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """The first row of every key by ``order``, ties broken by all other columns, NULL first; keys that ``known`` has are left out.

    Rows of a tie that is left are equal in all columns, so the outcome does not
    depend on partitioning. Two phases: the smallest value of the first order column per key is a hash
    aggregate of one number, of which a task ships one row per key; the rows that hold it then come back by a
    join on key and value, so a key that holds a third of the table is dealt out by its values. Only rows whose number is marked as
    one of the smallest are shuffled, and only these few are sorted to settle ties. Known keys are dropped once there is
    one row per key, so that no rows are looked for where nothing is new.
    """
    lead, rest = order[0], [c for c in df.columns if c not in keys and c != order[0]]
    rest = sorted(rest, key=lambda c: order.index(c) if c in order else len(order))
    least = F.when(F.count_if(F.col(lead).isNull()) == 0, F.min(lead)).alias("_least")
    least = df.groupBy(*keys).agg(least)
    if known is not None:
        least = unknown(least, known, keys)
    least = least.select(*[F.col(c).alias(f"_{c}") for c in keys], "_least")
    # most rows are none of the smallest values at all: one number tells, before their keys are made
    near = _marked(df, lead, least, "_least")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    winners = near.join(least, [*same, F.col(lead).eqNullSafe(F.col("_least"))], "left_semi")
    if not rest:
        return winners.distinct()
    chosen = winners.groupBy(*keys, lead).agg(F.min(F.struct(*rest)).alias("_rest"))
    return chosen.select(*[F.col(c) if c in (*keys, lead) else F.col(f"_rest.{c}") for c in df.columns])


def first_non_null(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """The first non-NULL ``value`` of every key; NULL for a key that has none.

    The smallest of tied values is taken when ``order`` is not unique.
    """
    filled = F.when(F.col(value).isNotNull(), F.struct(F.col(order), F.col(value)))
    return df.groupBy(*keys).agg(F.min(filled)[value].alias(value))


def insert_new(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows to append so that no key of ``target`` is repeated: first row per new key."""
    fresh = first_by(batch, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti")


def unknown(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``target`` does not have; NULL equals NULL, and the join stays an equi-join."""
    known = target.select(*[F.col(c).alias(f"_{c}") for c in keys])
    return rows.join(known, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], "left_anti")

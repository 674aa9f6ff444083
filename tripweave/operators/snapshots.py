"""What changed between two snapshots of a table, as multisets of rows.

Rows are folded by key and digest on either side before the shuffle, so equal rows, however
many, travel as one with a count, and the full outer join meets digests, not rows. Nulls are
equal to nulls, in keys too. Whole rows are read again only for keys that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digest(columns: Sequence[str]) -> Column:
    """128 bits over the values as texts, each led by its length, so neither a null nor where
    one value ends and the next begins can be mistaken."""
    texts = [F.col(c).cast("string") for c in sorted(columns)]
    return F.md5(F.concat(*(F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts)))


def _folded(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    return rows.groupBy(*keys, _digest(columns).alias("_digest")).agg(F.count(F.lit(1)).alias(name))


def key_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, added, removed, changed, kept and repeated, for every key of either side. Of a
    key's rows that are only in one snapshot as many as possible pair up as changed;
    repeated are the rows of ``after`` beyond the first of their kind."""
    columns = [c for c in before.columns]
    if sorted(columns) != sorted(after.columns):
        raise ValueError("the snapshots have different columns")
    old, new = _folded(before, keys, columns, "_old"), _folded(after, keys, columns, "_new")
    new = new.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)} | {"_digest": "_d"})
    same = F.col("_digest") == F.col("_d")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    # A side's own columns tell whether it has the row: keys may be null themselves.
    here = F.col("_digest").isNotNull()
    key = [F.when(here, F.col(k)).otherwise(F.col(f"_k{i}")).alias(k) for i, k in enumerate(keys)]
    n_old, n_new = F.coalesce("_old", F.lit(0)), F.coalesce("_new", F.lit(0))
    both = old.join(new, same, "full").select(*key, n_old.alias("_old"), n_new.alias("_new"))
    sums = both.groupBy(*keys).agg(
        F.sum(F.greatest(F.col("_new") - F.col("_old"), F.lit(0))).alias("_more"),
        F.sum(F.greatest(F.col("_old") - F.col("_new"), F.lit(0))).alias("_less"),
        F.sum(F.least("_old", "_new")).alias("kept"),
        F.sum(F.greatest(F.col("_new") - 1, F.lit(0))).alias("repeated"),
    )
    changed = F.least("_more", "_less")
    return sums.select(
        *keys,
        (F.col("_more") - changed).alias("added"),
        (F.col("_less") - changed).alias("removed"),
        changed.alias("changed"),
        "kept",
        "repeated",
    )


def summary(changes: DataFrame) -> DataFrame:
    """One row: keys, keys that differ, and all counts added up."""
    differs = F.col("added") + F.col("removed") + F.col("changed") > 0
    names = ("added", "removed", "changed", "kept", "repeated")
    return changes.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(differs).alias("n_keys_differing"),
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names),
    )


def differing_rows(rows: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole rows of one snapshot whose key differs."""
    moved = changes.filter("added + removed + changed > 0").select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(moved, same, "left_semi")

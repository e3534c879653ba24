"""Profiling, reconciliation, deterministic samples and result checksums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows ``(table_name, ordinal, column_name, data_type, row_count, non_nulls)``.

    One aggregate pass per table (partial counts per partition, one tiny final
    task); column names and types come from the schema without reading data.
    """
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        counts = df.agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.count(F.col(f"`{f.name}`")).alias(f"__nn{i}") for i, f in enumerate(fields)],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("ordinal"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.col(f"__nn{i}").alias("non_nulls"),
                )
                for i, f in enumerate(fields)
            ]
        )
        parts.append(
            counts.select(
                F.lit(name).alias("table_name"),
                F.col("__rows").alias("row_count"),
                F.inline(entries),
            ).select("table_name", "ordinal", "column_name", "data_type", "row_count", "non_nulls")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    value: str,
    left_name: str,
    right_name: str,
) -> DataFrame:
    """Rows where two count tables disagree (missing on one side counts).

    A full outer join on null-safe keys; the result holds only the differing
    keys, so an empty result means the tables agree.
    """
    lv = left.select(*[F.col(k).alias(f"__l_{k}") for k in keys], F.col(value).alias(left_name))
    rv = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col(value).alias(right_name))
    cond: Column | None = None
    for k in keys:
        term = F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}"))
        cond = term if cond is None else cond & term
    joined = lv.join(rv, cond, "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"__l_{k}"), F.col(f"__r_{k}")).alias(k) for k in keys],
        left_name,
        right_name,
    ).filter(~F.col(left_name).eqNullSafe(F.col(right_name)))


class ReconciliationError(RuntimeError):
    pass


def assert_reconciled(diff: DataFrame) -> None:
    """Raise if a ``reconcile`` result has any row (reads at most one row)."""
    if diff.limit(1).count() > 0:
        raise ReconciliationError("result tables differ")


def sample_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows by an explicit order (TakeOrderedAndProject: each
    partition keeps its own top ``n``; only ``n`` rows per partition move)."""
    return df.orderBy(*order_by).limit(n)


def checksum(df: DataFrame) -> DataFrame:
    """Order-insensitive one-row digest: row count and sum of row hashes."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("checksum"),
    )

"""A1: duplicate removal over whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: one of each set of equal rows.

    The row is grouped as one value. Grouping by its columns would reuse the partitioning
    of a join key among them, which leaves a hot key's rows in one task and keeps Spark
    from splitting that join. This way equal rows are combined map-side and the rest is
    spread by the hash of the whole row.
    """
    row = ", ".join(f"`{c}`" for c in df.columns)
    return df.selectExpr(f"struct({row}) AS row").distinct().select("row.*")

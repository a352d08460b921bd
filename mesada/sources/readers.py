"""Relations as DataFrames, from files, catalog tables or partitioned JDBC reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from mesada.profiles import Profile, get_profile
from mesada.sources.schemas import RELATIONS, ddl_of, schema_of, text_columns


def conform(df: DataFrame, name: str, empty_as_null: bool = False) -> DataFrame:
    """Select and cast a relation's columns to its schema; names match in any case.

    With `empty_as_null` an empty text is NULL (E1), so that rules which test for NULL see
    what a database without empty texts would show them.
    """

    texts = text_columns(name) if empty_as_null else ()

    def column(f) -> str:
        col = f"CAST(`{f.name}` AS {f.dataType.simpleString()})"
        return f"nullif({col}, '') AS `{f.name}`" if f.name in texts else f"{col} AS `{f.name}`"

    return df.selectExpr(*[column(f) for f in schema_of(name)])


@dataclass(frozen=True)
class FileSource:
    """One directory or file per relation."""

    base: str
    format: str = "parquet"
    suffix: str = ""

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.format(self.format).load(f"{self.base}/{name}{self.suffix}")


@dataclass(frozen=True)
class CatalogSource:
    """Tables of one schema of the session catalog."""

    schema: str

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.schema}.{name}")


# Code lists, whose size does not follow the business.
SMALL_RELATIONS = ("banco", "diadepago", "diasfestivos", "modalidadpagosegurovida")


def split_predicates(column: str, points: Sequence[int]) -> list[str]:
    """Predicates that every row meets exactly one of, rows without a key included."""
    if not points:
        return ["1 = 1"]
    inner = [
        f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:], strict=False)
    ]
    return [f"{column} < {points[0]} OR {column} IS NULL", *inner, f"{column} >= {points[-1]}"]


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a remote database, read in parallel ranges of a numeric key.

    `ranges` gives (column, lower, upper, partitions) per table, `points` (column, split
    points), as `pushdown.quantile_points` finds them where even ranges would not be even in
    rows. Tables named in `small` are read by a single task; any other without a range, points
    or predicates is refused. Bounds only place the splits: rows outside them are read too, by
    the first and last task.
    """

    url: str
    schema: str
    properties: Mapping[str, str] = field(default_factory=dict, hash=False)
    ranges: Mapping[str, tuple[str, int, int, int]] = field(default_factory=dict, hash=False)
    small: tuple[str, ...] = SMALL_RELATIONS
    points: Mapping[str, tuple[str, tuple[int, ...]]] = field(default_factory=dict, hash=False)

    def splits(self, name: str) -> list[str] | None:
        """Predicates between the table's split points, if it has some."""
        return split_predicates(*self.points[name]) if name in self.points else None

    def options(self, name: str, predicates: Sequence[str] | None = None) -> dict[str, str]:
        if predicates is None and not any(name in x for x in (self.ranges, self.points, self.small)):
            raise ValueError(
                f"{name}: give `ranges` for it, or name it in `small`; "
                "without a range one task would read the whole table"
            )
        out = {
            "url": self.url,
            "dbtable": f"{self.schema}.{name}",
            # Read with the final types: no cast stands between a filter and the database.
            "customSchema": ddl_of(name),
            "preferTimestampNTZ": "true",
            **self.properties,
        }
        if name in self.ranges and predicates is None and name not in self.points:
            column, lower, upper, partitions = self.ranges[name]
            out |= {
                "partitionColumn": column,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(partitions),
            }
        return out

    def read(
        self, spark: SparkSession, name: str, predicates: Sequence[str] | None = None
    ) -> DataFrame:
        """The table, in one task for each predicate if some are given or made by points."""
        predicates = self.splits(name) if predicates is None else list(predicates)
        options = self.options(name, predicates)
        if predicates is None:
            return spark.read.format("jdbc").options(**options).load()
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)


Source = FileSource | CatalogSource | JdbcSource


def read_table(
    spark: SparkSession, name: str, source: Source, empty_as_null: bool = False
) -> DataFrame:
    """One relation with its fixed schema; see `conform` for `empty_as_null`.

    The casts sit above the scan, so Spark still prunes columns there.
    """
    return conform(source.read(spark, name), name, empty_as_null)


def read_holidays(spark: SparkSession, source: Source) -> DataFrame:
    """The holiday table."""
    return read_table(spark, "diasfestivos", source)


class Relations(Mapping[str, DataFrame]):
    """The relations a profile reads, opened on first use."""

    def __init__(self, opener: Callable[[str], DataFrame], names=RELATIONS):
        self._open, self._names, self._seen = opener, tuple(names), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._seen:
            self._seen[name] = self._open(name)
        return self._seen[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def open_relations(
    spark: SparkSession, sources: Mapping[str, Source], profile: Profile | str = "v1",
    default: str = "snapshot",
) -> Relations:
    """`sources` maps source names to readers; the profile picks one per relation.

    Where the profile reports '' as NULL, empty texts are read as NULL as well.
    """
    p = get_profile(profile)
    return Relations(
        lambda name: read_table(
            spark, name, sources[p.sources.get(name, default)], p.empty_as_null
        )
    )

"""Reads of a remote source cut to the reported months and the sent requests.

Everything is said in predicates, one for each task of the read, which the remote database
evaluates: the gate's months on the facts, and ranges of the keys that the sent requests use on
the lookups. Ranges come from quantiles, so tasks get even shares of a skewed key, and stretches
between two ranges that hold no sent key are not read at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesada.operators.calendar import ReportCalendar
from mesada.operators.gate import gate_span, month_gate
from mesada.profiles import Profile, get_profile
from mesada.sources.readers import JdbcSource, Relations, Source, open_relations, read_table

#: Most ranges of one key, and so most tasks of one read.
RANGES = 64
#: Most ranges in one filter of a file scan. Spark compiles a filter as one method, which Java
#: interprets where it is long; a scan of 9 million rows took 200 s of task time with 64 ranges.
FILTER_RANGES = 8
ACCURACY = 10_000
NOTHING = "1 = 0"
#: Most single values of a key that are handed to a scan one by one; fewer than Spark's limit.
IN_LIST = 10

FACTS, FACT_TIME = "desembolsorelacion", "fechaenvio"
# Relations keyed by the request itself, and by a column of the request's row.
BY_REQUEST = {
    "originacion": "caso",
    "originacion_solicitudes": "solicitud",
    "desembolso": "Solicitud",
}
BY_CASE = {
    "datosfactura": ("idDatosFactura", "DatosFactura"),
    "informacionpm": ("DatosFactura", "DatosFactura"),
    "seguros": ("idSeguros", "Seguros"),
    "informacionestudio": ("idInformacionestudio", "InformaciondeEstudio"),
    "operaciones": ("idOperaciones", "Operaciones"),
    "planfinanciacion": ("idPlanFinanciacion", "PlanFinanciacion"),
    "cliente": ("idCliente", "Cliente"),
    "vehiculo": ("idVehiculo", "Vehiculo"),
}


def gate_predicate(cal: ReportCalendar, column: str, cutoff_op: str | None = None) -> str | None:
    """The span of the reported months as a predicate; None if the calendar does not know it."""
    if cal.first_month is None:
        return None
    first, end = (f"TIMESTAMP '{d:%Y-%m-%d} 00:00:00'" for d in gate_span(cal, cutoff_op))
    return f"{column} >= {first} AND {column} < {end}"


def quantile_points(df: DataFrame, column: str, parts: int = RANGES) -> tuple[int, ...]:
    """At most parts - 1 ascending split points that cut the column's rows evenly.

    A key that repeats over several quantiles is one point, so a hot key stands alone in its
    range. No rows give no point.
    """
    return _points(df, [column], parts)[column]


def _points(df: DataFrame, columns: Sequence[str], parts: int) -> dict[str, tuple[int, ...]]:
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    marks = [F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns]
    row = df.agg(*marks).first()
    # A point begins a range: the quantile itself, the last of the range below, stays in that.
    return {c: tuple(sorted({int(v) + 1 for v in row[c] or ()})) for c in columns}


def write_points(
    spark: SparkSession, points: Mapping[str, tuple[str, Sequence[int]]], path: str,
    mode: str = "errorifexists",
) -> None:
    """Store split points by relation, so that every report need not measure them anew."""
    rows = [(name, column, list(p)) for name, (column, p) in points.items()]
    schema = "relation string, key string, points array<bigint>"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(path)


def read_points(spark: SparkSession, path: str) -> dict[str, tuple[str, tuple[int, ...]]]:
    """Stored split points: a row for each relation."""
    return {r["relation"]: (r["key"], tuple(r["points"])) for r in spark.read.parquet(path).collect()}


def key_ranges(
    keys: DataFrame, columns: Sequence[str], most: int = RANGES
) -> dict[str, list[tuple[int, int, int]]]:
    """For each column at most ``most`` disjoint ranges (first, last, rows) that hold all its keys.

    Two jobs for all columns together: quantiles, then first and last key of each bucket. Only
    ``most`` rows a column reach the driver. NULL keys are in no range.
    """
    points = _points(keys, columns, most)

    def place(column: str):
        marks = F.array(*map(F.lit, points[column])) if points[column] else F.array().cast("array<bigint>")
        return F.struct(
            F.lit(column).alias("name"),
            F.col(column).cast("bigint").alias("key"),
            F.size(F.filter(marks, lambda p: p <= F.col(column))).alias("k"),
        )

    placed = [place(c) for c in columns]
    rows = (
        keys.select(F.explode(F.array(*placed)).alias("v"))
        .where("v.key IS NOT NULL")
        .groupBy("v.name", "v.k")
        .agg(F.min("v.key").alias("a"), F.max("v.key").alias("b"), F.count("*").alias("n"))
        .collect()
    )
    found: dict[str, list[tuple[int, int, int]]] = {c: [] for c in columns}
    for r in sorted(rows, key=lambda r: r["a"]):
        found[r["name"]].append((r["a"], r["b"], r["n"]))
    return found


def range_predicates(column: str, ranges: Iterable[tuple[int, int, int]]) -> list[str]:
    """A predicate for each range; none at all reads nothing."""
    made = [f"{column} >= {a} AND {column} <= {b}" for a, b, _ in ranges]
    return made or [NOTHING]


def merged_ranges(
    ranges: Iterable[tuple[int, int, int]], most: int = FILTER_RANGES
) -> list[tuple[int, int, int]]:
    """All keys of the ranges in at most ``most`` of them; only the widest gaps stay open."""
    ordered = sorted(ranges)
    gaps = sorted(range(1, len(ordered)), key=lambda k: ordered[k - 1][1] - ordered[k][0])
    starts = [0, *sorted(gaps[: most - 1])]
    parts = [ordered[a:b] for a, b in zip(starts, [*starts[1:], len(ordered)], strict=True)]
    return [(r[0][0], r[-1][1], sum(n for *_, n in r)) for r in parts if r]


def only_keys(df: DataFrame, column: str, keys: DataFrame, most: int = RANGES) -> DataFrame:
    """The rows of `df` whose `column` is among the values of `keys` (its only column).

    The ranges that the keys lie in, measured first and merged, are a filter on the scan, which so skips
    row groups and files outside them (`writers.write_by_month` with `sort_col`); up to IN_LIST
    single values are given to it as such, for Bloom filters to answer. The semi join decides.
    """
    (name,) = keys.columns
    ranges = key_ranges(keys, [name], most)[name]
    if all(a == b for a, b, _ in ranges) and len(ranges) <= IN_LIST:
        near = F.col(column).isin(*[a for a, _, _ in ranges]) if ranges else F.lit(False)
    else:
        near = range_predicates(f"`{column}`", merged_ranges(ranges))
        near = F.expr(" OR ".join(f"({p})" for p in near))
    wanted = keys.select(F.col(name).alias("wanted_key")).distinct()
    return df.where(near).join(wanted, F.col(column) == F.col("wanted_key"), "left_semi")


@dataclass(frozen=True)
class Restricted:
    """A source some of whose relations are read by predicates only.

    A database evaluates them, one for each task; for other sources they are one filter, which
    reaches a file scan as ranges.
    """

    source: Source
    predicates: Mapping[str, list[str]] = field(default_factory=dict, hash=False)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        wanted = self.predicates.get(name)
        if wanted is None:
            return self.source.read(spark, name)
        if isinstance(self.source, JdbcSource):
            return self.source.read(spark, name, wanted)
        return self.source.read(spark, name).where(" OR ".join(f"({p})" for p in wanted))


def fact_predicates(source: Source, gate: str) -> list[str]:
    """The gate, and beside it the splits that a database source has for the facts."""
    splits = source.splits(FACTS) if isinstance(source, JdbcSource) else None
    return [f"({gate}) AND ({s})" for s in splits] if splits else [gate]


def pushed_relations(
    spark: SparkSession, sources: Mapping[str, Source], cal: ReportCalendar,
    profile: Profile | str = "v1", most: int = RANGES, default: str = "snapshot",
) -> Relations:
    """Relations of which only what the reports of ``cal`` need is read from the sources.

    The sendings of the reported months are read twice for their request numbers, the rows of
    those requests twice for the keys in them; both are a few columns cut by predicates. All
    reports of that calendar and profile are equal to those on the full relations. Without a
    known span of months the sendings are read whole.
    """
    p = get_profile(profile)
    gate = gate_predicate(cal, FACT_TIME)
    held: dict[str, dict[str, list[str]]] = {name: {} for name in sources}

    def put(name: str, wanted: list[str]) -> None:
        held[p.sources.get(name, default)][name] = wanted

    def put_ranges(name: str, column: str, ranges: list[tuple[int, int, int]]) -> None:
        remote = isinstance(sources[p.sources.get(name, default)], JdbcSource)
        put(name, range_predicates(column, ranges if remote else merged_ranges(ranges)))

    def opened(name: str) -> DataFrame:
        which = p.sources.get(name, default)
        return read_table(spark, name, Restricted(sources[which], held[which]))

    if gate is not None:
        put(FACTS, fact_predicates(sources[p.sources.get(FACTS, default)], gate))
    sent = month_gate(opened(FACTS).select("solicitud", FACT_TIME), cal, FACT_TIME, p.totals_lag_days)
    plain = month_gate(opened(FACTS).select("solicitud", FACT_TIME), cal, FACT_TIME)
    keys = sent.select("solicitud").unionByName(plain.select("solicitud")).distinct()
    asked = key_ranges(keys, ["solicitud"], most)["solicitud"]
    for name, column in BY_REQUEST.items():
        put_ranges(name, column, asked)
    columns = list(dict.fromkeys(column for _, column in BY_CASE.values()))
    cases = opened("originacion").select("caso", *columns)
    cases = cases.join(keys, F.col("caso") == F.col("solicitud"), "left_semi")
    used = key_ranges(cases, columns, most)
    for name, (key, column) in BY_CASE.items():
        put_ranges(name, key, used[column])
    narrow = {name: Restricted(source, held[name]) for name, source in sources.items()}
    return open_relations(spark, narrow, p, default)

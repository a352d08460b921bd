"""Report files, fact tables stored by month and lookups stored by key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONTH_COLUMN = "envio_mes"
COPY_BYTES = 4 << 20


def write_report(
    df: DataFrame, path: str, null_value: str = "", empty_value: str = '""', sep: str = ",",
    header: bool = False, mode: str = "errorifexists",
) -> None:
    """A report as delimited text, columns by position, in a folder of parts.

    Every task writes its own part; for an ordered report the parts in name order are the
    report in order. By default a NULL cell is empty and an empty text is quoted, so the
    two stay apart. Dates and numbers print as Spark prints them.
    """
    (
        df.write.mode(mode)
        .option("sep", sep)
        .option("header", header)
        .option("nullValue", null_value)
        .option("emptyValue", empty_value)
        # Report texts carry meaningful blanks at both ends.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _header_line(names: list[str], sep: str) -> bytes:
    def cell(name: str) -> str:
        plain = not any(x in name for x in (sep, '"', "\n", "\r"))
        return name if plain else '"' + name.replace("\\", "\\\\").replace('"', '\\"') + '"'

    return (sep.join(map(cell, names)) + "\n").encode()


def _append_parts(spark: SparkSession, files, folder, out) -> None:
    """Copy the folder's parts, in name order, to an open stream through a fixed buffer."""
    hadoop = spark._jvm.org.apache.hadoop
    for name in sorted(s.getPath().getName() for s in files.listStatus(folder)):
        if name.startswith("part-"):
            part = files.open(hadoop.fs.Path(folder, name))
            try:
                hadoop.io.IOUtils.copyBytes(part, out, COPY_BYTES, False)
            finally:
                part.close()


def write_report_file(
    df: DataFrame, path: str, null_value: str = "", empty_value: str = '""', sep: str = ",",
    header: bool = False, mode: str = "errorifexists",
) -> None:
    """A report as one flat file, columns by position, that appears all at once.

    Tasks write parts to a hidden folder beside ``path``; these are joined in name order by
    stream copy, after the header if one is asked for, into a hidden file that is renamed to
    ``path`` when it is complete. Memory does not grow with the report. A run that fails leaves
    what was there before and takes its hidden files away. ``mode`` is "errorifexists" or
    "overwrite"; any file system that Spark writes to will do.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r}: expected 'errorifexists' or 'overwrite'")
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    files = target.getFileSystem(conf)
    if mode == "errorifexists" and files.exists(target):
        raise FileExistsError(path)
    mark = f".{target.getName()}.{uuid.uuid4().hex}"
    parts, whole = (hadoop.Path(target.getParent(), mark + end) for end in (".parts", ".whole"))
    try:
        write_report(df, parts.toString(), null_value, empty_value, sep)
        out = files.create(whole, False)
        try:
            if header:
                out.write(bytearray(_header_line(df.columns, sep)))
            _append_parts(spark, files, parts, out)
        finally:
            out.close()
        # One step: readers see the old file or the new one.
        rename = getattr(hadoop, "Options$Rename")
        how = spark._sc._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if mode == "overwrite" else rename.NONE
        hadoop.FileContext.getFileContext(whole.toUri(), conf).rename(whole, target, how)
    finally:
        for left in (parts, whole):
            if files.exists(left):
                files.delete(left, True)


def read_report_file(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", header: bool = False
) -> DataFrame:
    """A report file, or folder of parts, written with the default marks, by position."""
    # The reader puts this mark in place of an empty cell; a quoted one stays an empty text.
    return spark.read.schema(schema).csv(
        path, sep=sep, header=header, nullValue="\u0000", emptyValue="", enforceSchema=True
    )


def write_by_key(df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists") -> None:
    """Store a lookup table in the catalog by its key, in `buckets` sorted buckets.

    A join on that key then leaves the table where it is and shuffles only the other side
    (read it through `CatalogSource`). Choose buckets of about the size of a task's input.
    """
    (
        df.repartition(buckets, key)
        .write.mode(mode)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table, format="parquet")
    )


def write_by_month(
    df: DataFrame, path: str, ts_col: str, mode: str = "errorifexists",
    sort_col: str | None = None, group_bytes: int | None = None,
) -> None:
    """Store facts by month of `ts_col`, so that a month gate reads only its months.

    Rows are rebalanced by month, so months get files of even size: Spark merges small
    months and splits one that holds most rows. With `sort_col` a file's rows are in its order
    and every row group has its least and greatest value and a Bloom filter of it, so a read
    by ranges or values of that column (`pushdown.only_keys`) passes over row groups that
    hold none of them; `group_bytes` sets their size.
    """
    df = df.withColumn(MONTH_COLUMN, F.trunc(ts_col, "MM")).hint("rebalance", F.col(MONTH_COLUMN))
    if sort_col:
        df = df.sortWithinPartitions(MONTH_COLUMN, sort_col)
    writer = df.write.mode(mode).partitionBy(MONTH_COLUMN)
    if sort_col:
        writer = writer.option(f"parquet.bloom.filter.enabled#{sort_col}", "true")
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)

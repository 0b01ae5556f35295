"""CSV files whose layouts differ: columns matched by header name, types inferred per file and widened.

``scan(spark, path)`` reads one file or a folder of files (Hive ``k=v`` folders
become columns).  Every file's header is read first; files of equal header are
scanned together as text, the groups united by column name (a column that a
file lacks is null there).  One aggregation gives the narrowest type of each
column in each file; the common type is the narrowest that holds them all:
``int < bigint < double``, ``date < timestamp``, ``boolean``, else text.  A column without
values takes any type.  Rows with more or fewer fields than their header are
kept, as the reader gives them, and counted.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
FILE = "_file"
#: Types a column may get, by what holds all of its values; the first that holds them is taken.
LADDER = ("int", "bigint", "double", "boolean", "date", "timestamp_ntz", "timestamp", "string")
_ZONE = r"([A-Za-z]|[+-]\d{2}:?\d{2})\s*$"


def _fits(value: Column, name: str) -> Column:
    """Whether text is a value of type ``name`` (a null is one of every type)."""
    if name == "string":
        return F.lit(True)
    if name in ("int", "bigint"):
        ok = value.rlike(r"^\s*[+-]?\d+\s*$") & value.try_cast(name).isNotNull()
    elif name == "double":
        ok = value.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    elif name == "boolean":
        ok = F.lower(F.trim(value)).isin("true", "false")
    elif name == "date":
        ok = value.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$") & value.try_cast("date").isNotNull()
    else:
        zoned = value.rlike(_ZONE)
        ok = value.rlike(r"^\s*\d{4}-\d") & value.try_cast("timestamp").isNotNull()
        if name == "timestamp_ntz":
            ok = ok & ~zoned
    return value.isNull() | ok


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> the files that begin with it (names only, as a file listing)."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path) \
        if not path.endswith(".csv") else spark.read.text(path)
    first = (lines.where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
             .groupBy("file").agg(F.min_by("value", "at").alias("header")))
    out: dict[str, list[str]] = {}
    for r in first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
        out[r["header"]] = list(r["files"])
    return out


@dataclass
class Scan:
    """Rows of reconciled files, the narrowest types per file, and the rows that did not fit their header."""

    rows: DataFrame
    types: DataFrame
    schema: dict[str, str]
    _raw: DataFrame

    def corrupt_rows(self) -> int:
        # the reader only checks a row against its header when all fields are read
        every = F.max(F.xxhash64(*[F.col(c) for c in self.schema]))
        return self._raw.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("n"), every).first()["n"]


def scan(spark: SparkSession, path: str) -> Scan:
    """Read ``path`` as described above; columns in the order of the first file's header."""
    parts, names = [], []
    for header, files in sorted(headers(spark, path).items(), key=lambda kv: kv[1][0]):
        fields = next(csv.reader([header]))
        names += [c for c in fields if c not in names]
        schema = ", ".join(f"`{c}` string" for c in [*fields, CORRUPT])
        reader = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                  .option("enforceSchema", True).option("columnNameOfCorruptRecord", CORRUPT))
        if not path.endswith(".csv"):
            reader = reader.option("basePath", path)
        parts.append(reader.csv(files).withColumn(FILE, F.col("_metadata.file_path")))
    if not parts:
        raise ValueError(f"no CSV file in {path}")
    raw = parts[0]
    for p in parts[1:]:
        raw = raw.unionByName(p, allowMissingColumns=True)
    folders = [c for c in raw.columns if c not in (*names, CORRUPT, FILE)]
    types = file_types(raw, names)
    found = types.agg(*[F.collect_set(c).alias(c) for c in names]).first()  # at most every type of the ladder
    common = {c: widest([t for t in found[c] if t]) for c in names}
    rows = raw.select(*[F.trim(F.col(c)).cast(t).alias(c) if t != "string" else F.col(c)
                        for c, t in common.items()], *folders)
    return Scan(rows, types, common, raw)


def file_types(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per file: the narrowest type of each column; null where the file has no value."""
    aggs = []
    for c in names:
        value = F.col(c)
        narrow = F.lit(LADDER[-1])
        for t in reversed(LADDER[:-1]):
            narrow = F.when(F.bool_and(_fits(value, t)), t).otherwise(narrow)
        aggs.append(F.when(F.count(value) > 0, narrow).alias(c))
    return raw.groupBy(FILE).agg(*aggs)


def widest(types: Sequence[str]) -> str:
    """The narrowest type that holds values of all ``types``."""
    kinds = set(types)
    if not kinds:
        return "string"
    for family in (("int", "bigint", "double"), ("boolean",), ("date", "timestamp_ntz"), ("date", "timestamp_ntz", "timestamp")):
        if kinds <= set(family):
            return max(kinds, key=family.index)
    return "string"

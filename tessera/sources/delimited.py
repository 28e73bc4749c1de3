"""Delimited text readers and writers with explicit schemas.

Readers follow the load statements of the reports and the k-means jobs:
comma separated, no header, no quote handling, blanks around a field do not
count, an empty field is null.  A line that does not fit the schema (fields
missing or left over, a number that is none) is kept with nulls (PERMISSIVE
mode), and :func:`checked` tells such lines apart, counts them by reason and
keeps them aside.  Writers produce plain ``sep``-joined
lines with empty text for null, like ``PigStorage``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PEOPLE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("nationality", T.StringType()),
    T.StructField("country_code", T.IntegerType()),
    T.StructField("hobby", T.StringType()),
])

LOGS = T.StructType([
    T.StructField("acc_id", T.IntegerType()),
    T.StructField("by_who", T.IntegerType()),
    T.StructField("what_page", T.IntegerType()),
    T.StructField("type_of_access", T.StringType()),
    T.StructField("access_time", T.StringType()),
])

ASSOCIATES = T.StructType([
    T.StructField("rel_id", T.IntegerType()),
    T.StructField("person_a", T.IntegerType()),
    T.StructField("person_b", T.IntegerType()),
    T.StructField("date_of_relation", T.StringType()),
    T.StructField("description", T.StringType()),
])

POINTS2D = T.StructType([
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
])

TRIPS = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("pickup_longitude", T.DoubleType()),
    T.StructField("pickup_latitude", T.DoubleType()),
    T.StructField("RatecodeID", T.IntegerType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("dropoff_longitude", T.DoubleType()),
    T.StructField("dropoff_latitude", T.DoubleType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])


#: column with the text of a line that does not fit the schema
CORRUPT = "_corrupt"
#: why a line does not fit, in the order they are tested
REASONS = ("missing field", "extra field", "bad value")


def _plain_csv(spark: SparkSession, schema: T.StructType, sep: str = ",", **more):
    return (spark.read.schema(schema)
            .options(sep=sep, header=False, mode="PERMISSIVE", **more)
            .option("quote", "")          # no quote handling
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Lines of ``path`` by ``schema``; what does not fit is null."""
    return _plain_csv(spark, schema, sep).csv(path)


@dataclass
class Checked:
    """A file whose lines are told apart: ``rows`` as the plain reader gives
    them, ``bad`` the lines that do not fit, with the reason and the names of
    the fields that are null."""
    rows: DataFrame
    bad: DataFrame
    lines: DataFrame

    def check(self, path: str | None = None) -> dict[str, int]:
        """Lines read and, by reason, those that do not fit.  One pass over
        the file counts all lines (an ``Observation`` rides on it) and writes
        the bad ones to ``path``, as tab separated reason, null fields and
        line, if a path is given.  It is a pass of its own, as what a job
        reads of the file may be less (a bounded probe) or more (two uses)."""
        seen = Observation("lines")
        bad = _bad(self.lines.observe(seen, F.count(F.lit(1)).alias("rows"), *[
            F.count_if(F.col("reason").eqNullSafe(F.lit(r))).alias(r) for r in REASONS]))
        if path is None:
            bad.write.format("noop").mode("overwrite").save()
        else:
            write_delimited(bad.select("reason", F.array_join("nulls", ";").alias("nulls"), "line"), path, sep="\t")
        return {k: int(v or 0) for k, v in seen.get.items()}


def _bad(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("reason").isNotNull()).select("reason", "nulls", F.col(CORRUPT).alias("line"))


def checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> Checked:
    """:func:`read_delimited` with its bad lines: the parser puts their text
    in a corrupt-record column."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = _plain_csv(spark, whole, sep, columnNameOfCorruptRecord=CORRUPT).csv(path)
    fields, n = F.size(F.split(CORRUPT, re.escape(sep))), len(schema.fields)
    why = F.when(fields < n, REASONS[0]).when(fields > n, REASONS[1]).when(F.size("nulls") > 0, REASONS[2])
    # the nulls of all fields are asked for, so all are parsed and none of their faults is missed
    raw = (raw.withColumn("nulls", F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in schema.names])))
           .withColumn("reason", F.when(F.col(CORRUPT).isNotNull(), why)))
    return Checked(read_delimited(spark, path, schema, sep), _bad(raw), raw)


def read_people(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, PEOPLE)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, LOGS)


def read_associates(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, ASSOCIATES)


def read_points2d(spark: SparkSession, path: str) -> DataFrame:
    """``x,y`` lines; a line without two integers is a row with nulls, which
    the jobs skip and count."""
    return read_delimited(spark, path, POINTS2D)


MAX_SEEDS = 100_000


class Seeds(list):
    """Seeds in file order; ``skipped`` lines were none."""
    skipped = 0


def _seeds(parsed: DataFrame, path: str, row) -> Seeds:
    """The valid rows of a seed file, in file order.  A seed file holds k
    lines; one with more than ``MAX_SEEDS`` is refused rather than collected."""
    rows = parsed.limit(MAX_SEEDS + 1).collect()
    if len(rows) > MAX_SEEDS:
        raise ValueError(f"{path}: more than {MAX_SEEDS} seed lines; is this the points file?")
    out = Seeds(row(r) for r in rows if r["valid"])
    out.skipped = len(rows) - len(out)
    return out


def parse_seeds2d(lines: DataFrame, line: str = "value") -> DataFrame:
    """(x, y, valid) of ``x,y`` lines; further fields are ignored."""
    parts = F.split(line, ",")
    x, y = (F.trim(F.get(parts, F.lit(i))).try_cast("int") for i in (0, 1))
    return lines.select(x.alias("x"), y.alias("y")).withColumn("valid", F.col("x").isNotNull() & F.col("y").isNotNull())


def read_seeds2d(spark: SparkSession, path: str) -> Seeds:
    """Seed file in file order (k lines, the only data read to the driver);
    lines without two integers are skipped and counted."""
    return _seeds(parse_seeds2d(spark.read.text(path)), path, lambda r: (r["x"], r["y"]))


def parse_points_nd(lines: DataFrame, line: str = "value") -> DataFrame:
    """``coords`` of comma separated doubles; what is no number is a null
    element, and the jobs skip such vectors as they skip other lengths."""
    return lines.select(F.transform(F.split(F.trim(line), ","), lambda s: F.trim(s).try_cast("double")).alias("coords"))


def read_points_nd(spark: SparkSession, path: str) -> DataFrame:
    """One comma separated vector of doubles per line -> ``coords array<double>``."""
    return parse_points_nd(spark.read.text(path))


def parse_seeds_nd(lines: DataFrame, line: str = "value") -> DataFrame:
    """(cid, coords, valid) of ``id,c1,...,cd`` lines: the first field is the
    id, the slice behind it the vector."""
    parts = F.transform(F.split(F.trim(line), ","), lambda s: F.trim(s))
    coords = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda s: s.try_cast("double"))
    rows = lines.select(F.get(parts, F.lit(0)).try_cast("int").alias("cid"), coords.alias("coords"))
    whole = F.col("cid").isNotNull() & (F.size("coords") > 0) & F.forall("coords", lambda v: v.isNotNull())
    return rows.withColumn("valid", F.coalesce(whole, F.lit(False)))


def read_seeds_nd(spark: SparkSession, path: str) -> Seeds:
    """``id,c1,...,cd`` lines in file order; other lines are skipped and counted."""
    return _seeds(parse_seeds_nd(spark.read.text(path)), path, lambda r: (r["cid"], list(r["coords"])))


def read_assignments2d(spark: SparkSession, path: str) -> DataFrame:
    """``cx,cy<TAB>x,y`` lines (final cluster table) -> (cx, cy, x, y); what
    is missing or no integer is null, and the silhouette skips such rows."""
    return parse_assignments2d(spark.read.text(path))


def parse_assignments2d(lines: DataFrame, line: str = "value") -> DataFrame:
    parts = F.split(line, "\t")
    whole = F.when(F.size(parts) == 2, parts)
    c, p = F.split(F.get(whole, F.lit(0)), ","), F.split(F.get(whole, F.lit(1)), ",")
    number = lambda a, i: F.trim(F.get(a, F.lit(i))).try_cast("int")
    return lines.select(number(c, 0).alias("cx"), number(c, 1).alias("cy"), number(p, 0).alias("x"), number(p, 1).alias("y"))


def read_trips(spark: SparkSession, path: str, schema: T.StructType = TRIPS) -> DataFrame:
    """Trip CSV with a header.  Columns are matched by header name, not by
    position, and typed by ``schema`` (unparsable values become null); columns
    the schema does not know are kept as text."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[F.trim(F.col(f"`{c}`")).try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                        for c in raw.columns])


def to_lines(df: DataFrame, sep: str = ",") -> DataFrame:
    """One text column: fields joined by ``sep``, null as empty text."""
    return df.select(to_lines_column(df.columns, sep))


def to_lines_column(columns: list[str], sep: str = ",") -> Column:
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(sep, *fields).alias("value")


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Headerless delimited text, replacing (or, with ``mode='ignore'``,
    keeping) what is at ``path``."""
    to_lines(df, sep).write.mode(mode).text(path)


def write_assignments2d(df: DataFrame, path: str, mode: str = "overwrite", grouped: bool = False) -> None:
    """Final cluster table as ``cx,cy<TAB>x,y`` lines.  ``grouped`` lays the
    lines out by cluster (the reducer-side layout); it is a ``rebalance`` on
    the cluster, so AQE splits a cluster holding a third of all points over
    several files instead of one task."""
    if grouped:
        df = df.hint("rebalance", "cx", "cy")
    line = F.concat(F.col("cx").cast("string"), F.lit(","), F.col("cy").cast("string"), F.lit("\t"),
                    F.col("x").cast("string"), F.lit(","), F.col("y").cast("string"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_history(history: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Centroids of every round, one folder per ``iteration``."""
    cols = [c for c in history.columns if c != "iteration"]
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    (history.select("iteration", F.concat_ws(",", *fields).alias("value"))
     .write.mode(mode).partitionBy("iteration").text(path))


def read_history(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """What :func:`write_history` wrote: ``columns`` (a DDL list) of every
    line, and ``iteration`` from the folder it lies in."""
    schema = T.StructType.fromDDL(columns)
    parts = F.split("value", ",")
    return spark.read.text(path).select(F.col("iteration").cast("int").alias("iteration"), *[
        F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def write_trips(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Trip CSV with a header, as :func:`read_trips` reads it."""
    df.write.mode(mode).option("header", True).csv(path)

"""Reading, describing and writing warehouse tables and result files."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato import schemas
from merkato.session import store


class Warehouse:
    """The warehouse tables as Parquet folders under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._derived: dict[str, tuple[int, DataFrame]] = {}
        #: What operators keep for this warehouse beside its tables; dropped when a table is saved.
        self.parts: dict[str, object] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, self.path(name), stored_schema(name))

    def save(self, name: str, df: DataFrame, replace: bool = False) -> None:
        create_table(name, df, self.path(name), "overwrite" if replace else "errorifexists")
        self._derived.clear()
        self.parts.clear()

    def stamp(self, names: list[str]) -> int:
        """A number that changes when the files of the named tables do, whoever wrote them. For dimensions: it lists their files."""
        return hash(tuple(sorted(file for name in names for file in self.table(name).inputFiles())))

    def derived(self, name: str, build, tables: list[str]) -> DataFrame:
        """A table computed from the named tables, written on first use and again once these have other files.

        Read from files it has a known size, by which Spark decides whether to broadcast it.
        """
        stamp = self.stamp(tables)
        if name not in self._derived or self._derived[name][0] != stamp:
            self._derived[name] = stamp, store(build(), name)
        return self._derived[name][1]


def stored_schema(name: str) -> T.StructType:
    schema = schemas.TABLES[name]
    if name == "FactSale":
        return T.StructType([*schema.fields, T.StructField(schemas.PARTITIONS[name], T.IntegerType())])
    return schema


def create_table(name: str, df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one table in its declared column types and physical layout.

    ``mode="overwrite"`` replaces it; what is written may be computed from the table itself, as it is written apart first.

    The rebalance hint gathers each month's rows into few files, and lets adaptive
    execution split a month that is too big for one task.
    """
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[name].fields])
    if mode == "overwrite":
        typed = store(typed, name)
    partition = schemas.PARTITIONS.get(name)
    if name == "FactSale":
        typed = typed.withColumn(partition, F.expr("cast(DimTimeKey div 100 as int)"))
    if partition:
        typed.hint("rebalance", partition).write.mode(mode).partitionBy(partition).parquet(path)
    else:
        typed.write.mode(mode).parquet(path)


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None,
         columns: list[str] | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool | None = None) -> DataFrame:
    """A CSV file with header. Give the schema where it is known: inferring reads the file twice.

    With ``multi_line``, quoted values may hold line breaks; a file is then read by one task, otherwise by many. Where it is
    not said, the lines are searched first for a value that goes on in the next one.
    """
    if multi_line is None:
        multi_line = has_broken_lines(spark, path)
    how = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}  # quotes are doubled
    return spark.read.csv(path, **how, **({"schema": schema} if schema is not None else {"inferSchema": True}))


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether some line of a CSV file has an odd number of quotes, as those have in which a value begins that ends in another."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType,
                     multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """The records of a CSV file with header that fit ``schema``, and those that don't: ``(record, reason)``.

    A record is rejected when its number of values differs from the header's, when a value can't be read as its column's
    type, or when a column that may not be NULL is empty; the reason names the first of these. The file is read once,
    and both frames come from that reading.
    """
    broken, names = "_broken", schema.fieldNames()
    while broken in names:
        broken += "_"
    texts = T.StructType([T.StructField(name, T.StringType()) for name in [*names, broken]])
    raw = spark.read.csv(path, schema=texts, header=True, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE",
                         columnNameOfCorruptRecord=broken, enforceSchema=True)
    quoted = lambda name: F.col(f"`{name}`")
    reason = F.when(quoted(broken).isNotNull(), F.lit("wrong number of values"))
    for field in schema.fields:
        value = quoted(field.name)
        if not isinstance(field.dataType, T.StringType):
            reason = reason.when(value.isNotNull() & value.try_cast(field.dataType).isNull(), F.concat(
                F.lit(f"{field.name} is not {field.dataType.simpleString()}: "), value))
        if not field.nullable:
            reason = reason.when(value.isNull(), F.lit(f"{field.name} is empty"))
    record = F.coalesce(quoted(broken), F.to_csv(F.struct(*map(quoted, names)), {"quote": '"', "escape": '"'}))
    read = store(raw.select(*map(quoted, names), reason.alias("_reason"), F.when(reason.isNotNull(), record).alias("_record")), "csv")
    good = read.where(F.col("_reason").isNull()).select(*[quoted(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, read.where(F.col("_reason").isNotNull()).select(F.col("_record").alias("record"), F.col("_reason").alias("reason"))


def write_csv(df: DataFrame, folder: str, name: str, at: dt.datetime | None = None) -> str:
    stamp = (at or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{folder.rstrip('/')}/{name}_{stamp}.csv"
    df.write.csv(path, header=True, quote='"', escape='"')
    return path


def _describe(spark: SparkSession, paths: dict[str, str]):
    for name, path in paths.items():
        try:
            yield name, spark.read.parquet(path), None
        except AnalysisException as problem:
            yield name, None, (problem.getCondition() or str(problem))


def table_columns(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per table and column; a table that cannot be read gives one error row."""
    rows = []
    for name, df, problem in _describe(spark, paths):
        if df is None:
            rows.append((name, None, None, None, problem))
        else:
            rows += [
                (name, i, f.name, f.dataType.simpleString(), None) for i, f in enumerate(df.schema.fields, start=1)
            ]
    return spark.createDataFrame(
        rows, "table_name string, ordinal int, column_name string, data_type string, error string"
    )


def table_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per table with its row count, or the reason it cannot be read."""
    parts = []
    for name, df, problem in _describe(spark, paths):
        source = spark.range(1).select(F.lit(None).cast("long").alias("row_count")) if df is None else df.agg(
            F.count("*").alias("row_count")
        )
        parts.append(source.select(
            F.lit(name).alias("table_name"), "row_count", F.lit(problem).cast("string").alias("error")
        ))
    return union_all(parts)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Row-wise union by name, keeping duplicates."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def find_column(df: DataFrame, *names: str) -> str | None:
    """The column whose trimmed name equals one of ``names`` in any case, first name first."""
    plain = lambda text: text.strip().lower()
    by_name = {plain(column): column for column in reversed(df.columns)}
    return next((by_name[plain(name)] for name in names if plain(name) in by_name), None)


def preview(df: DataFrame, keys: list[str], rows: int = 100) -> DataFrame:
    return df.orderBy(*keys).limit(rows)


def vector_to_json(vector: Column) -> Column:
    return F.to_json(vector)


def json_to_vector(text: Column) -> Column:
    return F.from_json(text, "array<double>")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


SEGMENT_KEYS = ["DateKey", "MarketNameKey"]


def merge_segments(target: DataFrame, source: DataFrame, now: Column, sequence: str | None = None) -> DataFrame:
    """Rows of ``target`` after the upsert: a matched key takes all source values and ``CreatedAt = now``.

    Where the source repeats a key, the row with the highest ``sequence`` wins; without
    one, the greatest row does, so that a replay gives the same result.
    """
    values = [c for c in target.columns if c not in SEGMENT_KEYS and c != "CreatedAt"]
    rank = ([F.col(sequence)] if sequence else []) + [F.col(c) for c in values]
    fresh = source.groupBy(*SEGMENT_KEYS).agg(
        F.max_by(F.struct(*values), F.struct(*rank)).alias("_row")
    ).select(*SEGMENT_KEYS, "_row.*", now.alias("CreatedAt")).select(*target.columns)
    return target.join(fresh, SEGMENT_KEYS, "left_anti").unionByName(fresh)


def upsert_segments(spark: SparkSession, path: str, source: DataFrame, now: Column,
                    sequence: str | None = None) -> None:
    """Upsert into the stored segment table, rewriting only the days the source touches.

    The merged days are first written to the shared folder, so the write that replaces
    them never reads what it replaces and can be repeated after a failure. Columns that
    the source lacks are NULL.
    """
    name = "FactMarketSegmentation"
    try:
        target = scan(spark, path, schemas.TABLES[name])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        target = spark.createDataFrame([], schemas.TABLES[name])
    typed = source.select(
        *[(F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in schemas.TABLES[name].fields],
        *([sequence] if sequence else []),
    )
    days = typed.select("DateKey").distinct()
    touched = target.join(days, "DateKey", "left_semi")
    merged = store(merge_segments(touched, typed, now, sequence), "segments")
    merged.hint("rebalance", "DateKey").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("DateKey").parquet(path)

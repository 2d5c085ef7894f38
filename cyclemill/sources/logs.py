"""Raw run-to-failure text files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemill.operators.columns import SETTING_COLUMNS, drop_positions
from cyclemill.operators.ordering import number_rows

# fixed values: the published file names and their experiment units
FILE_NAME = "{kind}_FD{unit}.txt"
UNITS = ("001", "002", "003", "004")
# engines of a unit are numbered below this
UNIT_STEP = 1_000_000_000


def log_schema(readings: int = 21, blanks: int = 2) -> T.StructType:
    """Fields of one line. Lines end in two blanks, which read as two empty fields."""
    fields = [T.StructField(c, T.IntegerType()) for c in ("id", "cycle")]
    fields += [T.StructField(c, T.DoubleType()) for c in SETTING_COLUMNS]
    fields += [T.StructField(f"s{i}", T.DoubleType()) for i in range(1, readings + 1)]
    fields += [T.StructField(f"_blank{i}", T.StringType()) for i in range(1, blanks + 1)]
    return T.StructType(fields)


def read_log(spark: SparkSession, folder: str, split: str, unit: str = "001", readings: int = 21) -> DataFrame:
    """Cycle log of one unit and split.

    A line with too few or too many fields fails the query, and so does a value of
    the wrong type in a column that the query reads.
    """
    schema = log_schema(readings)
    # the parser sees all fields, or it would not notice a line of the wrong length
    reader = spark.read.schema(schema).options(sep=" ", mode="FAILFAST", columnPruning=False)
    raw = reader.csv(f"{folder}/{FILE_NAME.format(kind=split, unit=unit)}")
    width = len(schema)
    named = drop_positions(raw, [width - 2, width - 1])
    return named.withColumns({"unit": F.lit(unit), "split": F.lit(split)})


BAD_LINES = "file string, line string"


def read_log_with_ledger(
    spark: SparkSession, folder: str, split: str, ledger: str, unit: str = "001", readings: int = 21, most: float = 0.01
) -> DataFrame:
    """As ``read_log``, but lines that cannot be read go to a table at ``ledger`` (file and line) and are left out.

    A line is bad if it has too few or too many fields or a value of the wrong type. More than the share ``most`` of bad lines
    fails the call, with the ledger written. The ledger of an earlier call is replaced.
    """
    schema = log_schema(readings)
    path = f"{folder}/{FILE_NAME.format(kind=split, unit=unit)}"
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where("line <> ''")
    parts = F.split("line", " ", -1)
    values = [F.get(parts, F.lit(i)) for i in range(len(schema))]
    named = lines.select("file", "line", F.size(parts).alias("_n"), *[v.alias(f"_v{i}") for i, v in enumerate(values)])
    cast = [F.expr(f"try_cast(_v{i} as {f.dataType.simpleString()})").alias(f.name) for i, f in enumerate(schema.fields)]
    typed = named.select("file", "line", "_n", *cast, *[F.col(f"_v{i}") for i in range(len(schema))])
    # an empty field is a null; any other that does not cast is bad
    wrong = F.lit(False)
    for i, f in enumerate(schema.fields):
        wrong = wrong | ((F.col(f"_v{i}") != "") & F.col(f.name).isNull())
    judged = typed.withColumn("_bad", (F.col("_n") != len(schema)) | F.coalesce(wrong, F.lit(False)))
    judged.where("_bad").select("file", "line").write.mode("overwrite").parquet(ledger)
    bad = spark.read.schema(BAD_LINES).parquet(ledger).count()
    whole = lines.count()
    if bad > most * whole:
        raise ValueError(f"{bad} of {whole} lines of {path} cannot be read; they are listed in {ledger}")
    good = judged.where("NOT _bad").select(*[f.name for f in schema.fields])
    width = len(schema)
    return drop_positions(good, [width - 2, width - 1]).withColumns({"unit": F.lit(unit), "split": F.lit(split)})


def read_bad_lines(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(BAD_LINES).parquet(ledger)


def entity_id(unit: str, engine: Column) -> Column:
    """One id for an engine of a unit: engines of different units never share it."""
    return (F.lit(int(unit) * UNIT_STEP) + engine).cast("long")


def read_units(spark: SparkSession, folder: str, split: str, units: Sequence[str] = UNITS) -> DataFrame:
    """Several units in one log. ``id`` tells engines of all units apart, ``engine`` is the number in the file.

    Everything downstream goes by ``id``, so units never mix.
    """
    logs = []
    for unit in units:
        log = read_log(spark, folder, split, unit).withColumnRenamed("id", "engine")
        logs.append(log.select(entity_id(unit, F.col("engine")).alias("id"), *log.columns))
    return reduce(DataFrame.unionByName, logs)


def read_truths(spark: SparkSession, folder: str, units: Sequence[str] = UNITS) -> DataFrame:
    """``(id, more)`` of several units, with the ids of ``read_units``."""
    truths = [read_truth(spark, folder, u).withColumn("id", entity_id(u, F.col("id"))) for u in units]
    return reduce(DataFrame.unionByName, truths)


def read_truth(spark: SparkSession, folder: str, unit: str = "001") -> DataFrame:
    """``(id, more)``: line i of the file is the true remaining life of entity i.

    Lines are ordered by the file block they came from and by their place in it,
    then numbered without passing them through one task.
    """
    lines = spark.read.text(f"{folder}/{FILE_NAME.format(kind='RUL', unit=unit)}").select(
        F.trim(F.regexp_replace("value", r"\s+", " ")).alias("text"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    numbered = number_rows(lines.where("text <> ''"), [], ["_block", "_line"], "_no")
    return numbered.select(F.col("_no").cast("int").alias("id"), F.col("text").cast("int").alias("more"))

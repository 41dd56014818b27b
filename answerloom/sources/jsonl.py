"""JSON-lines sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.functions.text import bind

META_FIELDS = ("url", "answer_id", "question_score", "answer_count")

META_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in META_FIELDS])

CORRUPT = "_corrupt"

# Q, A and the optional metadata. Metadata scalars are read as text and converted where they are used, so one odd
# value does not spoil its row.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("Q", T.StringType()),
        T.StructField("A", T.StringType()),
        T.StructField("meta", META_SCHEMA),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

INSTRUCTION_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in ("instruction", "input", "output")])

LOG_SCHEMA = T.StructType([T.StructField("step", T.LongType()), T.StructField("loss", T.DoubleType())])


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Question/answer lines in one pass. An unparseable line becomes a row with null Q and A."""
    return (
        spark.read.schema(RAW_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("allowSingleQuotes", "false")
        .json(path)
    )


def records(line: Column, schema: T.StructType) -> Column:
    """The JSON object a line holds, as an array of one; an empty or null array when it holds anything else.

    Reading the line as the content of an array is what finds text after the object, which a JSON reader that stops at
    the end of the first value would accept.
    """
    parsed = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")), T.ArrayType(schema), {"allowSingleQuotes": "false"}
    )
    return bind(parsed, lambda found: F.when(F.size(found) == 1, F.filter(found, lambda r: r.isNotNull())))


def read_tolerant(spark: SparkSession, path: str | list[str], schema: T.StructType = INSTRUCTION_SCHEMA) -> DataFrame:
    """The lines that hold a JSON object; blank and malformed lines are skipped."""
    return spark.read.text(path).select(F.inline(records(F.col("value"), schema)))


def read_training_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(step, loss) of the log records that carry a loss, by step."""
    log = spark.read.schema(LOG_SCHEMA).json(path)
    return log.filter(F.col("loss").isNotNull()).orderBy("step")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself, or ValueError naming the missing columns. Looks at the schema only."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    return df


def with_full_meta(df: DataFrame) -> DataFrame:
    """Give ``meta`` all four fields, as text; absent fields, or a ``meta`` that is no struct, read as null."""
    kind = df.schema["meta"].dataType if "meta" in df.columns else None
    present = set(kind.fieldNames()) if isinstance(kind, T.StructType) else set()

    def field(name: str) -> Column:
        value = F.col("meta").getField(name) if name in present else F.lit(None)
        return value.cast("string").alias(name)

    return df.withColumn("meta", F.struct(*[field(f) for f in META_FIELDS]))

"""Raw question/answer lines read as VARIANT, for input whose ``meta`` is not what it should be.

Spark's JSON reader with a fixed schema gives a row without text where ``meta`` is a string or an array, and drops fields it
does not know without a word. Here a line is parsed as it is. Question, answer and metadata are taken out where they
have a usable type, and the fields and types that a corpus holds can be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.sources.jsonl import CORRUPT, META_FIELDS

KNOWN = ("Q", "A", "meta", *(f"meta.{f}" for f in META_FIELDS))
ABSENT, OTHER = "absent", "other"


def parse_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, line): the lines that are not blank, and each as a VARIANT; null where a line is not JSON."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select("value", F.try_parse_json("value").alias("line"))


def _kind(variant: Column) -> Column:
    """object, array, string, number, boolean, null or absent."""
    schema = F.schema_of_variant(variant)
    return (
        F.when(variant.isNull(), ABSENT)
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "VOID", "null")
        .when(schema.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), "number")
        .otherwise(OTHER)
    )


def _object(variant: Column) -> Column:
    """A VARIANT that is an object, or a string that holds one; null for anything else."""
    inside = F.try_parse_json(F.when(_kind(variant) == "string", F.try_variant_get(variant, "$", "string")))
    return F.when(_kind(variant) == "object", variant).when(_kind(inside) == "object", inside)


def read_raw_variant(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(Q, A, meta, meta_kind, _corrupt): a row per line that is not blank.

    ``meta`` has its four fields as text, taken from an object or from a string that holds one; whatever else it is, the row
    stays and the fields are null. ``meta_kind`` tells what it was. A line that is no object is kept in ``_corrupt`` and has
    neither question nor answer. Texts that are no strings read as their JSON text would.
    """
    rows = parse_lines(spark, path).withColumn("is_object", _kind(F.col("line")) == "object")
    rows = rows.withColumn("line", F.when(F.col("is_object"), F.col("line")))
    rows = rows.withColumn("given", F.try_variant_get("line", "$.meta", "variant"))
    rows = rows.withColumn("meta_kind", _kind(F.col("given"))).withColumn("given", _object(F.col("given")))

    def text(variant: str, name: str) -> Column:
        value = F.try_variant_get(F.col(variant), f"$.{name}", "variant")
        return F.when(_kind(value).isin("object", "array"), F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))

    meta = F.struct(*[text("given", f).alias(f) for f in META_FIELDS])
    return rows.select(
        text("line", "Q").alias("Q"), text("line", "A").alias("A"), meta.alias("meta"), "meta_kind", F.when(~F.coalesce("is_object", F.lit(False)), F.col("value")).alias(CORRUPT)
    )


def field_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(field, kind, n, known): how often each field of a line or of its ``meta`` holds a value of each kind.

    One pass; what is shuffled is a row per task, field and kind.
    """
    lines = parse_lines(spark, path).filter(_kind(F.col("line")) == "object").select("line")
    lines = lines.select(F.explode(F.array(F.struct(F.lit("").alias("prefix"), F.col("line").alias("of")), F.struct(F.lit("meta.").alias("prefix"), _object(F.try_variant_get("line", "$.meta", "variant")).alias("of")))).alias("x"))
    lines = lines.select("x.prefix", "x.of").filter("of IS NOT NULL")
    fields = lines.lateralJoin(spark.tvf.variant_explode(F.col("of").outer()))
    fields = fields.select(F.concat("prefix", "key").alias("field"), _kind(F.col("value")).alias("kind"))
    counted = fields.groupBy("field", "kind").agg(F.count("*").alias("n"))
    return counted.withColumn("known", F.col("field").isin(*KNOWN))

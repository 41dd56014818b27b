"""Question/answer, log and prediction views over the given tables, for queries and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.text import with_cleaned
from answerloom.operators.filters import drop_empty, filter_length, filter_score, with_lengths
from answerloom.operators.shape import with_keys
from answerloom.plans.prepare import Prepared, prepare


# Rows are numbered by conversation and turn, copies of a row in ranges of their own.
ID_STEP = 10**7
COPY_STEP = 10**17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def qa_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn right after it, and copies of some rows; metadata as flat columns.

    Tags, TeX delimiters, blank runs, missing metadata, scores that are no numbers, copies with another url, copies
    with another question, blank questions and missing answers are put in by ``conv_id``.
    """
    turns = table(spark, sf_dir, "conversations")
    user = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("q0"))
    answer = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a0")
    )
    conv = F.col("conv_id")
    no_meta = conv % 10 == 3
    pairs = user.join(answer, ["conv_id", "turn"]).select(
        "conv_id",
        (conv * ID_STEP + F.col("turn")).alias("row_id"),
        F.when(conv % 4 == 0, F.concat(F.lit("<p>"), "q0", F.lit("</p>")))
        .when(conv % 4 == 1, F.concat("q0", F.lit(" \\(x^2\\)")))
        .when(conv % 4 == 2, F.concat("q0", F.lit("  \r\n\n\n\n\n\\[y=1\\]")))
        .otherwise(F.col("q0"))
        .alias("q"),
        F.when(conv % 3 == 0, F.concat(F.lit("$$z$$ "), "a0")).otherwise(F.col("a0")).alias("a"),
        F.when(~no_meta, F.concat(F.lit("https://q.example/"), conv.cast("string"))).alias("url"),
        F.when(~no_meta, F.col("turn").cast("string")).alias("answer_id"),
        F.when(conv % 7 == 0, "n/a").otherwise(((conv * 13 + F.col("turn") * 7) % 60).cast("string")).alias("score"),
        (conv % 5).cast("string").alias("answer_count"),
    )

    def copy(applies: Column, shift: int, q: Column = F.col("q"), a: Column = F.col("a"), url: Column = F.col("url")):
        row = F.struct((F.col("row_id") + shift).alias("row_id"), q.alias("Q"), a.alias("A"), url.alias("url"))
        return F.when(applies, row)

    copies = F.array(
        copy(F.lit(True), 0),
        copy(conv % 5 == 0, 1 * COPY_STEP, url=F.concat("url", F.lit("?copy"))),
        copy(conv % 5 == 1, 2 * COPY_STEP, q=F.concat(F.lit("Re: "), "q")),
        copy(conv % 20 == 0, 3 * COPY_STEP, q=F.lit("   ")),
        copy(conv % 20 == 1, 4 * COPY_STEP, a=F.lit(None).cast("string")),
    )
    rows = pairs.select(F.explode(F.array_compact(copies)).alias("r"), "answer_id", "score", "answer_count")
    return rows.select(
        "r.row_id", "r.Q", "r.A", "r.url", "answer_id", F.col("score").alias("question_score"), "answer_count"
    )


def qa_documents(spark: SparkSession, sf_dir: str, chars: int = 1200, question: int = 200) -> DataFrame:
    """Raw rows cut from ``documents``, many more than conversations give: each run of ``chars`` characters is a question
    and its answer, with metadata by position; rows of copied documents are copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    runs = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.floor(F.length("text") / chars).cast("int"))).alias("k"))
    run = F.substring(F.col("text"), F.col("k") * chars + 1, F.lit(chars))
    meta = F.struct(
        F.concat(F.lit("https://d.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("k").cast("string").alias("answer_id"),
        ((F.col("doc_id") * 13 + F.col("k") * 7) % 60).cast("string").alias("question_score"),
        (F.col("doc_id") % 5).cast("string").alias("answer_count"),
    )
    runs = runs.select((F.col("doc_id") * ID_STEP + F.col("k")).alias("row_id"), run.alias("run"), meta.alias("meta"))
    return runs.select("row_id", F.substring("run", 1, question).alias("Q"), F.expr(f"substring(run, {question + 1})").alias("A"), "meta")


def qa_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as raw input: Q, A and a ``meta`` record."""
    meta = F.struct("url", "answer_id", "question_score", "answer_count")
    return qa_flat(spark, sf_dir).select("row_id", "Q", "A", meta.alias("meta"))


def qa_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-empty rows with cleaned text, lengths and keys."""
    return with_keys(with_lengths(with_cleaned(drop_empty(qa_raw(spark, sf_dir)), "Q", "A")))


def qa_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that pass every row filter, before duplicates are removed."""
    rows = with_cleaned(filter_score(drop_empty(qa_raw(spark, sf_dir))), "Q", "A")
    return with_keys(filter_length(with_lengths(rows)))


_runs: dict[tuple[str, str], Prepared] = {}
asked: list[tuple[str, str]] = []  # every request, for the bench to tell which queries read a kept run


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """The preparation job's result; one run per application and scale serves all queries that read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    asked.append(key)
    if key not in _runs:
        _runs[key] = prepare(qa_raw(spark, sf_dir), row_id="row_id")
    return _runs[key]


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, model, instruction, reference, prediction): an answer is the reference for its question, and the
    next answer of the conversation stands in for the models' predictions.

    The last answer of a conversation has no next one, so its predictions are missing, but for those that copy the
    reference. Some samples are answered by one model only, by ``conv_id``.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    answers = turns.filter("role = 'assistant'")
    question = turns.filter("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("instruction")
    )
    later = answers.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("next"))
    conv = F.col("conv_id")
    math = F.when(conv % 4 == 0, "\n$$a=1$$ $$b$$ $$c$$").when(conv % 4 == 1, "\n\\frac\\sum x").otherwise("")
    steps = F.when(conv % 3 == 0, "\n1. one\n - two\n3) three").when(conv % 3 == 1, " First, step 1. Finally, STEP 2")
    tuned = F.when(conv % 10 == 0, F.concat(F.lit("The "), "reference", F.lit(" ."))).otherwise(
        F.concat("next", F.lit(" "), "instruction", F.coalesce(steps, F.lit("")))
    )
    samples = answers.join(question, ["conv_id", "turn"]).join(later, ["conv_id", "turn"], "left")
    rows = F.array(
        F.when(conv % 9 != 4, F.struct(F.lit("base").alias("model"), F.concat("next", math).alias("prediction"))),
        F.when(conv % 9 != 7, F.struct(F.lit("tuned").alias("model"), tuned.alias("prediction"))),
    )
    return samples.withColumnRenamed("text", "reference").select(
        (conv * ID_STEP + F.col("turn")).alias("sample_id"), "instruction", "reference", F.inline(F.array_compact(rows))
    )


def instruction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as JSON lines in order, some preceded by a blank line and some cut off so that they do not parse."""
    record = F.to_json(F.struct(F.col("text").alias("instruction"), F.lit("").alias("input"), F.col("role").alias("output")))
    cut = F.when(F.col("conv_id") % 7 == 0, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    line = F.when(F.col("conv_id") % 9 == 0, F.concat(F.lit("\n"), cut)).otherwise(cut)
    turns = table(spark, sf_dir, "conversations").withColumn("record", record)
    return turns.orderBy("conv_id", "turn").select(line.alias("value"))


def odd_meta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines whose ``meta`` is an object, a string that holds one, another string, an array, or absent beside a ``tag``."""
    fields = F.struct("url", "answer_id", "question_score", "answer_count")
    kinds = (fields.alias("meta"), F.to_json(fields).alias("meta"), F.lit("none given").alias("meta"), F.array(F.lit(1), F.lit(2)).alias("meta"), F.lit(1).alias("tag"))
    lines = [F.to_json(F.struct("Q", "A", kind)) for kind in kinds]
    which = F.floor(F.col("row_id") % COPY_STEP / ID_STEP) % len(kinds)
    return qa_flat(spark, sf_dir).select(F.element_at(F.array(*lines), (which + 1).cast("int")).alias("value"))

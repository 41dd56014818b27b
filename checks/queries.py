"""One query per operator, over the given tables."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions import scoring, text
from answerloom.functions.features import dollar_count, has_display_math
from answerloom.operators import chat, dedup, evaluate, filters, linked, packing, profile, quota, shape, sketches, split
from answerloom.plans import chat_corpus
from answerloom.plans.prepare import CLEAN_COLUMNS
from answerloom.sources import jsonl, lines, publish, sinks, variants
from answerloom.storage import materialize, new_path
from answerloom.streaming import clean as streaming
from checks.views import (
    instruction_lines,
    odd_meta_lines,
    predictions,
    prepared,
    qa_cleaned,
    qa_flat,
    qa_raw,
    qa_scored,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HEAD, SKIP, TAKE = 200, 200, 100
SHARDS = 8
EDGES = [0, 100, 500, 1_000, 2_000, 4_000, 1_000_000]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Sources


@query
def scan_jsonl_roundtrip(spark, sf_dir):
    path = new_path(spark, "raw-json")
    qa_raw(spark, sf_dir).select("Q", "A", "meta").write.json(path)
    return jsonl.read_raw(spark, path).select("Q", "A", "meta.*")


@query
def meta_backfill(spark, sf_dir):
    partial = qa_flat(spark, sf_dir).select(
        "row_id", F.struct("answer_count", F.col("question_score")).alias("meta")
    )
    return jsonl.with_full_meta(partial).select("row_id", "meta.*")


def _lines_path(spark, sf_dir):
    path = new_path(spark, "instruction-lines")
    instruction_lines(spark, sf_dir).write.text(path)
    return path


@query
def scan_tolerant(spark, sf_dir):
    return jsonl.read_tolerant(spark, _lines_path(spark, sf_dir))


@query
def scan_numbered(spark, sf_dir):
    return lines.read_numbered(spark, _lines_path(spark, sf_dir))


@query
def head_n(spark, sf_dir):
    return lines.head_rows(spark, _lines_path(spark, sf_dir), HEAD)


@query
def holdout_range(spark, sf_dir):
    return lines.holdout_rows(spark, _lines_path(spark, sf_dir), SKIP, TAKE)


@query
def head_holdout_disjoint(spark, sf_dir):
    return lines.head_and_holdout(spark, _lines_path(spark, sf_dir), HEAD, TAKE).select("line_no", "part", "instruction")


@query
def head_holdout_overlap(spark, sf_dir):
    """What a hold-out by physical lines shares with a head of valid lines, some lines being malformed."""
    path = _lines_path(spark, sf_dir)
    later = lines.holdout_rows(spark, path, HEAD, TAKE)
    return lines.overlap(lines.head_rows(spark, path, HEAD), later).select("line_no", "instruction")


def _odd_meta_path(spark, sf_dir):
    path = new_path(spark, "odd-meta")
    odd_meta_lines(spark, sf_dir).write.text(path)
    return path


@query
def scan_variant(spark, sf_dir):
    return variants.read_raw_variant(spark, _odd_meta_path(spark, sf_dir)).select("Q", "A", "meta.*", "meta_kind")


@query
def variant_fields(spark, sf_dir):
    return variants.field_counts(spark, _odd_meta_path(spark, sf_dir))


@query
def publish_roundtrip(spark, sf_dir):
    """What readers find after two publications and one that failed halfway."""
    rows = qa_flat(spark, sf_dir).select("row_id", "Q")
    root = new_path(spark, "published")
    for part in (0, 1, None):
        with contextlib.suppress(InterruptedError), publish.publication(spark, root) as folder:
            rows.filter(F.col("row_id") % 2 == (part or 0)).write.json(f"{folder}/rows")
            if part is None:
                raise InterruptedError
    return publish.read_published(spark, root, "rows", schema="row_id long, Q string")


def _training_log(spark, sf_dir):
    path = new_path(spark, "training-log")
    loss = F.when(F.col("event_type") == "click", F.col("value"))
    log = table(spark, sf_dir, "events").select(F.col("event_id").alias("step"), loss.alias("loss"), "event_type")
    log.write.json(path)
    return jsonl.read_training_log(spark, path)


@query
def loss_curve(spark, sf_dir):
    return _training_log(spark, sf_dir)


@query
def final_loss(spark, sf_dir):
    return evaluate.final_loss(_training_log(spark, sf_dir))


# Sinks


@query
def sink_clean_roundtrip(spark, sf_dir):
    path = new_path(spark, "clean-json")
    sinks.write_clean(prepared(spark, sf_dir).clean, path)
    return jsonl.read_tolerant(spark, path)


@query
def sink_splits_roundtrip(spark, sf_dir):
    path = new_path(spark, "splits-json")
    sinks.write_splits(prepared(spark, sf_dir).clean, path)
    return spark.read.schema("instruction string, input string, output string, split string").json(path)


@query
def sink_split_folders_roundtrip(spark, sf_dir):
    paths = {name: new_path(spark, name) for name in ("train", "validation", "test")}
    sinks.write_split_folders(prepared(spark, sf_dir).clean, paths)
    parts = [jsonl.read_tolerant(spark, path).withColumn("split", F.lit(name)) for name, path in paths.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _chat(spark, sf_dir):
    clean = prepared(spark, sf_dir).clean.select("row_id", *sinks.INSTRUCTION_COLUMNS)
    return chat.render_chat(chat.standardize_roles(chat.to_conversation(clean)))


def _turn_rows(df, *keys):
    return df.select(*keys, F.posexplode("conversations").alias("pos", "turn")).select(*keys, "pos", "turn.*")


@query
def sink_chat_roundtrip(spark, sf_dir):
    path = new_path(spark, "chat")
    sinks.write_chat(_chat(spark, sf_dir), path)
    return _turn_rows(spark.read.parquet(path), "row_id", "text")


@query
def funnel_report(spark, sf_dir):
    return prepared(spark, sf_dir).funnel


# Projections and filters


@query
def text_lengths(spark, sf_dir):
    return qa_cleaned(spark, sf_dir).select("row_id", "q_len", "a_len")


@query
def instruction_format(spark, sf_dir):
    return prepared(spark, sf_dir).clean.select("row_id", *CLEAN_COLUMNS)


@query
def record_uid(spark, sf_dir):
    raw = qa_raw(spark, sf_dir)
    return raw.select("row_id", shape.record_uid(F.col("meta.url"), F.col("meta.answer_id")).alias("uid"))


@query
def content_hash(spark, sf_dir):
    return qa_cleaned(spark, sf_dir).select("row_id", "content_hash")


@query
def drop_empty(spark, sf_dir):
    return filters.drop_empty(qa_raw(spark, sf_dir)).select("row_id", "Q", "A")


@query
def length_filter(spark, sf_dir):
    return filters.filter_length(qa_cleaned(spark, sf_dir)).select("row_id", "q_len", "a_len")


@query
def score_filter(spark, sf_dir):
    return filters.filter_score(qa_raw(spark, sf_dir)).select("row_id", F.col("meta.question_score").alias("score"))


# Text cleaning


@query
def nfc_normalize(spark, sf_dir):
    decomposed = F.replace(F.col("text"), F.lit("\u00e9"), F.lit("e\u0301"))
    docs = table(spark, sf_dir, "documents").select("doc_id", decomposed.alias("text"))
    return docs.select("doc_id", F.length("text").alias("raw_len"), text.nfc(F.col("text")).alias("text"))


@query
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


def _with_breaks(spark, sf_dir):
    """Documents with CR LF, lone CR, or trailing blanks and blank runs at their line ends."""
    breaks = F.element_at(
        F.array(F.lit("\r\n"), F.lit("\r"), F.lit(" \t\xa0\n \n\n\u3000\n\n"), F.lit("\n\r\n\n\n\n\n")),
        (F.col("doc_id") % 4 + 1).cast("int"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(" \n\u2003"), F.replace(F.col("text"), F.lit("\n"), breaks), breaks).alias("text")
    )


@query
def normalize_newlines(spark, sf_dir):
    return _with_breaks(spark, sf_dir).select("doc_id", text.normalize_newlines(F.col("text")).alias("text"))


@query
def collapse_blank_lines(spark, sf_dir):
    lf = text.normalize_newlines(F.col("text"))
    return _with_breaks(spark, sf_dir).select("doc_id", text.collapse_blank_lines(lf).alias("text"))


def _with_markup(spark, sf_dir):
    """The same documents with tags, TeX delimiters and zero-width characters put in, and accents decomposed."""
    t = F.col("text")
    for old, new in (
        (". ", " \\(a<b\\). "),
        (", ", "\u200b, \\[c>d\\] "),
        ("\u00e9", "e\u0301"),
        ("the ", "<i>the</i> "),
    ):
        t = F.replace(t, F.lit(old), F.lit(new))
    return _with_breaks(spark, sf_dir).select("doc_id", t.alias("text"))


@query
def normalize_latex(spark, sf_dir):
    return _with_markup(spark, sf_dir).select("doc_id", text.normalize_math(F.col("text")).alias("text"))


@query
def clean_text(spark, sf_dir):
    return text.with_cleaned(_with_markup(spark, sf_dir), "text")


@query
def latex_features(spark, sf_dir):
    both = text.combined(F.col("instruction"), F.col("output"))
    return prepared(spark, sf_dir).clean.select(
        "row_id", dollar_count(both).alias("latex_total"), has_display_math(both).alias("has_display")
    )


# Profile


def _profile(spark, sf_dir, part):
    rows = profile.features(prepared(spark, sf_dir).clean)
    counts = profile.value_counts(rows, "q_len", "a_len", "q_score", "latex_total")
    return {"rows": rows, "counts": counts}[part]


@query
def summary_stats(spark, sf_dir):
    return profile.summary(_profile(spark, sf_dir, "counts"))


@query
def display_share(spark, sf_dir):
    return profile.display_share(_profile(spark, sf_dir, "rows"))


@query
def length_quantiles(spark, sf_dir):
    return profile.quantiles(profile.value_counts(table(spark, sf_dir, "documents"), "n_chars"))


@query
def approx_length_quantiles(spark, sf_dir):
    """Whether the approximate 99th percentile lies between the exact 98th and the largest value."""
    docs = table(spark, sf_dir, "documents")
    found = profile.approx_quantiles(docs, "n_chars")
    exact = docs.agg(F.percentile("n_chars", F.lit(0.98)).alias("low"), F.max("n_chars").alias("high"))
    return found.crossJoin(F.broadcast(exact)).select("series", F.col("quantile").between(F.col("low"), F.col("high")).alias("within"))


RANK_ERROR = 0.01


@query
def sketch_quantiles(spark, sf_dir):
    """Quantiles of text lengths from sketches of four batches, one of them added twice, and whether their exact ranks are near."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    store = new_path(spark, "sketches")
    for batch in (0, 1, 2, 3, 1):
        sketches.add_batch(docs.filter(F.col("doc_id") % 4 == batch), store, str(batch), "n_chars")
    found = sketches.merged(spark, store)
    asked = sketches.sketch_quantiles(found, 0.01, 0.25, 0.5, 0.9, 0.99).join(found.select("series", "n"), "series")
    ranks = docs.crossJoin(F.broadcast(asked)).groupBy("series", "share", "n").agg(
        F.avg((F.col("n_chars") < F.col("quantile")).cast("int")).alias("below"), F.avg((F.col("n_chars") <= F.col("quantile")).cast("int")).alias("up_to")
    )
    near = (F.col("below") - RANK_ERROR <= F.col("share")) & (F.col("up_to") + RANK_ERROR >= F.col("share"))
    return ranks.select("series", "share", "n", near.alias("near"))


@query
def sketch_histogram(spark, sf_dir):
    """Whether each bin of a histogram from merged sketches is near the exact one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    halves = [sketches.sketch(docs.filter(F.col("doc_id") % 2 == half), "n_chars") for half in (0, 1)]
    found = sketches.sketch_histogram(sketches.merge(halves[0].unionByName(halves[1])), EDGES)
    inside = (F.col("n_chars") > F.col("lo")) | ((F.col("bin") == 0) & (F.col("n_chars") == F.col("lo")))
    exact = F.count_if(inside & (F.col("n_chars") <= F.col("hi")))
    rows = docs.crossJoin(F.broadcast(found)).groupBy("series", "bin", "lo", "hi", "n").agg(exact.alias("exact"), F.count("*").alias("rows"))
    near = F.abs(F.col("n") - F.col("exact")) <= 2 * RANK_ERROR * F.col("rows") + 1
    return rows.select("series", "bin", "lo", "hi", "exact", near.alias("near"))


@query
def length_histogram(spark, sf_dir):
    lengths = profile.value_counts(prepared(spark, sf_dir).clean, "q_len", "a_len")
    return profile.length_histogram(materialize(lengths, "value-counts"))


@query
def score_profile(spark, sf_dir):
    return profile.score_profile(_profile(spark, sf_dir, "rows"))


@query
def latex_density_profile(spark, sf_dir):
    return profile.density_profile(_profile(spark, sf_dir, "rows"))


@query
def truncation_risk(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.length("text").alias("chars"))
    return profile.truncation_risk(docs, "chars")


# Duplicates and splits


@query
def dedup_uid(spark, sf_dir):
    return dedup.dedup_uid(qa_scored(spark, sf_dir)).select("row_id", "uid")


@query
def dedup_content(spark, sf_dir):
    return dedup.dedup_content(qa_scored(spark, sf_dir)).select("row_id", "content_hash")


@query
def dedup_two_pass(spark, sf_dir):
    return dedup.dedup_two_pass(qa_scored(spark, sf_dir)).select("row_id", "uid", "content_hash")


@query
def dedup_linked(spark, sf_dir):
    """One row of all that a uid or a content hash connects; the third of the rows without metadata share a uid."""
    rows = materialize(qa_scored(spark, sf_dir).select("row_id", *dedup.KEY_COLUMNS), "scored-keys")
    return linked.dedup_linked(rows).select("row_id", "uid", "content_hash")


@query
def split_hash(spark, sf_dir):
    return prepared(spark, sf_dir).clean.select("row_id", "content_hash", "split")


@query
def split_random(spark, sf_dir):
    """Whether each row has one known split, and the same one in a second draw over the same written table."""
    rows = prepared(spark, sf_dir).clean.drop("split")
    first, second = (split.assign_split_random(rows).select("row_id", F.col("split").alias(name)) for name in ("a", "b"))
    both = first.join(second, "row_id", "full")
    return both.select("row_id", F.col("a").isin("train", "validation", "test").alias("known"), F.col("a").eqNullSafe(F.col("b")).alias("repeats"))


@query
def split_exact(spark, sf_dir):
    """The clean rows by exact shares."""
    rows = prepared(spark, sf_dir).clean.select("row_id", "content_hash")
    return quota.assign_split_exact(rows)


@query
def sample_exact(spark, sf_dir):
    """Half of the documents, by places that are selected and not sorted."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return quota.sample_exact(docs, "doc_id", docs.count() // 2)


@query
def split_counts(spark, sf_dir):
    return prepared(spark, sf_dir).split_counts()


@query
def leakage_audit(spark, sf_dir):
    before = split.assign_split(qa_scored(spark, sf_dir).select("uid", "content_hash"))
    after = prepared(spark, sf_dir).clean
    return split.leakage(before).withColumn("rows", F.lit("scored")).unionByName(
        split.leakage(after).withColumn("rows", F.lit("clean"))
    )


@query
def sample_k(spark, sf_dir):
    return split.sample_k(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "lang", "n_chars")


@query
def clean_stream(spark, sf_dir):
    """Raw rows that arrive in two parts and a copy of the first, each cleaned as a stream once it is there.

    A part is as many files as tasks write it, and the stream goes on from its checkpoint with the files that are new.
    """
    rows = qa_raw(spark, sf_dir).select("row_id", "Q", "A", "meta")
    path, out, state = (new_path(spark, name) for name in ("arriving", "cleaned", "stream-state"))
    for part in (0, 1, 0):
        rows.filter(F.col("row_id") % 2 == part).drop("row_id").write.mode("append").json(path)
        found = streaming.clean_stream(streaming.read_raw_stream(spark, path))
        streaming.write_clean_stream(found, out, state, "parquet").awaitTermination()
    return spark.read.parquet(out).select("content_hash")


# Chat records


@query
def to_conversation(spark, sf_dir):
    return _turn_rows(chat.to_conversation(prepared(spark, sf_dir).clean), "row_id")


@query
def standardize_roles(spark, sf_dir):
    return _turn_rows(chat.standardize_roles(chat.to_conversation(prepared(spark, sf_dir).clean)), "row_id")


@query
def render_chat(spark, sf_dir):
    return _chat(spark, sf_dir).select("row_id", "text")


@query
def render_multi_turn(spark, sf_dir):
    parts = chat.collect_turns(table(spark, sf_dir, "conversations"))
    return chat.render_chat(parts, end="<end>", part="part").select("conv_id", "part", "text")


@query
def unanswered_conversations(spark, sf_dir):
    return chat.without_answer(chat.join_parts(chat.collect_turns(table(spark, sf_dir, "conversations"))))


@query
def chat_from_split(spark, sf_dir):
    return chat_corpus.split_chat(prepared(spark, sf_dir)).select("row_id", "text")


@query
def eval_prompts_from_split(spark, sf_dir):
    return chat_corpus.split_prompts(prepared(spark, sf_dir))


@query
def render_prompt(spark, sf_dir):
    return chat.render_prompt(prepared(spark, sf_dir).clean).select("row_id", "prompt")


@query
def token_budget(spark, sf_dir):
    return chat.token_budget(_chat(spark, sf_dir), budget=128).select("row_id", "n_tokens", "fits")


@query
def token_budget_share(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    return chat.budget_share(chat.token_budget(docs))


@query
def pack_sequences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("tokens"))
    packs = chat.pack_sequences(docs, "doc_id", "tokens", SHARDS)
    return packs.withColumn("ids", F.array_join(F.transform("ids", lambda i: i.cast("string")), ","))


@query
def pack_in_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("tokens"))
    packs = packing.pack_in_order(docs, "doc_id", "tokens", chat.MAX_TOKENS)
    return packs.withColumn("ids", F.array_join(F.transform("ids", lambda i: i.cast("string")), ","))


@query
def collect_turns(spark, sf_dir):
    return _turn_rows(chat.collect_turns(table(spark, sf_dir, "conversations")), "conv_id", "part")


# Answer scoring


@query
def normalize_answer(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", scoring.normalize_answer(F.col("text")).alias("text"))


@query
def step_proxy(spark, sf_dir):
    return predictions(spark, sf_dir).select(
        "sample_id", "model", scoring.step_proxy(F.col("prediction")).alias("has_steps")
    )


def _scored(spark, sf_dir):
    return evaluate.score_pairs(predictions(spark, sf_dir))


@query
def rouge_l(spark, sf_dir):
    return _scored(spark, sf_dir).select("sample_id", "model", F.round("rougeL", 9).alias("rougeL"))


@query
def sql_functions(spark, sf_dir):
    scoring.register(spark)
    predictions(spark, sf_dir).createOrReplaceTempView("prediction_rows")
    return spark.sql(
        "SELECT sample_id, model, nfc(reference) AS reference, lcs_length(prediction, reference) AS lcs "
        "FROM prediction_rows"
    )


@query
def score_pairs(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "sample_id", "model", "reference", "prediction", "em", F.round("f1", 9).alias("f1"), "has_steps"
    )


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 9) for n in names})


@query
def score_summary(spark, sf_dir):
    return _rounded(evaluate.score_summary(_scored(spark, sf_dir)), *evaluate.METRICS)


@query
def score_compare(spark, sf_dir):
    return _rounded(evaluate.score_compare(evaluate.score_delta(_scored(spark, sf_dir))), "base", "tuned", "delta")


@query
def score_delta(spark, sf_dir):
    unique = evaluate.require_unique(predictions(spark, sf_dir), "model", "sample_id")
    deltas = evaluate.score_delta(evaluate.score_pairs(unique))
    return _rounded(deltas.select("sample_id", "paired", "base_f1", "tuned_f1", "delta"), "base_f1", "tuned_f1", "delta")


@query
def top_k_improved(spark, sf_dir):
    top = evaluate.top_improved(evaluate.score_delta(_scored(spark, sf_dir)))
    return _rounded(top, "base_f1", "tuned_f1", "base_rougeL", "tuned_rougeL", "delta")

"""One query per operator over its whole table, and the equivalent SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm import bpe, decontamination, embedding_dedup, exact_dedup, jaccard, mixing, ppm, quality, repair, sharding, substring, toxicity, whitening
from answerloom.llm.common import id_remainder, row_key, word_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = id_remainder("doc_id", 10)
    scores = ppm.score_texts(table(spark, sf_dir, "documents"), remainder != 0)
    return scores.withColumn("held_out", F.coalesce(remainder == 0, F.lit(False))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = exact_dedup.exact_duplicates(docs)
    digests = docs.select(row_key("doc_id", "text").alias("row_key"), exact_dedup.digest("text").alias("sha"))
    digests = digests.groupBy("row_key").agg(F.min("sha").alias("sha"))
    hexed = F.lower(F.hex("sha")).alias("text_sha256")
    return found.join(digests, "row_key").select("doc_id", "keep_id", "group_size", "kept", hexed)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = id_remainder("doc_id", 4)
    scores = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder != 2)
    return scores.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), word_count("text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.linked_vectors(table(spark, sf_dir, "embeddings"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = id_remainder("doc_id", 5)
    scores = toxicity.with_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), remainder != 0)
    return scores.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults put in by the checksum of ``conv_id:turn``; rows to be missing are marked ``gone``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = (F.crc32(F.concat(parts[0], F.lit(":"), parts[1])) % 20).alias("draw")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), draw)
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumn("copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return rows.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("draw") == 0).alias("gone"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(damaged(table(spark, sf_dir, "conversations")), gone="gone")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {q.__name__: q for q in (op1_substring_dedup, op2_ppm_scoring, op3_exact_dedup, op4_quality, op5_byte_bpe, op6_sharding, op7_mixing, op8_embedding_dedup, op9_jaccard_join, op10_toxicity, op11_decontamination, op12_conversation_repair, op13_whitening)}

# crc32 of the ASCII text {0} as SQL; ``crc.t`` holds the table of the 256 bytes.
CRC = "xor(4294967295, list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda x: ascii(x)::bigint), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])))"
CRC_TABLE = """crc AS MATERIALIZED (SELECT list(v ORDER BY n) AS t FROM (
          SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
          FROM range(256) AS r(n)))"""


def _least_edits() -> str:
    """The step over one row: states are the start, after s, after u, after a; each a struct of cost c and audit a, or null."""

    def plus(state: str, cost: str, edit: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}} END"

    before = {"z0": "s0", "z1": "s1"}
    before["z2"] = "list_min([s2, " + ", ".join(plus(f"s{k}", "2", "I") for k in (0, 1, 3)) + "])"
    before["z3"] = "list_min([s3, " + plus("s2", "2", "I") + ", " + ", ".join(plus(f"s{k}", "4", "II") for k in (0, 1)) + "])"
    closed = ", ".join(f"{v} AS {k}" for k, v in before.items())

    def step(state: int, sources: tuple[int, ...], initial: str) -> str:
        kept = ", ".join(f"CASE WHEN stays AND initial = '{initial}' THEN {plus(f'z{k}', 't', 'K')} END" for k in sources)
        turned = ", ".join(f"CASE WHEN stays THEN {plus(f'z{k}', '2 + t', 'R')} END" for k in sources) if initial != "s" else ""
        return "list_min([" + ", ".join(x for x in (plus(f"z{state}", "3", "D"), kept, turned) if x) + f"]) AS s{state}"

    after = ", ".join([plus("z0", "3", "D") + " AS s0", step(1, (0,), "s"), step(2, (0, 1, 3), "u"), step(3, (2,), "a")])
    return f"""
        w(g, i, s0, s1, s2, s3) AS (
          SELECT g, 0::bigint, {{'c': 0::bigint, 'a': ''}}, NULL::STRUCT(c BIGINT, a VARCHAR), NULL::STRUCT(c BIGINT, a VARCHAR), NULL::STRUCT(c BIGINT, a VARCHAR) FROM every
          UNION ALL
          SELECT g, i, {after} FROM (
            SELECT f.g, f.i, {closed}, f.fault NOT IN (1, 2) AS stays, (f.fault = 3)::int AS t, left(f.role, 1) AS initial
            FROM w JOIN f ON f.g = w.g AND f.i = w.i + 1)),
        best AS (SELECT g, list_min([z0, z3]) AS b FROM (SELECT g, i, {closed} FROM w) JOIN lasts USING (g, i))"""


ORACLES = {
    "op12_conversation_repair": f"""
        WITH RECURSIVE {CRC_TABLE},
        c AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                     concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' ')) AS k FROM conversations),
        every AS (SELECT DISTINCT g, conv_id FROM c),
        x AS MATERIALIZED (SELECT c.*, {CRC.format('k')} % 20 AS draw FROM c, crc),
        d AS (SELECT g, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                     CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN translate(text, '.!?', '') ELSE text END AS text
              FROM x, (VALUES (1), (2)) AS v(copy) WHERE draw <> 0 AND (copy = 1 OR draw = 3)),
        o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i,
                     right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final FROM d),
        f AS MATERIALIZED (SELECT *, CASE WHEN final = '' THEN 1 WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 2
                     WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                     lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) || left(role, 1) AS pair FROM o),
        lasts AS (SELECT g, coalesce(max(i), 0) AS i FROM every LEFT JOIN f USING (g) GROUP BY g),
        {_least_edits()},
        p AS (SELECT g, b.a AS audit, unnest(range(1, length(b.a) + 1)) AS p FROM best),
        e AS (SELECT g, p, audit[p] AS op, count(*) FILTER (audit[p] <> 'I') OVER (PARTITION BY g ORDER BY p) AS i,
                     count(*) FILTER (audit[p] <> 'D') OVER (PARTITION BY g ORDER BY p) AS q FROM p),
        r AS (SELECT e.g, e.q, e.op, f.role, CASE WHEN e.op = 'I' THEN '' ELSE f.text END AS text FROM e LEFT JOIN f ON f.g = e.g AND f.i = e.i WHERE e.op <> 'D'),
        s AS (SELECT g, max(CASE WHEN q = 1 AND op = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) AS s FROM r GROUP BY g),
        m AS (SELECT g, string_agg(CASE WHEN op = 'K' THEN role WHEN (q - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY q) AS body
              FROM r JOIN s USING (g) GROUP BY g),
        n AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                     count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                     count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY g)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit, sha256(coalesce(body, '')) AS repaired_sha256
        FROM every JOIN best USING (g) LEFT JOIN n USING (g) LEFT JOIN m USING (g)""",
    "op11_decontamination": """
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        b AS (
          SELECT coalesce(cast(item_id AS varchar), '') AS item, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        s AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
        x AS MATERIALIZED (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM s),
        p AS (SELECT r, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, (SELECT DISTINCT size FROM x) WHERE len(w) >= size),
        h AS MATERIALIZED (SELECT p.r, p.i, p.size, x.item FROM p JOIN x ON p.size = x.size AND array_to_string(p.w[p.i:p.i + p.size - 1], ' ') = x.win),
        n AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT r, i, size FROM h)) GROUP BY r),
        t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)""",
    "op1_substring_dedup": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        p AS (SELECT doc_id, w[i] AS word, i, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS win
              FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
        m AS (SELECT *, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 THEN 1 ELSE 0 END AS twice FROM p),
        c AS (SELECT *, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM m),
        k AS (SELECT doc_id, sum(gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, cast(coalesce(n, 0) AS bigint) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op9_jaccard_join": """
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM d),
        u AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
        l AS MATERIALIZED (
          SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
          GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
        SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(c.b, doc_id)) AS component_id
        FROM s LEFT JOIN c ON c.a = s.doc_id""",
    "op3_exact_dedup": """
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS n FROM documents),
        k AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM k""",
    "op8_embedding_dedup": """
        WITH RECURSIVE v AS (
          SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS MATERIALIZED (
          SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            AND list_cosine_similarity(a.e, b.e) >= 0.95),
        r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS b FROM r GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(c.b, e.vec_id)) AS component_id,
               e.vec_id <= coalesce(c.b, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op7_mixing": """
        WITH d AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                 md5('17|' || doc_id) AS key FROM documents),
        s AS (SELECT source, cast(sum(size) AS bigint) AS source_size,
                     row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
        w AS (SELECT *, place % 3 + 1 AS weight, source_size * 3 AS lim FROM s),
        c AS (SELECT *, cast(sum(source_size) OVER () AS bigint) AS total,
                     coalesce(cast(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bigint), 0) AS cut,
                     cast(sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bigint) AS sharing
              FROM w),
        r AS (SELECT *, CASE WHEN lim / weight >= (total - cut) / sharing THEN (total - cut) / sharing END AS rate FROM c),
        t AS (SELECT source, source_size, least(cast(lim AS double), weight * coalesce(max(rate) OVER (), 0.0)) AS target FROM r),
        p AS (SELECT d.*, source_size, target, cast(round(target) AS bigint) AS budget,
                     sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id) - size AS start
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
        SELECT doc_id, size, source_size, target,
               cast(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS bigint) AS taken
        FROM e""",
}

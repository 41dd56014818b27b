"""The same queries as plain SQL over the given tables."""

from __future__ import annotations

from answerloom.operators.chat import CHAT_TEMPLATE
from checks.queries import EDGES, HEAD, SHARDS, SKIP, TAKE

# Whitespace without the line feed, as an RE2 class body.
WS = (
    r"\t\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def text(value: str) -> str:
    """A SQL expression for a string with line breaks, backslashes or other special characters."""
    parts = []
    for plain, special in _runs(value):
        parts.append("'" + plain.replace("'", "''") + "'")
        if special:
            parts.append(f"chr({ord(special)})")
    return "(" + " || ".join(parts) + ")"


def _runs(value: str):
    plain = ""
    for c in value:
        if c in "\\\n\r\t" or ord(c) > 126:
            yield plain, c
            plain = ""
        else:
            plain += c
    yield plain, ""


def strip_tags(e: str) -> str:
    return f"regexp_replace({e}, '<[^>]+>', ' ', 'g')"


def newlines(e: str) -> str:
    return f"regexp_replace({e}, '\\r\\n?', chr(10), 'g')"


def blank_lines(e: str) -> str:
    e = f"regexp_replace({e}, '[{WS}]+\\n', chr(10), 'g')"
    e = f"regexp_replace({e}, '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')"
    return f"regexp_replace({e}, '\\A[{WS}\\n]+|[{WS}\\n]+\\z', '', 'g')"


def math(e: str) -> str:
    for old, new in (("[", "$$"), ("]", "$$"), ("(", "$"), (")", "$")):
        e = f"replace({e}, chr(92) || '{old}', '{new}')"
    return f"regexp_replace({e}, '[\\x{{200b}}\\x{{200c}}\\x{{200d}}\\x{{feff}}]', '', 'g')"


def clean(e: str) -> str:
    return math(blank_lines(newlines(strip_tags(f"nfc_normalize({e})"))))


def bucket(key: str, buckets: int | str, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}' || {key}), 1, 8))::bigint % {buckets})"


def split_name(key: str) -> str:
    b = bucket(key, 10000, "42|")
    return f"CASE WHEN {b} < 8000 THEN 'train' WHEN {b} < 9000 THEN 'validation' ELSE 'test' END"


QA = r"""
p AS (
  SELECT u.conv_id, u.conv_id * 10000000 + u.turn AS row_id,
         CASE u.conv_id % 4
           WHEN 0 THEN '<p>' || u.text || '</p>'
           WHEN 1 THEN u.text || ' ' || chr(92) || '(x^2' || chr(92) || ')'
           WHEN 2 THEN u.text || '  ' || chr(13) || chr(10) || chr(10) || chr(10) || chr(10) || chr(10)
                       || chr(92) || '[y=1' || chr(92) || ']'
           ELSE u.text END AS q,
         CASE WHEN u.conv_id % 3 = 0 THEN '$$z$$ ' || a.text ELSE a.text END AS a,
         CASE WHEN u.conv_id % 10 = 3 THEN NULL ELSE 'https://q.example/' || u.conv_id::varchar END AS url,
         CASE WHEN u.conv_id % 10 = 3 THEN NULL ELSE u.turn::varchar END AS answer_id,
         CASE WHEN u.conv_id % 7 = 0 THEN 'n/a'
              ELSE ((u.conv_id * 13 + u.turn * 7) % 60)::varchar END AS question_score,
         (u.conv_id % 5)::varchar AS answer_count
  FROM (SELECT *, lead(role) OVER w AS nrole, lead(turn) OVER w AS nturn FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.nturn
  WHERE u.role = 'user' AND u.nrole = 'assistant'),
qa AS (
  SELECT row_id, q AS Q, a AS A, url, answer_id, question_score, answer_count FROM p
  UNION ALL
  SELECT row_id + 100000000000000000, q, a, url || '?copy', answer_id, question_score, answer_count FROM p WHERE conv_id % 5 = 0
  UNION ALL
  SELECT row_id + 200000000000000000, 'Re: ' || q, a, url, answer_id, question_score, answer_count FROM p WHERE conv_id % 5 = 1
  UNION ALL
  SELECT row_id + 300000000000000000, '   ', a, url, answer_id, question_score, answer_count FROM p WHERE conv_id % 20 = 0
  UNION ALL
  SELECT row_id + 400000000000000000, q, NULL, url, answer_id, question_score, answer_count FROM p WHERE conv_id % 20 = 1)"""

CLEANED = f"""{QA},
filled AS (
  SELECT * FROM qa WHERE Q IS NOT NULL AND trim(Q) <> '' AND A IS NOT NULL AND trim(A) <> ''),
texts AS (
  SELECT row_id, {clean('Q')} AS Q, {clean('A')} AS A,
         coalesce(url, '') || '|' || coalesce(answer_id, '') AS uid,
         coalesce(try_cast(question_score AS integer), 0) AS q_score,
         coalesce(try_cast(answer_count AS integer), 0) AS a_count
  FROM filled),
cleaned AS (
  SELECT *, length(Q)::integer AS q_len, length(A)::integer AS a_len,
         md5(substr(Q, 1, 200) || substr(A, 1, 200)) AS content_hash, md5(Q || A) AS text_md5
  FROM texts)"""

DEDUP = f"""{CLEANED},
lengthed AS (SELECT * FROM cleaned WHERE q_len BETWEEN 40 AND 1500 AND a_len BETWEEN 100 AND 4000),
scored AS (SELECT * FROM lengthed WHERE q_score >= 5),
by_uid AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY q_score DESC, a_len DESC, text_md5, row_id) = 1),
by_content AS (
  SELECT * FROM by_uid
  QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY q_score DESC, a_len DESC, text_md5, row_id) = 1)"""

CLEAN = f"""{DEDUP},
clean AS (
  SELECT row_id, Q AS instruction, '' AS input, A AS output, q_len, a_len, q_score, a_count, uid, content_hash,
         {split_name('content_hash')} AS split
  FROM by_content)"""

FEATURES = f"""{CLEAN},
feats AS (
  SELECT *, (length(instruction || output) - length(replace(instruction || output, '$', '')))::integer AS latex_total,
         contains(instruction || output, '$$') AS has_display
  FROM clean)"""

LINES = """
rec AS (
  SELECT conv_id, turn, role, text,
         sum(CASE WHEN conv_id % 9 = 0 THEN 2 ELSE 1 END) OVER (ORDER BY conv_id, turn) - 1 AS line_no
  FROM conversations),
valid AS (
  SELECT line_no::bigint AS line_no, text AS instruction, '' AS input, role AS output,
         row_number() OVER (ORDER BY line_no) - 1 AS nth
  FROM rec WHERE conv_id % 7 <> 0)"""

LOSS = "loss AS (SELECT event_id AS step, value AS loss FROM events WHERE event_type = 'click')"

BREAKS = f"""
docs AS (
  SELECT doc_id, ' ' || chr(10) || chr(8195) || replace(text, chr(10), br) || br AS text
  FROM (SELECT *, CASE doc_id % 4
          WHEN 0 THEN {text(chr(13) + chr(10))}
          WHEN 1 THEN {text(chr(13))}
          WHEN 2 THEN {text(" " + chr(9) + chr(0xA0) + chr(10) + " " + chr(10) * 2 + chr(0x3000) + chr(10) * 2)}
          ELSE {text(chr(10) + chr(13) + chr(10) * 5)} END AS br FROM documents))"""


def _markup() -> str:
    e = "text"
    for old, new in (
        (". ", " \\(a<b\\). "),
        (", ", "\u200b, \\[c>d\\] "),
        ("\u00e9", "e\u0301"),
        ("the ", "<i>the</i> "),
    ):
        e = f"replace({e}, {text(old)}, {text(new)})"
    return f"{BREAKS}, marked AS (SELECT doc_id, {e} AS text FROM docs)"


PREDICTIONS = """
samples AS (
  SELECT r.conv_id * 10000000 + r.turn AS sample_id, r.conv_id, u.text AS instruction, r.text AS reference, n.text AS next
  FROM conversations r
  JOIN conversations u ON u.conv_id = r.conv_id AND u.turn = r.turn - 1 AND u.role = 'user'
  LEFT JOIN conversations n ON n.conv_id = r.conv_id AND n.turn = r.turn + 2 AND n.role = 'assistant'
  WHERE r.role = 'assistant'),
preds AS (
  SELECT sample_id, 'base' AS model, instruction, reference,
         next || CASE conv_id % 4 WHEN 0 THEN chr(10) || '$$a=1$$ $$b$$ $$c$$'
                                  WHEN 1 THEN chr(10) || chr(92) || 'frac' || chr(92) || 'sum x' ELSE '' END AS prediction
  FROM samples WHERE conv_id % 9 <> 4
  UNION ALL
  SELECT sample_id, 'tuned', instruction, reference,
         CASE WHEN conv_id % 10 = 0 THEN 'The ' || reference || ' .'
              ELSE next || ' ' || instruction ||
                   CASE conv_id % 3 WHEN 0 THEN chr(10) || '1. one' || chr(10) || ' - two' || chr(10) || '3) three'
                                    WHEN 1 THEN ' First, step 1. Finally, STEP 2' ELSE '' END END
  FROM samples WHERE conv_id % 9 <> 7)"""


def normalize(e: str) -> str:
    e = f"lower({e})"
    for _ in range(2):
        e = f"regexp_replace({e}, '(^|[^\\pL\\pN_])(a|an|the)([^\\pL\\pN_]|$)', '\\1 \\3', 'g')"
    e = f"regexp_replace({e}, '[!-/:-@\\[-`{{-~]', '', 'g')"
    return f"trim(regexp_replace({e}, '[{WS}\\n]+', ' ', 'g'))"


def tokens(e: str) -> str:
    return f"list_filter(string_split({e}, ' '), lambda x: x <> '')"


def rouge_tokens(e: str) -> str:
    return tokens(f"regexp_replace(lower({e}), '[^a-z0-9]+', ' ', 'g')")


def steps(e: str) -> str:
    # What counts as visible working.
    patterns = (
        r"\$\$[^$]+\$\$",
        r"\$[^$]+\$",
        r"(?m)^\s*(\d+[.):]|[-•*])\s",
        r"(?i)(step\s*\d+|first[,.]|second[,.]|third[,.]|finally[,.])",
        r"\\frac|\\sqrt|\\sum|\\int|\\cdot",
    )
    found = " OR ".join(f"length(regexp_extract_all({e}, '{p}')) >= 3" for p in patterns)
    return f"CASE WHEN {found} THEN 1 ELSE 0 END"


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two token lists.

    Runs over ``a`` and keeps, for every length, the smallest position of ``b`` at which a common subsequence of that
    length can end.
    """
    places = f"""list_transform({a}, lambda t: list_filter(
        list_transform({b}, lambda y, i: CASE WHEN y = t THEN i::integer END), lambda i: i IS NOT NULL))"""
    advance = """list_filter(list_transform(range(1, length(ends) + 2), lambda k:
        least(coalesce(ends[k], 2147483647),
              coalesce(list_min(list_filter(here, lambda j: j > CASE WHEN k = 1 THEN 0 ELSE ends[k - 1] END)), 2147483647))),
        lambda e: e < 2147483647)"""
    return f"length(list_reduce({places}, lambda ends, here: {advance}, []::integer[]))"


METRICS = f"""{PREDICTIONS},
norm AS (
  SELECT *, {normalize('prediction')} AS np, {normalize('reference')} AS nr,
         {rouge_tokens('prediction')} AS rp, {rouge_tokens('reference')} AS rr FROM preds),
counted AS (
  SELECT *, length({tokens('np')}) AS cp, length({tokens('nr')}) AS cr,
         coalesce(length(list_distinct(list_intersect({tokens('np')}, {tokens('nr')}))), 0) AS common FROM norm),
metrics AS (
  SELECT sample_id, model, instruction, reference, prediction, coalesce((np = nr)::integer, 0) AS em,
         CASE WHEN common > 0
              THEN 2.0::double * (common::double / cp) * (common::double / cr)
                   / ((common::double / cp) + (common::double / cr))
              ELSE 0.0::double END AS f1,
         {steps('prediction')}::integer AS has_steps, rp, rr FROM counted)"""

ROUGE = f"""{METRICS},
full_metrics AS (
  SELECT * EXCLUDE (rp, rr), CASE WHEN prediction IS NULL OR length(rp) + length(rr) = 0 THEN 0.0::double
         ELSE 2.0::double * {lcs('rr', 'rp')} / (length(rp) + length(rr)) END AS rougeL
  FROM metrics)"""


def exchange(names: tuple[str, str], columns: tuple[str, str], roles: tuple[str, str], carry: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT row_id, {carry}{i}::integer AS pos, '{roles[i]}' AS \"{names[0]}\", {columns[i]} AS {names[1]} FROM clean"
        for i in (0, 1)
    )


_before, _between = CHAT_TEMPLATE.split("{INPUT}")[0], CHAT_TEMPLATE.split("{INPUT}")[1].split("{OUTPUT}")[0]
CHAT_TEXT = f"({text(_before)} || instruction || {text(_between)} || output)"
PROMPT_TEXT = f"({text(_before)} || instruction || {text(_between)})"


def token_count(e: str) -> str:
    return f"length(regexp_extract_all({e}, '[^{WS}\\n]+'))"


def bucket_rows(value: str, source: str, buckets, columns: str) -> str:
    """One row per literal bucket, left-joined to the rows that fall into it."""
    rows = ", ".join(f"({lo}, {'NULL' if hi is None else hi}, '{label}')" for lo, hi, label in buckets)
    return f"""SELECT b.lo::integer AS lo, b.bucket, {columns}
FROM (VALUES {rows}) b(lo, hi, bucket)
LEFT JOIN {source} f ON f.{value} >= b.lo AND (b.hi IS NULL OR f.{value} < b.hi)"""


# The score and math-density buckets.
SCORES = [(0, 1, "0"), (1, 5, "1-4"), (5, 10, "5-9"), (10, 50, "10-49"), (50, 200, "50-199"), (200, None, "200+")]
DENSITY = [(0, 1, "0"), (1, 3, "1-2"), (3, 7, "3-6"), (7, 15, "7-14"), (15, 31, "15-30"), (31, None, "31+")]


def funnel() -> str:
    stages = ("qa", "filled", "lengthed", "scored", "by_uid", "by_content")
    names = ("raw", "empty", "length", "score", "uid", "content")
    counts = " UNION ALL ".join(
        f"SELECT {i}::integer AS step, '{n}' AS stage, count(*) AS remaining FROM {s}"
        for i, (n, s) in enumerate(zip(names, stages))
    )
    return f"""WITH {DEDUP}, counts AS ({counts}),
ins AS (SELECT *, coalesce(lag(remaining) OVER (ORDER BY step), remaining) AS rows_in,
               first_value(remaining) OVER (ORDER BY step) AS raw FROM counts)
SELECT step, stage, rows_in, rows_in - remaining AS dropped, remaining,
       CASE WHEN raw = 0 THEN 0.0::double ELSE 100.0::double * remaining / raw END AS retention_pct FROM ins"""


def summary() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS series, count(*) AS n, count_if({c} = 0)::bigint AS n_zero,
            sum({c})::double / count(*) AS mean, median({c})::double AS median, max({c})::bigint AS max FROM feats"""
        for c in ("q_len", "a_len", "q_score", "latex_total")
    )


def histogram() -> str:
    return f"""WITH {CLEAN}, vals AS (
  SELECT 'q_len' AS series, q_len AS v FROM clean UNION ALL SELECT 'a_len', a_len FROM clean),
q AS (SELECT series, quantile_cont(v::double, 0.99) AS q99 FROM vals GROUP BY 1),
t AS (SELECT max(q99) / 39.0::double AS step FROM q),
bins AS (SELECT q.series, q.q99, t.step, i::integer AS bin, i * t.step AS lo, (i + 1) * t.step AS hi
         FROM q, t, range(0, 39) r(i))
SELECT b.series, b.bin, b.lo, b.hi, count(v.v) AS n
FROM bins b LEFT JOIN vals v
  ON v.series = b.series AND least(v.v::double, b.q99) >= b.lo AND (least(v.v::double, b.q99) < b.hi OR b.bin = 38)
GROUP BY 1, 2, 3, 4"""


def leakage() -> str:
    parts = []
    for rows, source in (("scored", "audit"), ("clean", "clean")):
        for kind in ("uid", "content_hash"):
            parts.append(
                f"""SELECT '{kind}' AS key_kind, count(*) AS keys, count_if(k > 1)::bigint AS leaking_keys, '{rows}' AS rows
                FROM (SELECT {kind}, count(DISTINCT split) AS k FROM {source} GROUP BY 1)"""
            )
    audit = f"audit AS (SELECT uid, content_hash, {split_name('content_hash')} AS split FROM scored)"
    return f"WITH {CLEAN}, {audit} " + " UNION ALL ".join(parts)


def packs() -> str:
    return f"""WITH RECURSIVE items AS (
  SELECT doc_id, {token_count('text')} AS tokens,
         {bucket('doc_id::varchar', SHARDS, '')} AS shard
  FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS rn FROM items),
walk AS (
  SELECT shard, rn, doc_id, tokens, tokens AS filled, 0::bigint AS pack_id FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.shard, r.rn, r.doc_id, r.tokens,
         CASE WHEN w.filled + r.tokens > 512 THEN r.tokens ELSE w.filled + r.tokens END,
         CASE WHEN w.filled + r.tokens > 512 THEN w.pack_id + 1 ELSE w.pack_id END
  FROM walk w JOIN ranked r ON r.shard = w.shard AND r.rn = w.rn + 1)
SELECT shard, pack_id, string_agg(doc_id::varchar, ',' ORDER BY doc_id) AS ids, sum(tokens)::bigint AS n_tokens
FROM walk GROUP BY 1, 2"""


def multi_turn() -> str:
    preface, opening = _before.rsplit(chr(10) * 2, 1)
    gap = text(chr(10) * 2)
    return f"""WITH t AS (
  SELECT conv_id, turn // 64 AS part, turn, role, text, row_number() OVER w AS n, first_value(role) OVER w AS opener
  FROM conversations WINDOW w AS (PARTITION BY conv_id, turn // 64 ORDER BY turn)),
p AS (
  SELECT *, CASE WHEN part = 0 AND n = (CASE WHEN opener = 'system' THEN 2 ELSE 1 END) THEN '' ELSE {gap} END AS lead FROM t),
r AS (
  SELECT conv_id, part, turn, role,
         (CASE WHEN part = 0 AND n = 1 AND role <> 'system' THEN {text(preface)} || {gap} ELSE '' END) ||
         (CASE WHEN role = 'system' AND part = 0 AND n = 1 THEN text || {gap}
               WHEN role = 'system' THEN lead || text
               WHEN role = 'assistant' THEN {text(_between)} || text || '<end>'
               ELSE lead || {text(opening)} || text END) AS piece
  FROM p)
SELECT conv_id, part, string_agg(piece, '' ORDER BY turn) AS text
FROM r GROUP BY 1, 2"""


def improved() -> str:
    return f"""WITH {ROUGE},
d AS (SELECT b.sample_id, b.instruction, b.reference, b.prediction AS base_prediction, t.prediction AS tuned_prediction,
             b.f1 AS base_f1, b.rougeL AS base_rougeL, b.has_steps AS base_has_steps,
             t.f1 AS tuned_f1, t.rougeL AS tuned_rougeL, t.has_steps AS tuned_has_steps, t.f1 - b.f1 AS delta
      FROM full_metrics b JOIN full_metrics t ON t.sample_id = b.sample_id AND b.model = 'base' AND t.model = 'tuned')
SELECT row_number() OVER (ORDER BY delta DESC, sample_id)::integer AS rank, sample_id,
       substr(instruction, 1, 200) AS instruction, substr(reference, 1, 300) AS reference,
       substr(base_prediction, 1, 300) AS base_prediction, substr(tuned_prediction, 1, 300) AS tuned_prediction,
       round(base_f1, 9) AS base_f1, round(base_rougeL, 9) AS base_rougeL, base_has_steps,
       round(tuned_f1, 9) AS tuned_f1, round(tuned_rougeL, 9) AS tuned_rougeL, tuned_has_steps, round(delta, 9) AS delta
FROM d ORDER BY d.delta DESC, sample_id LIMIT 5"""


ORACLES: dict[str, str] = {
    "scan_jsonl_roundtrip": f"WITH {QA} SELECT Q, A, url, answer_id, question_score, answer_count FROM qa",
    "meta_backfill": f"""WITH {QA} SELECT row_id, NULL::varchar AS url, NULL::varchar AS answer_id,
        question_score, answer_count FROM qa""",
    "scan_variant": f"""WITH {QA}, k AS (SELECT *, (row_id % 100000000000000000) // 10000000 % 5 AS k FROM qa)
        SELECT Q, A, CASE WHEN k < 2 THEN url END AS url, CASE WHEN k < 2 THEN answer_id END AS answer_id,
               CASE WHEN k < 2 THEN question_score END AS question_score, CASE WHEN k < 2 THEN answer_count END AS answer_count,
               ['object', 'string', 'string', 'array', 'absent'][k + 1] AS meta_kind FROM k""",
    "variant_fields": f"""WITH {QA}, k AS (SELECT *, (row_id % 100000000000000000) // 10000000 % 5 AS k FROM qa),
        f AS (
          SELECT 'Q' AS field, 'string' AS kind, count(Q) AS n FROM k UNION ALL SELECT 'A', 'string', count(A) FROM k
          UNION ALL SELECT 'meta', ['object', 'string', 'string', 'array'][k + 1] AS kind, count(*) FROM k WHERE k < 4 GROUP BY 2
          UNION ALL SELECT 'tag', 'number', count(*) FROM k WHERE k = 4
          UNION ALL SELECT 'meta.url', 'string', count(url) FROM k WHERE k < 2
          UNION ALL SELECT 'meta.answer_id', 'string', count(answer_id) FROM k WHERE k < 2
          UNION ALL SELECT 'meta.question_score', 'string', count(question_score) FROM k WHERE k < 2
          UNION ALL SELECT 'meta.answer_count', 'string', count(answer_count) FROM k WHERE k < 2)
        SELECT field, kind, n, field <> 'tag' AS known FROM f WHERE n > 0""",
    "publish_roundtrip": f"WITH {QA} SELECT row_id, Q FROM qa WHERE row_id % 2 = 1",
    "scan_tolerant": f"WITH {LINES} SELECT instruction, input, output FROM valid",
    "scan_numbered": f"WITH {LINES} SELECT line_no, instruction, input, output FROM valid",
    "head_n": f"WITH {LINES} SELECT line_no, instruction, input, output FROM valid ORDER BY line_no LIMIT {HEAD}",
    "holdout_range": f"""WITH {LINES} SELECT line_no, instruction, input, output FROM valid
        WHERE line_no >= {SKIP} ORDER BY line_no LIMIT {TAKE}""",
    "head_holdout_disjoint": f"""WITH {LINES} SELECT line_no,
        CASE WHEN nth < {HEAD} THEN 'head' ELSE 'holdout' END AS part, instruction
        FROM valid WHERE nth < {HEAD + TAKE}""",
    "head_holdout_overlap": f"""WITH {LINES}, later AS (SELECT * FROM valid WHERE line_no >= {HEAD} ORDER BY line_no LIMIT {TAKE})
        SELECT line_no, instruction FROM later WHERE nth < {HEAD}""",
    "loss_curve": f"WITH {LOSS} SELECT step, loss FROM loss ORDER BY step",
    "final_loss": f"WITH {LOSS} SELECT max(step) AS step, max_by(loss, step) AS loss FROM loss",
    "sink_clean_roundtrip": f"WITH {CLEAN} SELECT instruction, input, output FROM clean",
    "sink_splits_roundtrip": f"WITH {CLEAN} SELECT instruction, input, output, split FROM clean",
    "sink_split_folders_roundtrip": f"WITH {CLEAN} SELECT instruction, input, output, split FROM clean",
    "sink_chat_roundtrip": f"WITH {CLEAN} "
    + exchange(("role", "content"), ("instruction", "output"), ("user", "assistant"), f"{CHAT_TEXT} AS text, "),
    "funnel_report": funnel(),
    "text_lengths": f"WITH {CLEANED} SELECT row_id, q_len, a_len FROM cleaned",
    "instruction_format": f"""WITH {CLEAN} SELECT row_id, instruction, input, output, q_len, a_len, q_score, a_count
        FROM clean""",
    "record_uid": f"WITH {QA} SELECT row_id, coalesce(url, '') || '|' || coalesce(answer_id, '') AS uid FROM qa",
    "content_hash": f"WITH {CLEANED} SELECT row_id, content_hash FROM cleaned",
    "drop_empty": f"WITH {CLEANED} SELECT row_id, Q, A FROM filled",
    "length_filter": f"WITH {DEDUP} SELECT row_id, q_len, a_len FROM lengthed",
    "score_filter": f"""WITH {QA} SELECT row_id, question_score AS score FROM qa
        WHERE coalesce(try_cast(question_score AS integer), 0) >= 5""",
    "nfc_normalize": f"""SELECT doc_id, length(t)::integer AS raw_len, nfc_normalize(t) AS text
        FROM (SELECT doc_id, replace(text, chr(233), 'e' || chr(769)) AS t FROM documents)""",
    "strip_html": f"SELECT page_id, {strip_tags('html')} AS text FROM pages",
    "normalize_newlines": f"WITH {BREAKS} SELECT doc_id, {newlines('text')} AS text FROM docs",
    "collapse_blank_lines": f"WITH {BREAKS} SELECT doc_id, {blank_lines(newlines('text'))} AS text FROM docs",
    "normalize_latex": f"WITH {_markup()} SELECT doc_id, {math('text')} AS text FROM marked",
    "clean_text": f"WITH {_markup()} SELECT doc_id, {clean('text')} AS text FROM marked",
    "latex_features": f"WITH {FEATURES} SELECT row_id, latex_total, has_display FROM feats",
    "summary_stats": f"WITH {FEATURES} {summary()}",
    "display_share": f"""WITH {FEATURES} SELECT count_if(latex_total = 0)::bigint AS no_math_rows,
        100.0::double * count_if(has_display) / count(*) AS pct_display FROM feats""",
    "length_quantiles": """SELECT 'n_chars' AS series, quantile_cont(n_chars::double, 0.99) AS quantile FROM documents""",
    "approx_length_quantiles": "SELECT 'n_chars' AS series, true AS within FROM documents LIMIT 1",
    "sketch_quantiles": """SELECT 'n_chars' AS series, share, (SELECT count(n_chars) FROM documents) AS n, true AS near
        FROM (VALUES (0.01::double), (0.25), (0.5), (0.9), (0.99)) AS v(share)""",
    "sketch_histogram": f"""SELECT 'n_chars' AS series, bin::integer AS bin, lo::bigint AS lo, hi::bigint AS hi,
        count(*) FILTER ((n_chars > lo OR (bin = 0 AND n_chars = lo)) AND n_chars <= hi) AS exact, true AS near
        FROM documents, (VALUES {', '.join(f'({i}, {a}, {b})' for i, (a, b) in enumerate(zip(EDGES, EDGES[1:])))}) AS v(bin, lo, hi) GROUP BY ALL""",
    "length_histogram": histogram(),
    "score_profile": f"WITH {FEATURES} "
    + bucket_rows(
        "q_score", "feats", SCORES, "count(f.row_id) AS n, coalesce(avg(f.a_len), 0)::double AS avg_a_len"
    )
    + " WHERE b.lo <= (SELECT max(q_score) FROM feats) GROUP BY 1, 2",
    "latex_density_profile": f"WITH {FEATURES} "
    + bucket_rows(
        "latex_total",
        "feats",
        DENSITY,
        "count(f.row_id) AS n, 100.0::double * count(f.row_id) / (SELECT count(*) FROM feats) AS pct",
    )
    + " GROUP BY 1, 2",
    "truncation_risk": """SELECT count(*) AS n, count_if(length(text) > 4000)::bigint AS n_over,
        100.0::double * count_if(length(text) > 4000) / count(*) AS pct_over FROM documents""",
    "dedup_uid": f"WITH {DEDUP} SELECT row_id, uid FROM by_uid",
    "dedup_content": f"""WITH {DEDUP} SELECT row_id, content_hash FROM scored QUALIFY row_number() OVER (
        PARTITION BY content_hash ORDER BY q_score DESC, a_len DESC, text_md5, row_id) = 1""",
    "clean_stream": f"WITH {DEDUP} SELECT DISTINCT content_hash FROM scored",
    "dedup_linked": f"""WITH RECURSIVE {DEDUP},
        e AS MATERIALIZED (SELECT DISTINCT uid, content_hash FROM scored),
        l AS MATERIALIZED (SELECT DISTINCT a.uid AS u, b.uid AS v FROM e a JOIN e b ON a.content_hash = b.content_hash),
        r(u, v) AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v),
        c AS (SELECT u, min(v) AS component FROM r GROUP BY u)
        SELECT row_id, scored.uid, content_hash FROM scored JOIN c ON c.u = scored.uid
        QUALIFY row_number() OVER (PARTITION BY component ORDER BY q_score DESC, a_len DESC, text_md5, row_id) = 1""",
    "dedup_two_pass": f"WITH {DEDUP} SELECT row_id, uid, content_hash FROM by_content",
    "split_hash": f"WITH {CLEAN} SELECT row_id, content_hash, split FROM clean",
    "split_exact": f"""WITH {CLEAN}, ranked AS (
          SELECT row_id, content_hash, row_number() OVER (ORDER BY md5('42|' || content_hash)) AS i, count(*) OVER () AS n FROM clean)
        SELECT row_id, content_hash, CASE WHEN i <= round_even(0.8 * n, 0) THEN 'train' WHEN i <= round_even(0.9 * n, 0) THEN 'validation' ELSE 'test' END AS split
        FROM ranked""",
    "sample_exact": """SELECT doc_id FROM documents QUALIFY row_number() OVER (ORDER BY md5('42|' || doc_id)) <= (SELECT count(*) // 2 FROM documents)""",
    "split_counts": f"""WITH {CLEAN} SELECT s.split, count(c.row_id) AS n,
        100.0::double * count(c.row_id) / (SELECT count(*) FROM clean) AS pct
        FROM (VALUES ('train'), ('validation'), ('test')) s(split) LEFT JOIN clean c ON c.split = s.split GROUP BY 1""",
    "leakage_audit": leakage(),
    "sample_k": """SELECT doc_id, lang, n_chars FROM documents
        ORDER BY md5('42|' || doc_id::varchar), doc_id LIMIT 50""",
    "to_conversation": f"WITH {CLEAN} "
    + exchange(("from", "value"), ("instruction", "output"), ("human", "gpt")),
    "standardize_roles": f"WITH {CLEAN} "
    + exchange(("role", "content"), ("instruction", "output"), ("user", "assistant")),
    "render_chat": f"WITH {CLEAN} SELECT row_id, {CHAT_TEXT} AS text FROM clean",
    "render_prompt": f"WITH {CLEAN} SELECT row_id, {PROMPT_TEXT} AS prompt FROM clean",
    "token_budget": f"""WITH {CLEAN} SELECT row_id, {token_count(CHAT_TEXT)}::integer AS n_tokens,
        {token_count(CHAT_TEXT)} <= 128 AS fits FROM clean""",
    "token_budget_share": f"""SELECT count(*) AS n, count_if({token_count('text')} <= 512)::bigint AS n_fits,
        100.0::double * count_if({token_count('text')} <= 512) / count(*) AS pct_fits FROM documents""",
    "render_multi_turn": multi_turn(),
    "unanswered_conversations": """SELECT count(*) AS n, count_if(answers = 0)::bigint AS n_unanswered
        FROM (SELECT count_if(role = 'assistant') AS answers FROM conversations GROUP BY conv_id)""",
    "chat_from_split": f"WITH {CLEAN} SELECT row_id, {CHAT_TEXT} AS text FROM clean WHERE split = 'train'",
    "eval_prompts_from_split": f"""WITH {CLEAN} SELECT content_hash AS sample_id, instruction, output AS reference,
        {PROMPT_TEXT} AS prompt FROM clean WHERE split = 'test' ORDER BY md5('42|' || content_hash), content_hash LIMIT 50""",
    "split_random": f"WITH {CLEAN} SELECT row_id, true AS known, true AS repeats FROM clean",
    "pack_sequences": packs(),
    "pack_in_order": f"""WITH RECURSIVE items AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id, {token_count('text')} AS n FROM documents),
        walk(i, doc_id, n, pack_id, filled) AS (
          SELECT 0::bigint, NULL::bigint, 0::bigint, -1::bigint, 513::bigint
          UNION ALL
          SELECT items.i, items.doc_id, items.n, CASE WHEN filled + items.n > 512 THEN pack_id + 1 ELSE pack_id END,
                 CASE WHEN filled + items.n > 512 THEN items.n ELSE filled + items.n END
          FROM walk JOIN items ON items.i = walk.i + 1)
        SELECT pack_id, string_agg(doc_id::varchar, ',' ORDER BY doc_id) AS ids, sum(n)::bigint AS n_tokens FROM walk WHERE i > 0 GROUP BY 1""",
    "collect_turns": """SELECT conv_id, turn // 64 AS part,
        (row_number() OVER (PARTITION BY conv_id, turn // 64 ORDER BY turn) - 1)::integer AS pos, role, text AS content
        FROM conversations""",
    "normalize_answer": f"SELECT doc_id, {normalize('text')} AS text FROM documents",
    "step_proxy": f"WITH {PREDICTIONS} SELECT sample_id, model, {steps('prediction')}::integer AS has_steps FROM preds",
    "rouge_l": f"WITH {ROUGE} SELECT sample_id, model, round(rougeL, 9) AS rougeL FROM full_metrics",
    "sql_functions": f"""WITH {PREDICTIONS} SELECT sample_id, model, nfc_normalize(reference) AS reference,
        {lcs("string_split_regex(trim(reference), '[" + WS + "\\n]+')",
             "string_split_regex(trim(prediction), '[" + WS + "\\n]+')")}::bigint AS lcs FROM preds""",
    "score_pairs": f"""WITH {METRICS} SELECT sample_id, model, reference, prediction, em, round(f1, 9) AS f1, has_steps
        FROM metrics""",
    "score_summary": f"""WITH {ROUGE} SELECT model, count(*) AS n, round(avg(em), 9) AS em, round(avg(f1), 9) AS f1,
        round(avg(rougeL), 9) AS rougeL, round(avg(has_steps), 9) AS has_steps FROM full_metrics GROUP BY 1""",
    "score_compare": f"""WITH {ROUGE}, paired AS (SELECT sample_id FROM full_metrics GROUP BY 1 HAVING count(*) = 2),
        n AS (SELECT (SELECT count(*) FROM paired) AS n_paired,
                     (SELECT count(DISTINCT sample_id) FROM full_metrics) - (SELECT count(*) FROM paired) AS n_unpaired)
        """
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, round(avg({m}) FILTER (model = 'base'), 9) AS base,
        round(avg({m}) FILTER (model = 'tuned'), 9) AS tuned,
        round(avg({m}) FILTER (model = 'tuned') - avg({m}) FILTER (model = 'base'), 9) AS delta,
        max(n_paired) AS n_paired, max(n_unpaired) AS n_unpaired
        FROM full_metrics, n WHERE sample_id IN (SELECT sample_id FROM paired)"""
        for m in ("em", "f1", "rougeL", "has_steps")
    ),
    "score_delta": f"""WITH {METRICS} SELECT sample_id, b.sample_id IS NOT NULL AND t.sample_id IS NOT NULL AS paired,
        round(b.f1, 9) AS base_f1, round(t.f1, 9) AS tuned_f1, round(t.f1 - b.f1, 9) AS delta
        FROM (SELECT * FROM metrics WHERE model = 'base') b FULL JOIN (SELECT * FROM metrics WHERE model = 'tuned') t
        USING (sample_id)""",
    "top_k_improved": improved(),
}

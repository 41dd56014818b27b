import json

from answerloom.plans.prepare import prepare
from answerloom.sources import variants
from tests.test_sources import write

ROWS = [
    '{"Q":"q0","A":"a","meta":{"url":"u","answer_id":7,"question_score":"5","extra":[1]}}',
    '{"Q":"q1","A":"a","meta":"not an object"}',
    '{"Q":"q2","A":"a","meta":"{\\"url\\":\\"inside\\",\\"question_score\\":9}"}',
    '{"Q":"q3","A":"a","meta":[1,2]}',
    '{"Q":"q4","A":"a","meta":null}',
    '{"Q":"q5","A":"a","tags":["x"]}',
    '{"Q":5,"A":{"text":"b"},"meta":{"question_score":1.5,"answer_count":true}}',
    "",
    "   ",
    "not json",
    "[1]",
    '"text"',
]


def test_a_row_stays_whatever_its_meta_is(spark, folder):
    found = variants.read_raw_variant(spark, write(folder, "raw.jsonl", ROWS)).collect()
    rows = [(r.Q, r.A, *r.meta, r.meta_kind, r._corrupt) for r in found]
    assert rows == [
        ("q0", "a", "u", "7", "5", None, "object", None),
        ("q1", "a", None, None, None, None, "string", None),
        ("q2", "a", "inside", None, "9", None, "string", None),
        ("q3", "a", None, None, None, None, "array", None),
        ("q4", "a", None, None, None, None, "null", None),
        ("q5", "a", None, None, None, None, "absent", None),
        ("5", '{"text":"b"}', None, None, "1.5", "true", "object", None),
        *((None, None, None, None, None, None, "absent", line) for line in ("not json", "[1]", '"text"')),
    ]


def test_fields_are_counted(spark, folder):
    found = variants.field_counts(spark, write(folder, "raw.jsonl", ROWS)).collect()
    counts = {(r.field, r.kind): (r.n, r.known) for r in found}
    assert counts[("Q", "string")] == (6, True) and counts[("Q", "number")] == (1, True)
    assert counts[("meta", "string")] == (2, True) and counts[("meta", "null")] == (1, True) and counts[("meta", "array")] == (1, True)
    assert counts[("tags", "array")] == (1, False) and counts[("meta.extra", "array")] == (1, False)
    assert counts[("meta.question_score", "number")] == (2, True) and counts[("meta.url", "string")] == (2, True)


def test_the_job_takes_such_rows(spark, folder):
    """A fixed schema loses the texts of lines with an odd ``meta``; as VARIANT they reach the score filter by their score."""
    text = "word " * 40
    rows = [json.dumps({"Q": f"{i} {text}", "A": f"{i} {text}", "meta": meta}) for i, meta in enumerate(({"url": "u", "question_score": 9}, '{"url": "v", "question_score": "8"}', "odd", [1], {"question_score": 7, "other": 1}))]
    run = prepare(variants.read_raw_variant(spark, write(folder, "raw.jsonl", rows)).drop("meta_kind"))
    assert (run.remaining["raw"], run.remaining["length"], run.remaining["score"]) == (5, 5, 3)
    assert sorted(r.q_score for r in run.clean.collect()) == [7, 8, 9]

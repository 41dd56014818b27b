"""Every query again on tables of which a third is one conversation, one text or one event type."""

from pathlib import Path

import duckdb
import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES

SOURCE = Path("/root/testdata/sf0.01")
HOT = 3

TABLES = {
    # Conversation HOT holds half as many turns as all others together, numbered through.
    "conversations": f"""
        WITH base AS (SELECT conv_id + 1000 * k AS conv_id, turn, role, text || ' ' || k AS text
                      FROM t, range(0, 3) r(k)),
        hot AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS turn, text FROM base)
        SELECT * FROM base WHERE conv_id <> {HOT}
        UNION ALL
        SELECT {HOT}, turn, CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END, text FROM hot
        WHERE turn <= (SELECT count(*) / 2 FROM base)""",
    "documents": """
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN first_value(text) OVER (ORDER BY doc_id) ELSE text END AS text,
               lang, source, CASE WHEN doc_id % 3 = 0 THEN 77 ELSE n_chars END AS n_chars FROM t""",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'click' ELSE event_type END AS event_type) FROM t",
    "pages": "SELECT * FROM t",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name, sql in TABLES.items():
        con = duckdb.connect()
        con.execute(f"CREATE VIEW t AS SELECT * FROM '{SOURCE}/{name}.parquet'")
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")
    return folder, connect(str(folder))


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, skewed, name):
    folder, con = skewed
    assert compare(spark, con, str(folder), name).startswith("ok")

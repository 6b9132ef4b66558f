"""The registered queries over the smallest driver tables: one row per document, page or
vector, with the columns of their contracts, and equal to their SQL where there is one."""

import pytest

import __spark_entry__ as E
from quorum.llm.queries import QUERIES
from quorum.llm.sql import ORACLE_SQL
from tests.conftest import SMALL

COLUMNS = {
    "op1": ["doc_id", "n_shingles", "component_id", "kept"],
    "op2": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3": ["page_id", "url", "text", "n_chars"],
    "op4": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5": ["doc_id", "held_out", "score", "predicted"],
    "op6": ["vec_id", "n_links", "component_id", "kept"],
    "op7": ["doc_id", "n_tokens", "ids", "round_trip"],
    "op8": ["doc_id", "held_out", "score", "predicted"],
    "op9": ["doc_id", "contaminated", "items", "least_edits"],
    "op10": ["doc_id", "licenses", "containments", "first_words"],
    "op11": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op12": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}
TABLE = {"page_id": "pages", "doc_id": "documents", "vec_id": "embeddings"}


def test_registered():
    assert set(QUERIES) < set(E.queries()) and "pipeline" in E.queries()
    assert {q.split("_")[0] for q in QUERIES} == set(COLUMNS)
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_columns_and_sql(spark, duck, name):
    from quorum.oracle.compare import compare
    df = QUERIES[name](spark, SMALL)
    want = COLUMNS[name.split("_")[0]]
    assert df.columns == want
    ids = [r[0] for r in df.select(want[0]).collect()]
    table = spark.read.parquet(f"{SMALL}/{TABLE[want[0]]}.parquet")
    assert sorted(ids) == sorted(r[0] for r in table.select(want[0]).collect())
    if name in ORACLE_SQL:
        ok, msg = compare(df, duck, ORACLE_SQL[name])
        assert ok, msg


def test_leaked_items_and_round_trips_are_found(spark):
    leaks = {r.doc_id for r in QUERIES["op9_decontaminate"](spark, SMALL).filter("contaminated").collect()}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert {d.doc_id for d in docs if any(t in d.text for t in items)} <= leaks
    assert QUERIES["op7_piece_stream"](spark, SMALL).filter("not round_trip").count() == 0

import glob
import os
import pathlib
import re

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from clusterloom.llm.oracles import ORACLES
from clusterloom.llm.queries import QUERIES

DIR = "/root/testdata/sf0.01"
ROOT = pathlib.Path(__file__).resolve().parents[2]

#: Columns that the queries owe, with their types.
OWED = {
    "op2_": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op3_": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op4_": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op6_": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7_": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op8_": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op9_": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint",
    "op11_": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double",
    "op12_": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op13_": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
}
#: Tables of which a query returns a row for each of theirs; none where it does not.
TABLES = {"op2_": "pages", "op9_": None, "op10_": None, "op11_": None, "op12_": None, "op13_": None}


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, DIR)
    owed = OWED.get(name.split("_")[0] + "_", "doc_id bigint")
    kinds = dict(found.dtypes)
    for column in owed.split(", "):
        column, kind = column.split(" ")
        assert kinds[column] == kind
    rows = found.count()
    source = TABLES.get(name.split("_")[0] + "_", "documents")
    if source:
        assert rows == spark.read.parquet(f"{DIR}/{source}.parquet").count()
    assert rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{DIR}/*.parquet"):
        duck.execute(f"create view {os.path.splitext(os.path.basename(path))[0]} as select * from '{path}'")
    asked = duck.execute(ORACLES[name])
    columns = sorted(column[0] for column in asked.description)
    frame = asked.df()
    expected = frame.astype(object).where(frame.notna(), None)
    found = QUERIES[name](spark, DIR)
    assert sorted(found.columns) == columns
    got = sorted(repr(tuple(r[c] for c in columns)) for r in found.collect())
    assert got == sorted(repr(tuple(None if v is None else type_of(v) for v in row)) for row in expected[columns].values.tolist())


def type_of(value):
    return int(value) if isinstance(value, float) else value


def test_nothing_local_and_no_pairs():
    text = "\n".join(p.read_text() for p in (ROOT / "clusterloom" / "llm").rglob("*.py"))
    for word in ("localCheckpoint", "crossJoin", "tempfile", "except ImportError", "except ModuleNotFoundError"):
        assert word not in text
    assert not re.search(r"\.rdd\b", text)


def test_the_rest_does_not_import_it():
    for path in (ROOT / "clusterloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "clusterloom.llm" not in path.read_text()

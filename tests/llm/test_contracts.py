"""The columns every registered corpus query promises, and the queries that SQL can express against it."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
from shelfline.llm.oracle import ORACLE_SQL
from shelfline.llm.queries import QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")

# The first columns of each result and their types.
CONTRACTS = {
    "op1": "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    "op2": "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    "op3": "doc_id long, start long, n_tokens long, ids_crc32 long",
    "op4": "doc_id long, held_out boolean, lang_pred string, score double",
    "op5": "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    "op6": "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    "op9": "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean",
    "op10": "doc_id long, n_shingles long, component_id long, kept boolean",
    "op11": "word string, form string, root string, n long, n_near long, form_n long",
    "op12": "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
}


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] in CONTRACTS])
def test_query_returns_its_columns(spark, name):
    wanted = [tuple(c.split()) for c in CONTRACTS[name.split("_")[0]].split(", ")]
    found = QUERIES[name](spark, DATA)
    kinds = {"bigint": "long"}
    got = [(c, kinds.get(t, t)) for c, t in found.dtypes]
    assert sorted(got[: len(wanted)]) == sorted(wanted), got
    if name in ORACLE_SQL:
        compare(found, ORACLE_SQL[name])


def test_mix_equals_sql(spark):
    compare(QUERIES["op8_mix_sources"](spark, DATA), ORACLE_SQL["op8_mix_sources"])


def compare(found, sql):
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    wanted = con.execute(sql)
    columns = sorted(found.columns)
    assert sorted(c[0] for c in wanted.description) == columns
    order = ", ".join(f'"{c}"' for c in columns)
    wanted = con.execute(f"SELECT {order} FROM ({sql})").fetchall()
    assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(wanted, key=str)


def test_sql_is_registered():
    assert set(ORACLE_SQL) <= set(registry.oracle_sql()) and set(QUERIES) <= set(registry.queries())

"""The registered queries against DuckDB, and their columns."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck
from ledgerloom.llm.oracles import ORACLES
from ledgerloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op2_": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op3_": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op4_": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6_": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op8_": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op10_": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op12_": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op13_": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
}


def test_one_query_an_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = dict(df.dtypes)
    for column in COLUMNS.get(name[: name.index("_") + 1], "").split(", "):
        if column:
            assert columns[column.split(" ")[0]] == column.split(" ")[1]
    if name in ORACLES:
        assert differences(df, duck(SF_DIR), ORACLES[name]) is None
    elif not name.startswith(("op5", "op9")):
        assert df.count() == df.select("doc_id").distinct().count() == 200

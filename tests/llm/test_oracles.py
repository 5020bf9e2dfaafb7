"""Every text query that SQL can express against its DuckDB twin at sf 0.01;
the others at least run there with the columns that their contract names."""

import pytest

from conftest import SF001, SF01
from mdmspark.llm.queries import ORACLE, QUERIES
from oracle import compare, duck_connect

COLUMNS = {
    "op1_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_simhash": "doc_id fingerprint component_id",
    "op4_ppm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_line_cleaning": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_url_rules": "page_id host path rule verdict",
    "op7_decontamination": "doc_id item_id",
    "op8_revisits": "record_id canonical_url ts outcome refers_to",
    "op9_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_langid": "doc_id held_out lang_pred score",
    "op11_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_ns_bounds": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
}


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck_connect(SF01), name, QUERIES[name], ORACLE[name], SF01)
    assert r["rows"][0] == r["rows"][1] and r["columns_match"] and r["types_match"] and r["hash_match"], r


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert df.count() > 0

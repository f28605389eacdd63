"""The registered queries on whole tables: columns, one row for each document or page, plans."""

import pytest

from standings.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_language_id": "doc_id held_out lang_pred score",
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_simhash_near_dedup": "doc_id fingerprint component_id",
    "op4_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op7_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op8_url_filters": "page_id host path rule verdict",
    "op9_token_id_output": "doc_id start n_tokens ids_crc32",
    "op10_sentencepiece": "doc_id n_ids ids_crc32 decoded_chars decoded_sha256",
    "op11_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op12_collocations": "lang rank phrase a l r n score",
    "op13_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def test_all_are_registered():
    assert set(QUERIES) == set(CONTRACT)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert set(CONTRACT[name].split()) <= set(result.columns)
    if "doc_id" not in result.columns and "page_id" not in result.columns:
        return
    key = "page_id" if "page_id" in result.columns else "doc_id"
    source = spark.read.parquet(f"{SF_DIR}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    ids = [r[0] for r in result.select(key).collect()]
    assert set(ids) == {r[0] for r in source.select(key).collect()}
    if name != "op2_packing":
        assert len(ids) == source.count()


@pytest.mark.parametrize("name", ["op4_secret_scans", "op5_quality_rules", "op7_document_fingerprints", "op8_url_filters", "op11_exact_dedup"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))

"""The registered text queries: their columns, and that each returns every document."""

import pytest

from recordflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_line_dedup": "doc_id n_lines n_removed_lines removed_lines kept_sha256",
    "op2_jaccard_join": "doc_id class_id copy_id n_links n_grams",
    "op3_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op4_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op5_substring_dedup": "doc_id n_chars n_removed_units n_removed_chars removed_spans kept_sha256",
    "op6_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op9_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_one_row_for_each_document(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.columns == COLUMNS[name].split()
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == list(range(200))

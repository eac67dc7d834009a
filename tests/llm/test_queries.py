"""The registered queries of the package: SQL where there is some, and their contract's columns."""

import os
import sys

import pytest

SF = os.environ.get("CARELAKE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

COLUMNS = {
    "op1_language_id": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op2_source_mixing": [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")],
    "op5_html_text": [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")],
    "op8_quality_rules": [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
                          ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean")],
    "op9_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op10_benchmark_decontamination": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"),
                                       ("items_sha256", "string"), ("contaminated", "boolean")],
}
NEW_COLUMNS = {
    "op11_secret_scan": [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"),
                         ("base_sha256", "string"), ("spans", "string")],
    "op12_embedding_whitening": [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                                 ("whitened", "double"), ("explained", "double"), ("identity_error", "double")],
    "op13_spelling_variants": [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"),
                               ("form_n", "bigint")],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    from carelake.llm.queries import QUERIES
    df = QUERIES[name](spark, SF)
    assert [t for t in df.dtypes if t in COLUMNS[name]] == COLUMNS[name]
    table = "pages" if name.startswith("op5") else "documents"
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(NEW_COLUMNS))
def test_columns(spark, name):
    from carelake.llm.queries import QUERIES
    df = QUERIES[name](spark, SF)
    assert [t for t in df.dtypes if t in NEW_COLUMNS[name]] == NEW_COLUMNS[name]
    assert df.count() > 0


def test_sql_oracles(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from oracle_check import compare

    from carelake.llm.queries import ORACLES
    res = compare(spark, SF, keys=list(ORACLES), verbose=False)
    assert {v[0] for v in res.values()} == {"OK"}, res

"""The registered corpus queries."""

import __spark_entry__ as contract

#: Learned models, tokenizers, signatures, wrappers and keyed draws are beyond SQL; their own tests hold them against brute force.
WITHOUT_SQL = {
    "op1_wrappers", "op3_toxicity", "op6_quality_rules", "op7_packing", "op8_minhash", "op10_surrogates", "op12_alignment", "pipeline",
}


def test_all_others_have_sql():
    assert set(contract.CORPUS_QUERIES) - set(contract.CORPUS_ORACLE) == WITHOUT_SQL
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in contract.CORPUS_QUERIES} - {"pipeline"}

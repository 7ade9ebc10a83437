"""The registered queries on the smallest tables: contract columns, one row per input row, and their SQL."""

import pytest

from stratum.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1": ("pages", ["page_id", "url", "text", "n_chars"]),
    "op2": ("documents", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    "op3": ("documents", ["doc_id", "contaminated"]),
    "op4": ("documents", ["doc_id", "held_out", "lang_pred", "score"]),
    "op5": ("documents", ["doc_id", "held_out", "score", "predicted"]),
    "op6": ("documents", ["doc_id", "n_shingles", "component_id"]),
    "op7": ("documents", ["doc_id"]),
    "op8": ("documents", ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]),
    "op12": ("documents", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    "op13": ("documents", ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]),
    "op9": ("documents", ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]),
}
TYPES = {"n_chars": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "held_out": "boolean", "score": "double",
         "predicted": "int", "n_shingles": "bigint", "component_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint",
         "group_size": "bigint", "kept": "boolean", "n_tokens": "bigint", "verified": "boolean"}


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in CONTRACT))
def test_contract(spark, name):
    source, columns = CONTRACT[name.split("_")[0]]
    out = QUERIES[name](spark, SF)
    assert out.columns[:len(columns)] == columns
    types = dict(out.dtypes)
    assert all(types[c] == t for c, t in TYPES.items() if c in columns)
    assert out.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want.project(", ".join(cols)).fetchall(), key=repr)

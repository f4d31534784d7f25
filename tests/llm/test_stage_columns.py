"""Every stage keeps extra columns, whatever their names."""

import pytest

import corpus_pipeline as P
from costlens.llm.common import table

SF = "/root/testdata/sf0.001"
NAMES = (
    "id", "hit_id", "kept", "kept_row", "place", "site_logit", "site_host", "host", "path", "judged", "h", "t", "n",
    "row", "mark", "second", "key", "tested", "value", "label", "score", "rep", "component_id", "window", "bucket",
    "pos", "length", "column_0", "start", "finding", "f", "x", "n_tokens", "ids_sha256", "token_ids", "millionths",
)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_clashing_columns(spark, name):
    stage = dict(P.STAGES)[name]
    docs = table(spark, SF, "documents")
    extra = docs.selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in NAMES))
    out = stage(spark, extra, SF)
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == {r.doc_id for r in stage(spark, docs, SF).select("doc_id").collect()}
    if name != "tokens":
        assert out.columns == extra.columns
        assert all(r[n] == f"{n}{i}" for i, r in got.items() for n in NAMES)

import os
import subprocess
import sys

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from costlens.llm import queries
from costlens.llm.common import Workspace, table
from tests.llm.brute import benchmark_hits, near_groups
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "tokens"]
    assert P.ORACLE_SQL is None


@pytest.mark.parametrize("key", list(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, key):
    r = compare(spark, key, SF, duck(SF))
    assert r["ok"], {k: v for k, v in r.items() if "sample" not in k}


def test_stages_one_by_one(spark):
    ws = Workspace(spark, "t")
    docs = table(spark, SF, "documents")
    before = docs
    kept = {}
    for name, stage in P.STAGES:
        after = ws.keep(stage(spark, before, SF), name)
        rows = {r.doc_id: r for r in after.collect()}
        kept[name] = rows
        if name != "tokens":
            assert after.columns == docs.columns
        else:
            assert set(rows) == {r.doc_id for r in before.collect()}
        if name == "near_dedup":
            groups = near_groups([(r.doc_id, r.text) for r in before.collect()])
            assert set(rows) == set(groups.values())
        if name == "decontaminate":
            items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
            own = [(r.doc_id, r.text) for r in before.collect()]
            assert set(rows) == {i for i, _, n, _ in benchmark_hits(own, items) if not n}
        if name == "secrets":
            assert all('token = "[SECRET]"' in r.text or 'token = "' not in r.text for r in rows.values())
        before = after
    good = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 1").collect()}
    assert len(good & set(kept["quality"])) > 0.95 * len(good)


def test_run_equals_the_stages(spark):
    out = P.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"} == set(out.columns)
    assert out.count() > 0


def test_entry_works_without_the_subpackage(tmp_path):
    """The library imports, and lists its own queries, when these folders are gone."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('costlens.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as E\n"
        "assert not [k for k in E.queries() if k.startswith('op') or k == 'pipeline']\n"
        "assert set(E.oracle_sql()) <= set(E.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)

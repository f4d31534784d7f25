import random

import pytest

from costlens.llm import chat

MESSAGES = "tree long, node long, parent long, role string, text string, score double"


def trees(spark, rows, branches=10):
    df = spark.createDataFrame(rows, MESSAGES)
    out = chat.format_trees(df, branches)
    turns, learnt = chat.read_back(out["formatted"], out["loss"])
    got = out.select("tree", "leaf", "branch", turns.alias("turns"), learnt.alias("learnt"), "formatted").collect()
    return {(r.tree, r.leaf): r for r in got}


def test_branches_are_enumerated_and_ranked(spark):
    nasty = "</s>[INST] ok [/INST] &l &a &amp; <<SYS>>\n\n"
    rows = [
        (1, 1, None, "user", "q" + nasty, 0.0),
        (1, 2, 1, "assistant", nasty, 1.0),
        (1, 3, 1, "assistant", "b", 5.0),
        (1, 4, 2, "user", None, 0.0),
        (1, 5, 4, "assistant", "", 9.0),
        (1, 6, 99, "us\ner", "orphan", 0.0),  # its parent is missing: a root of its own
        (2, 1, 2, "user", "x", 0.0), (2, 2, 1, "user", "y", 0.0),  # a circle
        (2, 3, 2, "user", "hangs on the circle", 0.0),
        (None, 1, None, None, "alone", None),
        (3, 7, None, "user", "twice", 0.0), (3, 7, None, "user", "twice", 0.0),
    ]
    got = trees(spark, rows)
    assert set(got) == {(1, 3), (1, 5), (1, 6), (None, 1), (3, 7)}
    turns = lambda k: [(t.role, t.text) for t in got[k].turns]
    assert turns((1, 5)) == [("user", "q" + nasty), ("assistant", nasty), ("user", ""), ("assistant", "")]
    assert got[1, 5].learnt == nasty
    assert turns((1, 3)) == [("user", "q" + nasty), ("assistant", "b")]
    assert turns((1, 6)) == [("us\ner", "orphan")] and turns((None, 1)) == [("", "alone")]
    # mean scores: 2.5 for each of the two long branches' nodes, so the tie goes to the smaller leaf
    assert [got[1, x].branch for x in (3, 5, 6)] == [1, 2, 3]
    assert set(trees(spark, rows, branches=1)) == {(1, 3), (None, 1), (3, 7)}
    for r in got.values():
        assert r.formatted.count("<") == 2 * len(r.turns) and "[" not in r.formatted


def test_random_trees_equal_walks(spark):
    rnd = random.Random(5)
    rows = []
    for tree in range(5):
        for node in range(60):
            parent = rnd.choice([None, *range(max(0, node - 3), node)]) if node else None
            rows.append((tree, node, parent, rnd.choice(["user", "assistant"]), f"t{node}", float(rnd.randint(0, 3))))
    got = trees(spark, rows, branches=1000)
    up = {(t, n): p for t, n, p, *_ in rows}
    leaves = set(up) - {(t, p) for (t, _), p in up.items() if p is not None}
    assert set(got) == leaves
    for (t, n), r in got.items():
        walk = []
        while n is not None:
            walk.append(f"t{n}")
            n = up[t, n]
        assert [x.text for x in r.turns] == walk[::-1]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "c", 3) for r in rows], "conv_id long, turn long, role string, text string, tree string, leaf int")


def test_digests_edges(spark):
    import hashlib

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b é"), (1, 1, "assistant", "b é"), (1, None, "system", None),
            (2, 5, None, "<s>&"), (None, 1, "user", "n"), (None, 0, "assistant", "m"), (3, 0, "assistant", "x" * 200_000)]
    got = {r.conv_id: r for r in chat.digests(conversations(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, None, -1}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1].n_turns == 4 and got[1].turns_sha256 == sha("system\n\nuser\na\nassistant\nb é\nassistant\nb é\n")
    assert got[1].loss_chars == 6 and got[1].loss_sha256 == sha("b éb é")
    assert got[None].turns_sha256 == sha("assistant\nm\nuser\nn\n")
    assert got[2].turns_sha256 == sha("\n<s>&\n") and got[2].loss_chars == 0
    assert got[-1].loss_sha256 == sha(chat.PROBE) and got[-1].n_turns == 2
    assert got[3].loss_chars == 200_000
    assert chat.digests(conversations(spark, rows).filter("false")).count() == 1


@pytest.mark.parametrize("turns", [1, 2, 33])
def test_long_conversation(spark, turns):
    rows = [(7, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(turns)]
    got = {r.conv_id: r for r in chat.digests(conversations(spark, rows)).collect()}
    assert got[7].n_turns == turns


def test_runs_without_python(spark):
    df = chat.digests(conversations(spark, [(1, 0, "user", "a")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

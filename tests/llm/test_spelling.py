import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from costlens.llm import spelling as S
from costlens.llm.common import Workspace, table
from costlens.llm.queries import op12_spelling

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts(docs, every=199):
    total = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def groups(words):
    """Rows (word, form, root, n, n_near, form_n) by comparing words with all others."""
    found = defaultdict(list)
    buckets = defaultdict(list)
    for w in words:
        buckets[len(w)].append(w)
    for w in words:
        for size in (len(w), len(w) + 1):
            for v in buckets[size]:
                if (size > len(w) or w < v) and near(w, v):
                    found[w].append(v)
                    found[v].append(w)
    form = {}
    for w, others in found.items():
        top = min(others, key=lambda v: (-words[v], v))
        if words[top] >= 5 * words[w]:
            form[w] = top
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(found[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def run(spark, words):
    df = spark.createDataFrame(list(words.items()) or [("", 0)], "word string, n long").filter("n > 0")
    return sorted(map(tuple, S.variants(Workspace(spark, "t"), df).collect()), key=str)


def made_up(seed, size=900):
    rnd = random.Random(seed)
    words = set()
    while len(words) < size:
        w = "".join(rnd.choice("abé") for _ in range(rnd.randint(6, 7)))
        words.add(w + rnd.choice(["", "", "ation"]))
    return {w: int(5 * 5 ** (7 * rnd.random() ** 2)) for w in sorted(words)}


@pytest.mark.parametrize("pairs", [8, 1024, 10**9])
def test_groups_equal_all_comparisons(spark, monkeypatch, pairs):
    monkeypatch.setattr(S, "PAIRS", pairs)
    words = made_up(pairs % 97)
    want = groups(words)
    assert run(spark, words) == want
    assert sum(r[4] for r in want) > 500 and any(r[1] and r[2] != r[1] for r in want)


def test_hot_chunk_is_cut_until_groups_are_small(spark, monkeypatch):
    """A third of all words share their first half, and most edits stand in the other one."""
    monkeypatch.setattr(S, "PAIRS", 64)
    rnd = random.Random(4)
    words = {"commonhead" + "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(9, 11))): 9 for _ in range(500)}
    for w in list(words)[:200]:
        at = rnd.randrange(len(w))
        words[w[:at] + rnd.choice(["", "z", "y" + w[at]]) + w[at + 1 :]] = 50
    seen = []
    keep = Workspace.keep

    def spy(self, df, name):
        seen.append(name)
        return keep(self, df, name)

    monkeypatch.setattr(Workspace, "keep", spy)
    assert run(spark, words) == groups(words)
    assert seen.count("chunks") >= 2


def test_ties_chains_and_empty(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdegg": 125, "abcdeggg": 625, "zzzzzz": 7, "aaaaaa": 9, "aaaaaaa": 9}
    got = {r[0]: r for r in run(spark, words)}
    assert got["abcdef"][1:] == ("abcdeg", "abcdeggg", 5, 2, 25)
    assert got["abcdeggg"][1:] == (None, "abcdeggg", 625, 1, None)
    assert got["zzzzzz"][1:] == (None, "zzzzzz", 7, 0, None)
    assert got["aaaaaa"][1:] == (None, "aaaaaa", 9, 1, None)
    assert sorted(got.values(), key=str) == groups(words)
    assert run(spark, {}) == []


def test_word_counts_of_any_text(spark, monkeypatch):
    monkeypatch.setattr(S, "COUNTS_KEPT", 20)
    monkeypatch.setattr(S, "STRETCH", 30)
    texts = ["Straße_STRASSE Ärger ÄRGERLICH×÷ čeština  wordwordword 漢字abcdefg", None, "", "x" * 500, "Example éxample " * 40]
    rows = [(i, t, "n") for i, t in enumerate(texts * 6)] + [(None, "Example", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    for every in (0, 3):
        got = {r.word: r.n for r in S.word_counts(df, drop_every=every).collect()}
        assert got == counts([("" if i is None else i, t) for i, t, _ in rows], every)
    assert S.spelling_groups(df.filter("false")).count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = op12_spelling(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == groups(counts(docs))

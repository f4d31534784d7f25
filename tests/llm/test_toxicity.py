import numpy as np
import pytest

from costlens.llm import toxicity as tox

SF = "/root/testdata/sf0.01"


def test_folding():
    assert tox.fold("1D10T ѕtυріd ídïöt ｍｏｒｏｎ w​orthless l0ser") == [
        "idiot", "stypid", "idiot", "moron", "worthiess", "ioser",
    ]
    assert tox.fold(None) == [] and tox.fold("... 😀 \n") == []


def test_lexicon_matches_words_stems_and_exceptions():
    lex = tox.Lexicon({"scum": 3.0, "moron ": 2.0, "mo": 0.5, "trash": 1.0}, ["trash can", "scummy bear", "morose"])
    m = lambda t: sorted(w for _, w in lex.matches(tox.fold(t)))
    assert m("Scum, SCUMBAG!") == [3.0, 3.0]
    assert m("oscum rescum") == []  # stems match at the start of a word only
    assert m("moron mood morose") == [0.5, 2.0]  # the longest entry counts; an exception cancels
    assert m("the trash can is trash") == [1.0]
    assert m("a scummy bear and scum scum") == [3.0, 3.0]
    assert m("") == []
    once, often = (lex.features(tox.fold("scum " * n + "word " * (100 - n))) for n in (1, 50))
    assert once == often  # repeating one word adds nothing


def test_no_entries():
    lex = tox.Lexicon({}, [])
    assert lex.matches(["any"]) == [] and lex.features([]) == (0.0, 0.0)


def frames(spark, docs, labels):
    d = spark.createDataFrame([(*x, "z") for x in docs], "doc_id long, text string, label string")
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_edges(spark):
    docs = [(1, None), (2, ""), (2, ""), (None, "plain words"), (3, "fine " * 30_000)]
    d, l = frames(spark, docs, [(1, 1, 0), (2, None, None), (2, 1, 0), (None, 1, 1), (99, 0, 1)])
    out = tox.score(d, l).collect()
    assert len(out) == 5 and all(0 <= r.score < 0.5 and r.predicted == 0 for r in out)
    assert {r.doc_id: r.held_out for r in out}[None] is False
    assert tox.score(d.filter("false"), l).count() == 0
    assert tox.score(d, l.filter("false")).count() == 5


def test_labels_of_the_held_out_fold_and_other_columns_do_not_matter(spark):
    import zlib

    bad = "you are scum and a moron indeed"
    docs = [(i, (bad if i % 3 == 0 else "a calm and quiet sentence") + f" number{i}") for i in range(120)]
    labels = [(i, 1, int(i % 3 == 0)) for i, _ in docs]
    wrong = [(i, 1, 1 - y) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, y) for i, q, y in labels]
    d, l = frames(spark, docs, labels)
    a = {r.doc_id: (r.score, r.predicted) for r in tox.score(d, l).collect()}
    b = {r.doc_id: (r.score, r.predicted) for r in tox.score(d, spark.createDataFrame(wrong, l.schema)).collect()}
    assert a == b
    assert all(p == int(i % 3 == 0) for i, (_, p) in a.items())


def test_held_out_accuracy(spark):
    from costlens.llm.queries import op1_toxicity

    got = {r.doc_id: r for r in op1_toxicity(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("toxic is not null").collect()
    held = [(r.toxic, got[r.doc_id]) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    right = [y == r.predicted for y, r in held]
    assert len(held) > 30 and np.mean(right) > 0.9
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_disguised_words_are_caught(spark):
    docs = [(i, ("pure scum and trash here" if i % 2 else "pure light and grace here") + f" text{i}x") for i in range(80)]
    docs += [(1000, "pure 5cum and tr4sh here"), (1001, "pure ѕсum and ｔｒａｓｈ here")]
    d, l = frames(spark, docs, [(i, 1, i % 2) for i in range(80)])
    got = {r.doc_id: r.predicted for r in tox.score(d, l).collect()}
    assert got[1000] == got[1001] == 1


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_one_kind_of_label(spark, share):
    docs = [(i, f"some text {i}") for i in range(20)]
    d, l = frames(spark, docs, [(i, 1, int(share)) for i in range(20)])
    assert tox.score(d, l).count() == 20


def test_threshold_does_not_move_with_the_bounds_of_the_sample(spark, monkeypatch):
    import random

    rnd = random.Random(5)
    docs, labels = [], []
    for i in range(3000):
        toxic = int(rnd.random() < 0.1)
        word = "scum" if rnd.random() < (0.6 if toxic else 0.05) else "calm"
        docs.append((i, f"a {word} and quiet sentence number{i}"))
        labels.append((i, 1, toxic))
    d, l = frames(spark, docs, labels)
    rate = np.mean([y for _, _, y in labels])
    means = []
    for most in (tox.MAX_TOXIC, 150):
        monkeypatch.setattr(tox, "MAX_TOXIC", most)
        monkeypatch.setattr(tox, "MAX_CLEAN", most)
        means.append(np.mean([r.score for r in tox.score(d, l).collect()]))
    assert abs(means[0] - rate) < 0.04 and abs(means[1] - rate) < 0.04


def test_occurrences_enter_the_curve_where_labels_follow_them(spark):
    import random

    rnd = random.Random(8)
    docs, labels = [], []
    for i in range(1200):
        toxic = i % 3 == 0  # all name the word; the toxic ones repeat it
        n = 15 if toxic else 1
        words = ["scum"] * n + [rnd.choice("calm quiet river stone light".split()) for _ in range(60 - n)]
        if not toxic and i % 2:
            words[0] = "calm"
        rnd.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    d, l = frames(spark, docs, labels)
    # the word alone is a weak sign of the label, its density a sure one
    lex = tox.Lexicon({"scum": 1.5}, [])
    x = np.array([lex.inputs(tox.fold(t)) for _, t in docs])
    y = np.array([float(t) for _, _, t in labels])
    curve = tox.choose_curve(x, y, np.ones(len(y)))
    assert curve[3] > 0
    lex.curve = curve
    assert np.mean((lex.scores(x) >= 0.5) == (y == 1)) > 0.98
    shuffled = np.random.default_rng(1).permutation(len(y))
    assert np.allclose(curve, tox.choose_curve(x[shuffled], y[shuffled], np.ones(len(y))), atol=1e-6)
    assert tox.score(d, l).count() == len(docs)


def test_occurrences_stay_out_where_they_say_nothing_more():
    lex = tox.Lexicon({"scum": 3.0}, [])
    texts = [("scum " if i % 2 else "calm ") + "word " * (5 + i % 40) for i in range(400)]
    x = np.array([lex.inputs(tox.fold(t)) for t in texts])
    assert (x[:, 1] == x[:, 2]).all() and lex.features(tox.fold(texts[1])) == tuple(x[1, :2])
    curve = tox.choose_curve(x, np.arange(400) % 2 * 1.0, np.ones(400))
    assert curve[3] == 0

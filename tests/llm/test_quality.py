import numpy as np
import pyarrow as pa

from costlens.llm import quality
from costlens.llm.common import Workspace

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, site_host string, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "clash", 7) for i, t, s in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_features_of_each_row_stand_alone():
    texts = ["Plain words, in a line.", None, "", "CAPS!! CAPS!!\nCAPS!! CAPS!!", "é ü 12%% ##", "   "]
    whole, n = quality.features(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        one, m = quality.features(pa.array([t], pa.string()))
        assert np.allclose(one[0], whole[i]) and m[0] == n[i]
    assert n.tolist() == [5, 0, 0, 4, 4, 0]
    assert whole[3][7] == 0.5  # one of two lines is a copy


def test_held_out_accuracy_and_kept_rows(spark):
    from costlens.llm.common import table
    from costlens.llm.queries import op10_quality

    got = {r.doc_id: r for r in op10_quality(spark, SF).collect()}
    rows = [r for r in table(spark, SF, "labels").collect() if r.quality is not None and got[r.doc_id].held_out]
    assert len(rows) > 30
    assert np.mean([r.quality == got[r.doc_id].kept for r in rows]) > 0.95
    assert all(got[r.doc_id].kept for r in rows if r.quality == 1)
    docs = table(spark, SF, "documents")
    kept = quality.keep_good(docs, table(spark, SF, "labels"))
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if r.kept}


def test_edges(spark):
    good = "A calm sentence about things, in plain words. Another one follows it here."


    def prose(n):
        return " ".join(f"Another{i} sentence about thing{i}, in plain words." for i in range(n))

    rows = [(i, prose(1 + i * i), f"https://h{i % 3}.x/p{i % 2}/q") for i in range(30)]
    rows += [(100 + i, f"JUNK!! JUNK!! %%% ### {i} " * (1 + i * i), "h1.x/p1") for i in range(30)]
    rows += [(None, good, None), (200, None, None), (201, "", "a"), (202, " \n", "a"), (203, good, ""), (203, good, "")]
    rows += [(204, prose(9_000), "h9.x")]
    y = [(i, int(i < 100), 0) for i, _, _ in rows[:60]] + [(None, 1, 0), (1, None, 0)]
    d = frame(spark, rows)
    out = quality.score(d, labels(spark, y)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].kept == (i < 100) for i, _, _ in rows[:60])
    assert by[None].kept and by[203].kept and by[204].kept
    assert not (by[200].kept or by[201].kept or by[202].kept) and by[200].score == 0
    kept = quality.keep_good(d, labels(spark, y))
    assert kept.columns == d.columns and kept.count() == sum(r.kept for r in out)
    assert quality.score(d.filter("false"), labels(spark, y)).count() == 0
    assert quality.keep_good(d.filter("false"), labels(spark, y)).count() == 0
    assert quality.score(d, labels(spark, [])).count() == len(rows)


def test_sparse_sites_shrink_toward_their_host(spark):
    judged = [("a", "a/1", 900_000)] * 400 + [("b", "b/1", 100_000)] * 400
    judged += [("a", "a/2", 100_000), ("c", "c/1", 100_000)]
    df = spark.createDataFrame(judged, "host string, path string, millionths long")
    out = {r.site_path: r.site_logit for r in quality.site_posteriors(Workspace(spark, "t"), df).collect()}
    p = {k: 1 / (1 + np.exp(-v)) for k, v in out.items()}
    assert abs(p["a/1"] - 0.9) < 0.02 and abs(p["b/1"] - 0.1) < 0.02
    assert p["b/1"] < p["c/1"] < 0.55  # one document moves a site little from the global rate
    assert p["c/1"] < p["a/2"] < p["a/1"]  # and a path little from its host


def test_site_of(spark):
    rows = [("https://A.x/p/q",), ("src1",), (None,), ("h/p",), ("",)]
    df = spark.createDataFrame(rows, "source string")
    got = [tuple(r) for r in df.select(*quality.site_of(df["source"])).collect()]
    assert got == [("a.x", "a.x/p"), ("src1", "src1/"), ("", "/"), ("h", "h/p"), ("", "/")]


def test_prior_is_that_of_all_labels(spark, monkeypatch):
    good = "A calm sentence about things, in plain words. Another one follows it here."
    rows = [(i, f"{good} Number {i}." if i % 10 else f"JUNK!! JUNK!! %%% ### {i}", "a") for i in range(600)]
    rows += [(1000 + i, " \n", "a") for i in range(30)]  # without words: no part of the prior
    y = [(i, int(i < 1000 and i % 10 > 0), 0) for i, _, _ in rows] + [(5000 + i, 0, 0) for i in range(30)]
    d, l = frame(spark, rows), labels(spark, y)
    priors = []
    for most in (quality.MAX_GOOD, 20):
        monkeypatch.setattr(quality, "MAX_GOOD", most)
        monkeypatch.setattr(quality, "MAX_BAD", most)
        priors.append(quality.fit_evidence(Workspace(spark, "t"), d, l).prior)
    assert priors[0] == priors[1] and abs(priors[0] - 0.9) < 0.03


def plain_scores(judged, m_host, m_path, rate):
    """Scores by the definition: posteriors of path and host from all other rows."""
    out = []
    for i, (host, path, llr, p) in enumerate(judged):
        others = [r for j, r in enumerate(judged) if j != i and r[3] is not None]
        of_host = [r[3] / 1e6 for r in others if r[0] == host]
        of_path = [r[3] / 1e6 for r in others if r[1] == path]
        if p is None:
            out.append(0.0)
            continue
        prior = (sum(of_host) + m_host * rate) / (len(of_host) + m_host)
        post = (sum(of_path) + m_path * prior) / (len(of_path) + m_path)
        out.append(1 / (1 + np.exp(-(llr + np.log(post / (1 - post))))))
    return out


def test_scores_equal_posteriors_of_the_other_rows(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for i in range(150):
        host = "abcde"[min(4, int(rnd.exponential(1)))]
        p = None if i % 17 == 0 else int(rnd.integers(1, 10**6))
        rows.append((host, f"{host}/{rnd.integers(3)}", None if p is None else float(rnd.normal()), p))
    rows.append(("alone", "alone/", 0.4, 250_000))
    df = spark.createDataFrame(rows, "host string, path string, llr double, millionths long")
    ws = Workspace(spark, "t")
    site = quality.site_posteriors(ws, df).first()
    # the strengths, by the moments of the group rates
    def groups(at, prior):
        sums = {}
        for r in rows:
            if r[3] is not None:
                good, n = sums.get(r[at], (0, 0))
                sums[r[at]] = good + r[3] / 1e6, n + 1
        n = sum(n for _, n in sums.values())
        spread = sum(n_ * (g / n_ - prior(k)) ** 2 for k, (g, n_) in sums.items())
        v = sum(n_ * prior(k) * (1 - prior(k)) for k, (_, n_) in sums.items()) / n
        tau2 = (spread - (len(sums) - 1) * v) / n
        m = quality.MAX_STRENGTH if tau2 <= 0 else min(max(v / tau2 - 1, 2.0), quality.MAX_STRENGTH)
        return sums, m

    counted = [r[3] / 1e6 for r in rows if r[3] is not None]
    rate = (sum(counted) + 0.5) / (len(counted) + 1)
    hosts, m_host = groups(0, lambda k: rate)
    host_rate = {k: (g + m_host * rate) / (n + m_host) for k, (g, n) in hosts.items()}
    _, m_path = groups(1, lambda k: host_rate[k.split("/")[0]])
    assert np.allclose([site.rate, site.m_host, site.m_path], [rate, m_host, m_path])
    got = [r.score for r in quality._decided(ws, ws.keep(df.coalesce(1), "judged")).collect()]
    assert np.allclose(sorted(got), sorted(plain_scores(rows, m_host, m_path, rate)))


def test_rows_between_are_joined_and_nothing_else(spark, monkeypatch):
    """The same rows stay with any filter and number of sites, whatever they let through."""
    from costlens.llm.common import KeyFilter

    good = "A calm sentence about things, in plain words. Another one follows it here."
    rows = [(i, f"{good} Number {i}." if i % 4 else f"JUNK!! %%% ### {i}", f"h{i % 50}.x/p") for i in range(400)]
    rows += [(None, rows[1][1], "h1.x/p"), (3, rows[4][1], None), (5, None, "h"), (6, "", None)]
    y = [(i, int(i % 4 > 0), 0) for i in range(400)]
    d, l = frame(spark, rows), labels(spark, y)
    want = sorted((r.doc_id or -1, r.text) for r in quality.keep_good(d, l).collect())
    assert 250 < len(want) < 330
    monkeypatch.setattr(quality, "BROADCAST_SITES", 0)
    for bits in (64, 1 << 12, 1 << 26):
        monkeypatch.setattr(KeyFilter, "MAX_BITS", bits)
        got = quality.keep_good(d, l)
        assert sorted((r.doc_id or -1, r.text) for r in got.collect()) == want

"""Operator 10: quality classifier by hierarchical empirical Bayes.

Evidence.  Each text is reduced to shares of byte classes, word statistics and
repetition of words and lines; a ridge-penalised logistic regression on a
bounded labelled sample (not the rows with ``crc32(doc_id) mod 5 = 0``) turns
them into a log likelihood ratio of good against bad.  The prior is the share of
good among all labelled documents with words outside the held-out fold, not that
of the bounded sample.

Sites.  ``source`` is read as ``host/path``: the host, and the host with its
first path segment.  Over all documents, grouped sums of the classifier's
probabilities give every host a posterior rate, shrunk toward the global rate,
and every path one shrunk toward its host's.  The strengths of shrinking are
estimated by the method of moments from the spread between groups beyond what
their sizes explain, so a site with few documents stays at its prior.

Score.  The logit of the path's posterior, taken from the other documents of the
host and the path, plus the document's evidence, as a probability; a document is
kept at 0.5 or more.

Group sums are sums of whole numbers (millionths), so results do not depend on
the order of rows.  Hot hosts are pre-aggregated in the map tasks.  Site tables
are broadcast only below ``BROADCAST_SITES`` rows; beyond, the narrow table of judged
rows, which holds no texts, is shuffled to them.

Defined results: a null, empty or wordless text scores 0 and is rejected, and
counts nothing for its site; a null source is the site ''; without labels of
both kinds every text with words scores 0.5 by evidence alone; repeated rows get
equal results; an empty table gives an empty result; extra columns are kept by
``keep_good`` and ignored by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import (
    KeyFilter,
    Workspace,
    byte_table,
    hash_words,
    map_batches,
    rows_where,
    text_buffer,
)
from costlens.llm.labelled import class_counts, fold_number, training_sample

MAX_GOOD = 8_000
MAX_BAD = 8_000
BROADCAST_SITES = 100_000
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1e4

_WORDS = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
_LINES = byte_table(b"\n\r")


def _class_table() -> np.ndarray:
    """Byte classes: 0 letter, 1 capital, 2 digit, 3 space, 4 line end, 5 sentence mark, 6 symbol."""
    out = np.full(256, 6, np.uint8)
    out[128:] = 0
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 1
    out[ord("0") : ord("9") + 1] = 2
    out[[32, 9, 11, 12]] = 3
    out[[10, 13]] = 4
    out[[ord(c) for c in ".,;:?'\"()-"]] = 5
    return out


_CLASSES = _class_table()
FEATURES = 10


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:])], float)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature rows, word counts) of a text column."""
    raw, offsets = text_buffer(column)
    size = np.diff(offsets).astype(float)
    kinds = _CLASSES[raw]
    full = np.flatnonzero(size)
    share = np.zeros((len(size), 7))
    for k in range(1, 7):
        if len(full):
            share[full, k] = np.add.reduceat((kinds == k), offsets[full], dtype=np.int64)
    share /= np.maximum(size, 1)[:, None]
    words, starts, ends, first = hash_words(raw, offsets, _WORDS)
    n = np.diff(first).astype(float)
    lines, _, _, line_first = hash_words(raw, offsets, _LINES)
    n_lines = np.diff(line_first).astype(float)
    letters = np.concatenate([[0], np.cumsum(ends - starts)])
    length = (letters[first[1:]] - letters[first[:-1]]) / np.maximum(n, 1)
    one = np.maximum(n, 1)
    x = np.column_stack(
        [
            share[:, 1],  # capitals
            share[:, 2],  # digits
            share[:, 4] * 10,  # line ends
            share[:, 5] * 5,  # sentence marks
            share[:, 6] * 5,  # symbols
            np.sqrt(share[:, 6]),
            _distinct(words, first) / one,
            1 - _distinct(lines, line_first) / np.maximum(n_lines, 1),
            np.log1p(length),
            np.log1p(n) / 5,
        ]
    )
    return x, n


class Evidence:
    """Standardised logistic regression; ``llr`` is its logit at even odds.

    ``prior`` comes from the numbers of all labelled documents per label.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, labelled: dict[int, int]):
        good, bad = labelled.get(1, 0), labelled.get(0, 0)
        self.prior = (good + 0.5) / (good + bad + 1)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
        self.scale = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(FEATURES)
        self.beta = np.zeros(FEATURES + 1)
        if 0 < y.sum() < len(y):
            # both kinds weigh the same, so the intercept carries no prior
            weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
            design = np.column_stack([np.ones(len(x)), self._standard(x)])
            ridge = np.diag([1e-3] + [1.0] * FEATURES)
            for _ in range(60):
                p = 1 / (1 + np.exp(-np.clip(design @ self.beta, -30, 30)))
                grad = design.T @ (weight * (y - p)) - ridge @ self.beta
                hess = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
                step = np.linalg.solve(hess, grad)
                self.beta = self.beta + np.clip(step, -2, 2)
                if np.abs(step).max() < 1e-8:
                    break

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def llr(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.beta[0] + self._standard(x) @ self.beta[1:], -30, 30)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def fit_evidence(ws: Workspace, docs: DataFrame, labels: DataFrame) -> Evidence:
    sample = training_sample(ws, docs, labels, "quality", {1: MAX_GOOD, 0: MAX_BAD})

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, n = features(batch.column(0))
        keep = n > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(x[keep]), pa.list_(pa.float64())),
                batch.column(1).filter(pa.array(keep)),
            ],
            names=["x", "label"],
        )

    # bounded: at most MAX_GOOD + MAX_BAD rows of FEATURES numbers
    rows = map_batches(sample.select("text", "label"), run, "x array<double>, label int").toArrow()
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, FEATURES)
    y = rows["label"].to_numpy().astype(float)
    order = np.lexsort(np.column_stack([x, y]).T)  # the fit does not depend on row order
    worded = docs.filter(docs["text"].cast("string").rlike(r"[^\x00\t\n\x0b\f\r ]"))
    return Evidence(x[order], y[order], class_counts(worded, labels, "quality"))


def site_of(source: Column) -> tuple[Column, Column]:
    """(host, path): path is the host with the first segment after it."""
    plain = F.regexp_replace(F.coalesce(source.cast("string"), F.lit("")), r"^\w+://", "")
    parts = F.split(plain, "/", 3)
    host = F.lower(parts[0])
    return host, F.concat_ws("/", host, F.coalesce(F.get(parts, F.lit(1)), F.lit("")))


def _strength(groups: DataFrame, prior: Column) -> float:
    """Pseudo-count of a Beta prior from the spread of group rates around ``prior``."""
    rate = F.col("good") / F.col("n")
    row = groups.agg(
        F.sum(F.col("n") * (rate - prior) * (rate - prior)).alias("spread"),
        F.sum(F.col("n") * prior * (1 - prior)).alias("within"),
        F.sum("n").alias("n"),
        F.count("*").alias("groups"),
    ).first()
    if not row["n"] or row["groups"] < 2 or not row["within"]:
        return MAX_STRENGTH
    # the expected spread is (groups - 1) * v + n * tau2, v the variance of one document
    v = row["within"] / row["n"]
    tau2 = (row["spread"] - (row["groups"] - 1) * v) / row["n"]
    if tau2 <= 0:
        return MAX_STRENGTH
    return float(min(max(v / tau2 - 1, MIN_STRENGTH), MAX_STRENGTH))


def _inside(rate: Column) -> Column:
    return F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))


def others_logit(own: Column, counted: Column) -> Column:
    """The logit of a path's posterior from all its documents but one.

    ``own`` is what that document put into its site's sums (``counted``: whether it
    did), so that its evidence does not count twice, least of all on sparse sites.
    """
    own, one = F.when(counted, own).otherwise(0.0), F.when(counted, 1).otherwise(0)
    m_host, m_path = F.col("m_host"), F.col("m_path")
    host = (F.greatest(F.col("host_good") - own, F.lit(0.0)) + m_host * F.col("rate")) / (
        F.col("host_n") - one + m_host
    )
    post = _inside(
        (F.greatest(F.col("path_good") - own, F.lit(0.0)) + m_path * host)
        / (F.col("path_n") - one + m_path)
    )
    return F.log(post / (1 - post))


def site_posteriors(ws: Workspace, judged: DataFrame) -> DataFrame:
    """site_host, site_path, site_logit from (host, path, millionths) of all documents.

    Further columns hold the sums and strengths that ``others_logit`` starts from.
    """
    sites = ws.keep(
        judged.groupBy("host", "path").agg(
            (F.sum("millionths") / 1e6).alias("good"), F.count("millionths").alias("n")
        ),
        "site-sums",
    ).filter("n > 0")
    hosts = ws.keep(
        sites.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "host-sums"
    )
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    rate = (total["good"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    m_host = _strength(hosts, F.lit(rate))
    hosts = hosts.select(
        F.col("host").alias("h"),
        ((F.col("good") + m_host * rate) / (F.col("n") + m_host)).alias("host_rate"),
        F.col("good").alias("host_good"),
        F.col("n").alias("host_n"),
    )
    placed = ws.keep(sites.join(hosts, F.col("host") == F.col("h")), "placed-sites")
    m_path = _strength(placed, F.col("host_rate"))
    post = (F.col("good") + m_path * F.col("host_rate")) / (F.col("n") + m_path)
    post = _inside(post)
    return ws.keep(
        placed.select(
            F.col("host").alias("site_host"),
            F.col("path").alias("site_path"),
            F.log(post / (1 - post)).alias("site_logit"),
            F.col("good").alias("path_good"),
            F.col("n").alias("path_n"),
            "host_good",
            "host_n",
            F.lit(rate).alias("rate"),
            F.lit(m_host).alias("m_host"),
            F.lit(m_path).alias("m_path"),
        ),
        "sites",
    )


def _marks(docs: DataFrame) -> tuple[Column, Column]:
    """Two hashes of the text and its site, which together tell its decision."""
    host, path = site_of(docs["source"])
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return F.xxhash64(text, host, path), F.xxhash64(F.lit(1), path, text)


def _judged(docs: DataFrame, evidence: Evidence) -> DataFrame:
    """doc_id, host, path, two marks, llr, millionths (the probability at the prior)."""
    host, path = site_of(docs["source"])
    mark, second = _marks(docs)
    source = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        host.alias("host"),
        path.alias("path"),
        mark.alias("mark"),
        second.alias("second"),
        docs["text"].cast("string").alias("text"),
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, n = features(batch.column(5))
        llr = evidence.llr(x)
        p = _sigmoid(llr + np.log(evidence.prior / (1 - evidence.prior)))
        none = n == 0
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:5],
                pa.array(llr, mask=none),
                pa.array(np.round(p * 1e6).astype(np.int64), mask=none),
            ],
            names=["doc_id", "host", "path", "mark", "second", "llr", "millionths"],
        )

    return map_batches(
        source,
        run,
        "doc_id long, host string, path string, mark long, second long, llr double, millionths long",
    )


def _decided(ws: Workspace, judged: DataFrame) -> DataFrame:
    """``judged`` with site_logit, score and kept; only this narrow table meets the sites."""
    sites = site_posteriors(ws, judged)
    small = sites.count() <= BROADCAST_SITES
    on = (judged["host"] == sites["site_host"]) & (judged["path"] == sites["site_path"])
    out = judged.join(F.broadcast(sites) if small else sites, on, "left")
    counted = F.col("millionths").isNotNull()
    out = out.withColumn("site_logit", others_logit(F.col("millionths") / 1e6, counted))
    value = F.coalesce(1 / (1 + F.exp(-(F.col("llr") + F.col("site_logit")))), F.lit(0.0))
    return out.withColumn("score", value).withColumn("kept", F.col("score") >= 0.5)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, host, path, held_out, evidence, site_logit, score, kept per document."""
    ws = Workspace(docs.sparkSession, "quality")
    judged = ws.keep(_judged(docs, fit_evidence(ws, docs, labels)), "judged")
    return _decided(ws, judged).select(
        "doc_id",
        "host",
        "path",
        F.coalesce(fold_number(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.col("llr").alias("evidence"),
        "site_logit",
        "score",
        "kept",
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept documents, all columns as they came.

    Decisions are made on the narrow table of judged rows and found again by the hashes
    of text and site.  Rows that are surely kept, and rows that are surely rejected
    (no kept row's hash is let through with them), are told in scans; only the few
    between are shuffled and joined, whatever the number of sites.
    """
    ws = Workspace(docs.sparkSession, "quality")
    judged = ws.keep(_judged(docs, fit_evidence(ws, docs, labels)).drop("doc_id"), "judged")
    decided = ws.keep(_decided(ws, judged).select("mark", "second", "kept"), "decided")
    bad = ws.keep(decided.filter("not kept").select("mark", "second").distinct(), "rejected")
    rejected = KeyFilter(bad, "mark").lookup()
    good = decided.filter("kept").select("mark").distinct()
    doubtful = ws.keep(rows_where(good, good["mark"], rejected), "doubtful")
    kept = KeyFilter(doubtful, "mark").lookup()
    free = rows_where(docs, _marks(docs)[0], lambda k: ~rejected(k))
    between = rows_where(docs, _marks(docs)[0], lambda k: rejected(k) & kept(k))
    mark, second = _marks(between)
    same = (mark == bad["mark"]) & (second == bad["second"])
    return free.unionByName(between.join(bad, same, "left_anti"))

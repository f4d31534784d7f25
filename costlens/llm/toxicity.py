"""Operator 1: toxicity scores from a weighted lexicon.

Folding.  A text is lower-cased; accents, compatibility forms, look-alike letters
of other scripts and digit substitutions become plain letters; zero-width marks
vanish and everything that is no letter becomes one space.

Lexicon.  Entries are word stems (matched at the start of a word) and whole
words.  They and their weights are learned from labelled documents: the
smoothed log ratio of the share of toxic and of clean documents with the entry,
less one standard error.  A longer stem is kept only where it says more than a
shorter one.  Exception phrases (a fixed parameter, and words that start like
an entry but are usual in clean documents) cancel the matches inside them.

Score.  One Aho-Corasick pass finds all entries; per word the longest counts.
Three inputs can enter a logistic curve, fitted on labelled documents that took no
part in the lexicon: the summed weight and the weight per 100 words (length-
normalised), in which each matching word counts once however often it is repeated,
and the weight of all occurrences per 100 words.  Which of ``INPUTS`` enter is decided
by the log loss on halves of those documents that the curve was not fitted on.

Training reads only labels of rows with ``crc32(doc_id) mod 5 <> 0``, at most
``MAX_TOXIC`` and ``MAX_CLEAN`` of them, picked by a hash of the id; remainders
1-3 give the lexicon and remainder 4 the curve, whose rows are weighted by the
odds of the labels counted over all labelled documents outside the held-out fold,
so the threshold does not move with the size of the sample.  Scores use the text
alone.

Defined results: a null or empty text has no matches and gets the score of a
text without matches; without toxic labels all scores are the smoothed base
rate; several label rows of one id count as toxic if one does, null labels are
ignored; repeated rows get equal results; a null doc_id is not held out; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import Workspace, map_batches
from costlens.llm.labelled import class_counts, fold_number, training_sample

MAX_TOXIC = 4_000
MAX_CLEAN = 8_000
STEMS = range(4, 10)  # stem lengths in letters
MIN_SUPPORT = 3  # distinct toxic texts
MIN_WEIGHT = 1.5
MAX_ENTRIES = 20_000
# inputs that a curve may take: total, density of distinct words, density of occurrences
INPUTS = ((0, 1), (0, 2), (2,), (0, 1, 2))
MIN_GAIN = 1e-3  # nats a row by which further inputs must lower the log loss
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "idiot proof")

# Letters of other scripts that look like Latin ones, and digits
# that stand for letters; i, l and 1 stand for one another and fold to i.
_LOOK_ALIKES = dict(
    zip(
        "авекмнорстухіјѕԁɡһԛԝαβεικνορτυχ013456789@ıøđłßæœl",
        "abekmhopctyxijsdghqwabeikvoptyxoieasbtbgaiodisaoi",
    )
)


class FoldTable(dict):
    """Code point to folded letter, space or nothing; filled as characters appear."""

    def __missing__(self, code: int) -> str:
        out = ""
        for ch in unicodedata.normalize("NFKD", chr(code).lower()):
            kind = unicodedata.category(ch)
            if ch in _LOOK_ALIKES:
                out += _LOOK_ALIKES[ch]
            elif kind in ("Mn", "Me", "Cf"):  # accents, joiners, zero-width marks
                continue
            else:
                out += ch if kind[0] == "L" else " "
        self[code] = out
        return out


_FOLD = FoldTable()


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    return (text or "").translate(_FOLD).split()


def _entries(words: list[str]) -> set[str]:
    """All stems and whole words (ending in a space) of a text."""
    own = set(words)
    out = {w + " " for w in own if len(w) >= 3}
    for n in STEMS:
        out.update(w[:n] for w in own if len(w) >= n)
    return out


class Lexicon:
    """Weighted entries, exceptions and the score curve; sent to the workers."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], curve=(0.0, 0.0, 0.0, 0.0)):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve
        self._automaton = None

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve}

    def __setstate__(self, state):
        self.__dict__.update(state, _automaton=None)

    def automaton(self):
        if self._automaton is None:
            auto = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                auto.add_word(" " + entry, (len(entry), weight))
            for phrase in self.exceptions:
                auto.add_word(f" {phrase} ", (len(phrase) + 1, None))
            if len(auto):
                auto.make_automaton()
            self._automaton = auto
        return self._automaton

    def matches(self, words: list[str]) -> list[tuple[str, float]]:
        """(word, weight) of each word that matches and lies in no exception."""
        auto = self.automaton()
        if not words or not len(auto):
            return []
        text = f" {' '.join(words)} "
        found: dict[int, float] = {}  # by word start; the longest match comes last
        excepted: list[tuple[int, int]] = []
        for end, (length, weight) in auto.iter(text):
            begin = end - length
            if weight is None:
                excepted.append((begin, end))
            else:
                found[begin] = weight
        for begin, end in excepted:
            for at in [x for x in found if begin <= x < end]:
                del found[at]
        return [(text[at + 1 : text.index(" ", at + 1)], w) for at, w in found.items()]

    def features(self, words: list[str]) -> tuple[float, float]:
        return self.inputs(words)[:2]

    def inputs(self, words: list[str]) -> tuple[float, float, float]:
        """Total weight and density of the distinct matching words, density of all matches."""
        found = self.matches(words)
        total, occurring = sum(dict(found).values()), sum(w for _, w in found)
        hundreds = (len(words) + 20) / 100
        return np.log1p(total), np.log1p(total / hundreds), np.log1p(occurring / hundreds)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _curve_values(np.array(self.curve), x)


def _curve_values(beta: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(beta[0] + x @ beta[1:], -30, 30)))


def _count_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    for value, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
        counts[toxic].update(_entries(fold(value.as_py())))
    for toxic, own in enumerate(counts):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(own), pa.string()),
                pa.array(list(own.values()) if toxic else [0] * len(own), pa.int64()),
                pa.array(list(own.values()) if not toxic else [0] * len(own), pa.int64()),
            ],
            names=["entry", "toxic", "clean"],
        )


def _class_weights(y: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Row weights, one on average, under which both kinds have their share of all labels."""
    toxic, n = y.sum(), n_toxic + n_clean
    return np.where(y == 1, n_toxic / toxic, n_clean / (len(y) - toxic)) * len(y) / n


def _on(x: np.ndarray, y: np.ndarray, weight: np.ndarray, some: tuple[int, ...]) -> np.ndarray:
    """The curve over some of the inputs; the others' slopes are 0."""
    beta = np.zeros(1 + x.shape[1])
    beta[[0, *(1 + i for i in some)]] = _fit_curve(x[:, list(some)], y, weight)
    return beta


def choose_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """The curve over the first of ``INPUTS``, or over those that lower the log loss on halves
    not fitted on by ``MIN_GAIN`` a row or more.  Rows are dealt to the halves in order of label and inputs, so the
    choice does not depend on their order."""
    order = np.lexsort((*x.T[::-1], y))
    x, y, weight = x[order], y[order], weight[order]
    half = np.arange(len(y)) % 2
    best, least = INPUTS[0], np.inf
    for some in INPUTS:
        loss = 0.0
        for mine in (half == 0, half == 1):
            if 0 < y[mine].sum() < mine.sum():
                p = np.clip(_curve_values(_on(x[mine], y[mine], weight[mine], some), x[~mine]), 1e-9, 1 - 1e-9)
                own = np.where(y[~mine] == 1, np.log(p), np.log(1 - p))
                loss -= float(weight[~mine] @ own)
        if loss < least - MIN_GAIN * weight.sum():
            best, least = some, loss
    return tuple(float(v) for v in _on(x, y, weight, best))


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Ridge-penalised logistic regression by Newton steps; slopes never negative."""
    design = np.column_stack([np.ones(len(x)), x])
    # prior rows keep the intercept finite and the curve rising where data is scarce
    penalty = np.array([1e-3] + [1e-2] * x.shape[1])
    beta = np.zeros(1 + x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (y - p)) - penalty * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    if (beta[1:] < 0).any():  # features that say the same: keep the total
        beta = np.append(_fit_single(design[:, :2], y, weight), np.zeros(x.shape[1] - 1))
    return tuple(float(v) for v in beta)


def _fit_single(design: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (y - p)) - 1e-2 * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return np.array([beta[0], max(beta[1], 0.0)])


def learn(ws: Workspace, sample: DataFrame, labelled: dict[int, int], exceptions=EXCEPTIONS) -> Lexicon:
    """Entries, weights, exceptions and curve from a training sample.

    ``labelled`` has the number of all labelled documents per label.
    """
    parts = {r[0]: r[1] for r in sample.filter("label = 1").groupBy("fold").count().collect()}
    split = sum(n for f, n in parts.items() if f != 4) >= 5 and parts.get(4, 0) >= 5
    lexicon_part = sample.filter("fold <> 4") if split else sample
    totals = {r[0]: r[1] for r in lexicon_part.groupBy("label").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    counts = ws.keep(
        map_batches(
            lexicon_part.select("text", "label"),
            _count_batch,
            "entry string, toxic long, clean long",
        )
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(f"toxic >= {MIN_SUPPORT} or clean >= {MIN_SUPPORT}"),
        "entry-counts",
    )
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.log(t / (n_toxic + 1)) - F.log(c / (n_clean + 1))
    counts = counts.withColumn("weight", weight - F.sqrt(1 / t + 1 / c))
    rows = (
        counts.filter((F.col("toxic") >= MIN_SUPPORT) & (F.col("weight") >= MIN_WEIGHT))
        .orderBy(F.desc(F.col("weight") * F.col("toxic")), "entry")
        .limit(MAX_ENTRIES)
        .collect()
    )
    weights: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r["entry"]), r["entry"])):
        shorter = [weights[r["entry"][:n]] for n in STEMS if r["entry"][:n] in weights]
        if not shorter or r["weight"] > shorter[-1] + 0.7:
            weights[r["entry"]] = r["weight"]
    # whole words under a stem that are usual in clean texts
    stems = [e for e in weights if not e.endswith(" ")]
    learned: list[str] = []
    if stems:
        under = F.broadcast(sample.sparkSession.createDataFrame([(s,) for s in stems], "stem string"))
        usual = counts.filter(
            (F.col("entry").endswith(" ")) & (F.col("clean") >= MIN_SUPPORT) & (weight < 0)
        )
        heads = F.explode(F.array(*(F.substring("entry", 1, n) for n in STEMS)))
        learned = [
            r[0].strip()
            for r in usual.select("entry", "clean", heads.alias("stem"))
            .join(under, "stem", "left_semi")
            .groupBy("entry")
            .agg(F.max("clean").alias("clean"))
            .orderBy(F.desc("clean"), "entry")
            .limit(MAX_ENTRIES)
            .collect()
        ]
    phrases = [" ".join(fold(p)) for p in exceptions] + learned
    lexicon = Lexicon(weights, [p for p in phrases if p])

    def featured(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = np.array([lexicon.inputs(fold(v.as_py())) for v in batch.column(0)]).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c) for c in x.T), batch.column(1)], names=["a", "b", "c", "label"]
        )

    curve_part = sample.filter("fold = 4") if split else sample
    fitted = map_batches(
        curve_part.select("text", "label"), featured, "a double, b double, c double, label int"
    ).toArrow()
    y = fitted["label"].to_numpy().astype(float)
    x = np.column_stack([fitted[c].to_numpy() for c in "abc"])
    all_toxic, all_clean = labelled.get(1, 0), labelled.get(0, 0)
    if weights and 0 < y.sum() < len(y):
        lexicon.curve = choose_curve(x, y, _class_weights(y, all_toxic, all_clean))
    else:
        rate = min((all_toxic + 0.5) / (all_toxic + all_clean + 1), 0.49)
        lexicon.curve = (float(np.log(rate / (1 - rate))), 1.0 if weights else 0.0, 0.0, 0.0)
    return lexicon


def score(docs: DataFrame, labels: DataFrame, exceptions=EXCEPTIONS) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of matches per document."""
    ws = Workspace(docs.sparkSession, "toxicity")
    sample = training_sample(ws, docs, labels, "toxic", {1: MAX_TOXIC, 0: MAX_CLEAN})
    lexicon = learn(ws, sample, class_counts(docs, labels, "toxic"), exceptions)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = [fold(v.as_py()) for v in batch.column(2)]
        x = np.array([lexicon.inputs(w) for w in words]).reshape(-1, 3)
        scores = lexicon.scores(x)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(scores),
                pa.array((scores >= 0.5).astype(np.int32)),
            ],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    held_out = F.coalesce(fold_number(docs["doc_id"]) == 0, F.lit(False))
    source = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        docs["text"].cast("string").alias("text"),
    )
    return map_batches(source, run, "doc_id long, held_out boolean, score double, predicted int")

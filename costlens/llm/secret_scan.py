"""Operator 4: secret scans with a random forest against false positives.

DataFrame and SQL functions only; no Python on the executors.

Candidates.  Long runs of key characters with a digit, and provider formats,
found by one regular expression; their places follow from the lengths of the
pieces between them.  A run begins after an assignment sign (``=`` belongs to it
only as padding at its end) and ends before the full stops of a sentence; a
provider's key is a candidate of its own wherever a run holds one.  Whatever is
assigned to a key word is a candidate too, however short and whatever its signs.

Features (per candidate): length; shares of digits, capitals and symbols;
character transitions (changes between letter, capital, digit and symbol per
character, and the mean log odds of its letter pairs in the corpus' own words
against even odds); dictionary coverage (share of characters inside common
words of the corpus); path (source looks like code or configuration);
neighbouring words (a key word and an assignment before it, quotes around it,
words of examples and placeholders nearby, an address or file sign next to it).

Training.  ``pyspark.ml`` grows the forest on labelled findings (feature columns
and ``label``).  By default these are derived from the corpus: candidates with a
key word and an assignment or with a provider's format are positive unless they
look like placeholders or, without a digit, like words; candidates that are
addresses, numbers or words joined by signs, assigned plain words, and those
without any key word, are negative.  At most
``MAX_FINDINGS`` of each kind, picked by hash, are used; letter pairs and common
words are counted over all documents.

Scoring.  The trained trees are written out as a SQL expression and evaluated
inside the scan, row by row: scoring and redaction shuffle nothing.

Defined results: null and empty texts have no findings; a text may have any
number of findings, each returned once per row and place; repeated rows repeat
their findings; with findings of one kind only, the forest's score is that
kind; an empty table gives an empty result; extra columns are ignored by
``findings`` and kept by ``redact``; null ids and sources are allowed.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import Workspace, let, running_totals, sha256_hex

MASK = "[SECRET]"
MAX_FINDINGS = 20_000
TREES = 15
DEPTH = 5
PAIR_ROWS = 1 << 12  # letter pairs kept for the transition odds
WORD_ROWS = 2_000  # common words of the dictionary
CONTEXT = 48  # characters looked at on either side

# Formats that providers publish for their keys.
KEY_FORMATS = (
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|AIza[0-9A-Za-z_-]{35}(?![A-Za-z0-9_-])|sk_live_[0-9A-Za-z]{16,}"
    r"|(?<![_-])(?:sk-(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}"
    r"|eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_.-]*[A-Za-z0-9_-]))"
)
KEY_WORD = (
    r"(?i)(token|secret|passw(or)?d|pwd|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|auth|bearer)"
)
# What stands before an assigned value; the first two parts only spare the last one.
_ASSIGNING = (
    r"(?<=[=:>\s\"'`])(?=[^\s\"'`])(?<=[=:>]\s{0,8}[\"'`]?)"
    rf"(?<=(?:{KEY_WORD})[\w-]{{0,40}}[\"'`\]]{{0,2}}\s{{0,8}}(?:=|:|=>|:=)\s{{0,8}}[\"'`]?)"
)
# A quoted value, or one up to a blank, closing signs or the next assignment; no address.
_VALUE = (
    r"(?:(?<=\")[^\"\r\n]++(?=\")|(?<=')[^'\r\n]++(?=')|(?<=`)[^`\r\n]++(?=`)"
    r"|(?!(?i:bearer|basic)\s|[A-Za-z]{2,8}://)[^\s\"'`<>]+?"
    r"(?=[.,;:!?)\]}]{0,8}(?:[\s\"'`<>]|\z)|[&,;|][\w.-]{1,40}[=:]))"
)
# A private key block up to its end (without one, its lines of key characters), a
# provider's key, a value assigned to a key word, or a run of key characters of at least
# 16 that holds a digit and no provider's key (then only the rest of the run is one).
_BLOCK = r"-----BEGIN [A-Z0-9 ]{0,32}PRIVATE KEY(?: BLOCK)?-----"
_RUN = r"[A-Za-z0-9_+/.@-]"
CANDIDATE = (
    rf"{_BLOCK}(?>[\s\S]*?(?=-----(?:BEGIN|END) )){_BLOCK.replace('BEGIN', 'END')}"
    rf"|{_BLOCK}(?=\s*+[A-Za-z0-9+/=]{{40}})[A-Za-z0-9+/=\s]*[A-Za-z0-9+/=]"
    rf"|{KEY_FORMATS}"
    rf"|{_ASSIGNING}{_VALUE}"
    rf"|(?:(?<!{_RUN})|\G)(?=[A-Za-z_+/.@-]*+[0-9])(?={_RUN}{{16}})(?!{_RUN}*?{KEY_FORMATS})"
    rf"{_RUN}{{15,}}[A-Za-z0-9_+/@-](?:={{1,2}}(?![A-Za-z0-9_+/=.@-]))?"
)
PROVIDER = rf"^({KEY_FORMATS}|-----BEGIN [\s\S]*)$"
ASSIGNED = r"(=|:|=>|:=|\b(is|bearer))\s*[\"'`]?$"
PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|changeme|your|test|fake|xxxx|1234567|abcdef|0000000)"
CODE_PATH = r"(?i)(\.(py|js|ts|java|go|rb|env|ya?ml|json|ini|cfg|conf|toml|tf|sh)$|git|config|code)"
ADDRESS = r"@[\w.-]+\.[A-Za-z]{2,}|^(\d{1,3}\.){3}\d{1,3}|^[+(]?[\d.()/ -]+$|^\w+(\.[A-Za-z]\w*)+$"

FEATURE_NAMES = (
    "length",
    "digits",
    "capitals",
    "symbols",
    "changes",
    "pair_odds",
    "coverage",
    "path",
    "key_word",
    "assigned",
    "quoted",
    "placeholder",
    "address",
    "provider",
)


def _share(text: Column, pattern: str) -> Column:
    kept = F.regexp_replace(text, pattern, "")
    return (F.length(text) - F.length(kept)) / F.length(text)


class Language:
    """Letter-pair odds and common words of a corpus, as bounded literal maps."""

    def __init__(self, pairs: dict[str, float], words: list[str]):
        self.pairs, self.words = pairs, words

    @classmethod
    def count(cls, ws: Workspace, docs: DataFrame) -> Language:
        """Counted over all documents: words first, then the pairs of the distinct words."""
        text = F.lower(F.coalesce(docs["text"].cast("string"), F.lit("")))
        words = docs.select(F.explode(F.split(text, r"[^a-z]+")).alias("word"))
        counts = ws.keep(
            words.filter("length(word) between 2 and 24")
            .groupBy("word")
            .agg(F.count("*").alias("n"))
            .filter("n > 1"),
            "words",
        )
        at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
        pairs = (
            counts.select("word", "n", at.alias("at"))
            .groupBy(F.expr("substring(word, at, 2)").alias("pair"))
            .agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "pair")
            .limit(PAIR_ROWS)
            .collect()  # at most 26 * 26 pairs
        )
        total = sum(r["n"] for r in pairs)
        odds = {r["pair"]: _log(r["n"] / total * 676) for r in pairs}
        common = (
            counts.filter("length(word) >= 4").orderBy(F.desc("n"), "word").limit(WORD_ROWS)
        )
        return cls(odds, sorted(r["word"] for r in common.collect()))


def _log(x: float) -> float:
    return max(-3.0, min(3.0, math.log(x)))


def _pieces(value: Column) -> Column:
    """Array of (before, gap, value, next): every candidate with the text before and after it.

    ``gap`` begins after the previous candidate, which ``before`` holds with its own
    gap: it may be the name that this one is assigned to.  Texts without candidates,
    nearly all, are not split.
    """
    found = F.regexp_extract_all(value, F.lit(CANDIDATE), F.lit(0))
    gaps = F.split(value, CANDIDATE, -1)
    none = F.array(F.lit(""))
    zipped = F.arrays_zip(
        F.slice(F.concat(none, gaps), F.lit(1), F.size(found)).alias("gap_before"),
        F.slice(F.concat(none, found), F.lit(1), F.size(found)).alias("value_before"),
        F.slice(gaps, F.lit(1), F.size(found)).alias("gap"),
        found.alias("value"),
        F.slice(gaps, F.lit(2), F.size(found)).alias("next"),
    )
    rows = F.transform(
        zipped,
        lambda x: F.struct(
            F.concat(F.right(x["gap_before"], F.lit(CONTEXT)), x["value_before"]).alias("before"),
            x["gap"].alias("gap"),
            x["value"].alias("value"),
            x["next"].alias("next"),
        ),
    )
    kind = "array<struct<before:string,gap:string,value:string,next:string>>"
    return F.when(value.rlike(CANDIDATE), rows.cast(kind)).otherwise(F.array().cast(kind))


def _placed(pieces: Column) -> Column:
    """The pieces with ``start``, the candidate's first character counted from 0."""

    def placed(all_: Column) -> Column:
        sizes = F.transform(all_, lambda x: F.length(x["gap"]) + F.length(x["value"]))
        return F.zip_with(
            all_,
            running_totals(sizes),
            lambda x, before: F.struct(
                (before + F.length(x["gap"])).cast("int").alias("start"),
                x["before"].alias("before"),
                x["gap"].alias("gap"),
                x["value"].alias("value"),
                x["next"].alias("next"),
            ),
        )

    return let(pieces, placed)


def feature_columns(c: Column, path: Column, language: Language) -> dict[str, Column]:
    """The features of one candidate (a struct with before, gap, value, next) as doubles."""
    v = c["value"]
    left, right = F.right(c["gap"], F.lit(CONTEXT)), F.left(c["next"], F.lit(CONTEXT))
    name = F.right(F.concat(c["before"], c["gap"]), F.lit(CONTEXT))
    low = F.lower(v)
    shape = F.regexp_replace(
        F.regexp_replace(F.translate(v, "0123456789", "0" * 10), "[a-z]", "a"), "[A-Z]", "A"
    )
    shape = F.regexp_replace(shape, "[^aA0]", "-")
    runs = F.length(F.regexp_replace(shape, r"(.)\1*", "$1"))
    pairs = F.filter(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(low) - 1, F.lit(1))),
            lambda i: F.substring(low, i, F.lit(2)),
        ),
        lambda p: p.rlike("^[a-z0-9]{2}$"),
    )
    table = F.create_map(*[F.lit(x) for kv in sorted(language.pairs.items()) for x in kv])
    if not language.pairs:
        table = F.create_map().cast("map<string,double>")
    odds = F.aggregate(
        pairs,
        F.lit(0.0),
        lambda s, p: s + F.coalesce(F.try_element_at(table, p), F.lit(-3.0)),
        lambda s: s / F.greatest(F.size(pairs), F.lit(1)),
    )
    words = "|".join(sorted(language.words, key=lambda w: (-len(w), w))) or "(?!)"
    coverage = _share(low, f"({words})")
    near = F.concat_ws(" ", left, right)

    def flag(x: Column) -> Column:
        return x.cast("double")

    return {
        "length": F.length(v).cast("double"),
        "digits": _share(v, "[0-9]"),
        "capitals": _share(v, "[A-Z]"),
        "symbols": _share(v, "[^A-Za-z0-9]"),
        "changes": runs / F.length(v),
        "pair_odds": odds,
        "coverage": coverage,
        "path": flag(F.coalesce(path.cast("string"), F.lit("")).rlike(CODE_PATH)),
        "key_word": flag(name.rlike(KEY_WORD + r"([\w-]{0,40}|[\w \"'-]{0,12})[^\w]{0,4}$")),
        "assigned": flag(name.rlike(ASSIGNED)),
        "quoted": flag(left.rlike("[\"'`]$") & right.rlike("^[\"'`]")),
        "placeholder": flag(low.rlike(PLACEHOLDER) | near.rlike(PLACEHOLDER)),
        "address": flag(v.rlike(ADDRESS) & ~v.rlike(PROVIDER)),
        "provider": flag(v.rlike(PROVIDER)),
    }


def _featured(pieces: Column, path: Column, language: Language) -> Column:
    """The pieces, each with its features in field ``f``."""

    def row(c: Column) -> Column:
        named = [x.alias(n) for n, x in feature_columns(c, path, language).items()]
        return F.struct(c.alias("c"), F.struct(*named).alias("f"))

    return F.transform(pieces, row)


def derived_findings(docs: DataFrame, language: Language) -> DataFrame:
    """Labelled findings (features and label) from rules of high precision.

    A key word that is assigned the candidate, or a provider's format, is a
    finding; a placeholder, an address or a number is not, nor is a candidate
    without any key word before it.  An assigned value without a digit is a finding
    if it is quoted and neither words nor code, and none if it is a short or common
    word.  The rest stays unlabelled.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(F.explode(_featured(_pieces(text), docs["source"], language)).alias("x"))
    word = "f.quoted = 1 and f.coverage < 0.5 and not value rlike '[ \\\\t(){}$<>]'"
    key = f"f.key_word + f.assigned = 2 and (f.digits > 0 and f.length >= 6 or {word})"
    yes = f"f.placeholder = 0 and f.address = 0 and (f.provider = 1 or {key})"
    plain = "f.coverage >= 0.8 or f.quoted = 0 and f.symbols = 0 and f.length < 12"
    no = (
        "f.placeholder = 1 or f.address = 1 or f.key_word + f.provider = 0"
        f" or f.provider = 0 and f.digits = 0 and ({plain})"
    )
    rows = rows.select("x.f", F.col("x.c.value").alias("value")).withColumn(
        "label", F.when(F.expr(yes), 1.0).when(F.expr(no), 0.0)
    )
    return rows.filter("label is not null").select("f.*", "label", F.xxhash64("value").alias("h"))


class Forest:
    """Trees grown by ``pyspark.ml``, kept as nested tests on the features."""

    def __init__(self, trees: list):
        self.trees = trees

    @classmethod
    def train(cls, ws: Workspace, findings: DataFrame) -> Forest:
        """From labelled findings, equal ones once.

        At most ``MAX_FINDINGS`` of each label are learnt from; they weigh as much as all
        findings of their label, so that the cut does not follow the bound.
        """
        if "h" not in findings.columns:
            findings = findings.withColumn("h", F.xxhash64(*FEATURE_NAMES))
        findings = ws.keep(findings.dropDuplicates(["h", "label"]), "findings")
        parts = [
            findings.filter(F.col("label") == y).orderBy("h").limit(MAX_FINDINGS) for y in (0.0, 1.0)
        ]
        some = ws.keep(parts[0].unionByName(parts[1]), "training")
        counts = {r["label"]: r["count"] for r in findings.groupBy("label").count().collect()}
        kinds = list(counts)
        if len(kinds) < 2:  # nothing to tell apart
            return cls([float(kinds[0]) if kinds else 0.0])
        vectors = VectorAssembler(inputCols=list(FEATURE_NAMES), outputCol="features")
        weights = {y: max(1.0, n / MAX_FINDINGS) for y, n in counts.items()}
        weight = F.when(F.col("label") == 1.0, weights[1.0]).otherwise(weights[0.0])
        rows = vectors.transform(some).select("features", "label", weight.alias("weight"))
        grown = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, seed=7, subsamplingRate=0.8, weightCol="weight"
        ).fit(rows)
        return cls([_node(tree._java_obj.rootNode()) for tree in grown.trees])

    def score(self, f: Column) -> Column:
        """The mean of the trees' probabilities as one expression over struct ``f``."""
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + _tests(tree, f)
        return total / F.lit(float(len(self.trees)))


def _node(node):
    """A tree of pyspark.ml as (feature, threshold, left, right) or a leaf's probability."""
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return stats[1] / max(sum(stats), 1e-12)
    split = node.split()
    return (
        FEATURE_NAMES[split.featureIndex()],
        split.threshold(),
        _node(node.leftChild()),
        _node(node.rightChild()),
    )


def _tests(node, f: Column) -> Column:
    if not isinstance(node, tuple):
        return F.lit(float(node))
    name, threshold, left, right = node
    return F.when(f[name] <= threshold, _tests(left, f)).otherwise(_tests(right, f))


def train(ws: Workspace, docs: DataFrame, labelled: DataFrame | None) -> tuple[Language, Forest]:
    language = Language.count(ws, docs)
    findings = derived_findings(docs, language) if labelled is None else labelled
    return language, Forest.train(ws, findings)


def findings(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of every text: doc_id, source, start, length, digest, score, is_secret."""
    ws = Workspace(docs.sparkSession, "secrets")
    language, forest = train(ws, docs, labelled)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    pieces = _featured(_placed(_pieces(text)), docs["source"], language)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        F.explode(pieces).alias("x"),
    )
    score = forest.score(F.col("x.f"))
    return rows.select(
        "doc_id",
        "source",
        F.col("x.c.start").cast("long").alias("start"),
        F.length("x.c.value").cast("long").alias("length"),
        sha256_hex(F.col("x.c.value")).alias("value_sha256"),
        score.alias("score"),
        (score >= 0.5).alias("is_secret"),
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents, every column as it came, secrets in ``text`` replaced by ``MASK``."""
    ws = Workspace(docs.sparkSession, "secrets")
    language, forest = train(ws, docs, labelled)
    value = docs["text"].cast("string")
    text = F.coalesce(value, F.lit(""))
    masked = F.transform(
        _featured(_pieces(text), docs["source"], language),
        lambda x: F.concat(
            x["c"]["gap"],
            F.when(forest.score(x["f"]) >= 0.5, F.lit(MASK)).otherwise(x["c"]["value"]),
        ),
    )
    end = F.element_at(F.split(text, CANDIDATE, -1), -1)
    clean = F.when(text.rlike(CANDIDATE), F.concat(F.array_join(masked, ""), end)).otherwise(value)
    return docs.select(*(clean.alias(c) if c == "text" else docs[c] for c in docs.columns))

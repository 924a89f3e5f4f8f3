"""Toxicity by weak supervision.

Lexicon and pattern voters look at a text.  A generative label model estimates,
by expectation-maximisation over counts of vote patterns, how accurate each
voter is and how voters correlate: given the truth, each voter depends on one
other, along the tree of greatest mutual information.  Its posterior labels
train a linear classifier over words and word beginnings, which scores every
text.

Some lexicons are fixed lists; others are mined from all labelled rows: words
and word beginnings that occur in far more toxic than clean texts, one voter
for each length.  The label model sees the votes on every text, with a label or
without; only the classifier is fitted on a sample.  Labels of rows held out are
never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.common import literal, unit_interval

# Fixed word lists by theme.
LEXICONS = {
    "wits": "idiot idiots moron morons stupid dumb fool imbecile dimwit halfwit brainless cretin simpleton",
    "worth": "loser losers worthless useless pathetic failure nobody waste garbage trash scum filth vermin parasite",
    "scorn": "disgusting clown pig rat creep freak ugly gross repulsive vile despicable contemptible",
    "abuse": "bastard bitch asshole jerk shit crap damn hell fuck fucking wanker prick slut whore",
    "threat": "kill hang shoot burn hurt destroy beat murder strangle",
    "german": "idiot dumm trottel arschloch abschaum versager ekelhaft wertlos hurensohn schwein depp",
    "french": "idiot imbécile connard salope abruti ordure minable dégoûtant nul crétin merde",
    "spanish": "idiota imbécil estúpido basura escoria perdedor asqueroso inútil payaso mierda patético",
}
_LEXICONS = {name: frozenset(words.split()) for name, words in LEXICONS.items()}
_INSULTS = frozenset().union(*(_LEXICONS[n] for n in ("wits", "worth", "scorn", "abuse")))
#: Lengths of the word beginnings that are mined; whole words have a voter of their own.
STEMS = (3, 4, 5, 6)
_WORD = re.compile(r"\w+")
_ADDRESS = re.compile(r"\b(?:you(?:'re| are)?|du|ihr|tu|vous|tú|usted)\b(?:\s+\w+){0,3}?\s+(\w+)")
_MASKED = re.compile(r"\b\w[*#@$]{2,}\w*")
_SHOUT = re.compile(r"\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b.*!")
_BANG = re.compile(r"[!?]{3,}")
PATTERNS = ("address", "masked", "shouting", "bangs", "twice")


def features(text: str) -> set[str]:
    """Distinct words in lower case, and their beginnings marked by a star."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for n in STEMS:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def pattern_hits(text: str, low: str, listed: Sequence[str], words: set[str]) -> tuple[bool, ...]:
    """The pattern voters, in the order of PATTERNS; given the text, it in lower case, its words in order and as a set."""
    # words are gone through, and each pattern is looked for, only where the signs they cannot do without are there
    hits = 0 if words.isdisjoint(_INSULTS) else sum(w in _INSULTS for w in listed)
    return (
        hits > 0 and any(m in _INSULTS for m in _ADDRESS.findall(low)),
        any(c in low for c in "*#@$") and _MASKED.search(low) is not None,
        "!" in text and _SHOUT.search(text) is not None,
        ("!" in text or "?" in text) and _BANG.search(text) is not None,
        hits >= 2,
    )


@dataclass
class LabelModel:
    """Accuracy of each voter, the voter each one depends on, and the posterior of each vote pattern."""

    accuracy: dict[str, float]
    parent: dict[str, str | None]
    posterior: np.ndarray


def _tree(joint: np.ndarray) -> list[int]:
    """Parent of each voter in the spanning tree of greatest conditional mutual information; the root has -1.

    ``joint[y, i, a, j, b]`` are weights of class y with vote a of voter i and b of voter j.
    """
    classes, m = joint.shape[0], joint.shape[1]
    share = joint / joint[:, :1, :, :1, :].sum(axis=(2, 4), keepdims=True).clip(1e-9)
    weight = joint[:, 0, :, 0, :].sum(axis=(1, 2))
    weight = weight / weight.sum()
    information = np.zeros((m, m))
    for i in range(m):
        for j in range(m):
            if i != j:
                for y in range(classes):
                    p = share[y, i, :, j, :]
                    outer = p.sum(axis=1, keepdims=True) * p.sum(axis=0, keepdims=True)
                    on = p > 0
                    information[i, j] += weight[y] * float((p[on] * np.log(p[on] / outer[on])).sum())
    parent, inside = [-1] * m, {0}
    while len(inside) < m:
        i, j = max(((i, j) for i in inside for j in range(m) if j not in inside), key=lambda e: information[e])
        parent[j] = i
        inside.add(j)
    return parent


#: How often a given label is taken to be right.
TRUST = 0.97


def label_model(
    votes: np.ndarray, given: np.ndarray, counts: np.ndarray, names: Sequence[str], rounds: int = 12
) -> LabelModel:
    """Fit on distinct vote patterns (1 for, -1 against, 0 silent) with the given label (1, -1, or 0 without) and their counts.

    The labels start the estimation and count in it with a fixed accuracy, so
    what is toxic stays what they say; all that is estimated are the voters.
    From the second round on texts without a label count as their votes say.
    """
    n, m = votes.shape
    at = votes + 1
    right = np.array([0.02, 0.5, 0.48]), np.array([0.48, 0.5, 0.02])  # of class 1, of class 0
    sure = given * math.log(TRUST / (1 - TRUST))
    belief = 1 / (1 + np.exp(-sure))
    hot = np.zeros((n, m, 3))
    hot[np.arange(n)[:, None], np.arange(m)[None, :], at] = 1.0
    parent = [-1] * m
    for turn in range(rounds):
        seen = counts if turn else counts * (given != 0)
        weight = np.stack([seen * (1 - belief), seen * belief])
        joint = np.stack([np.einsum("n,nia,njb->iajb", w, hot, hot, optimize=True) for w in weight])
        parent = _tree(joint + 1e-6)
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        odds = sure + math.log(prior[1] / prior[0])
        for y, sign in ((1, 1), (0, -1)):
            for j in range(m):
                alone = np.einsum("n,na->a", weight[y], hot[:, j]) + 2 * right[1 - y]
                alone /= alone.sum()
                p = np.broadcast_to(alone, (3, 3))
                if parent[j] >= 0:
                    p = joint[y, parent[j], :, j, :] + 4 * alone
                    p = p / p.sum(axis=1, keepdims=True)
                    odds += sign * np.log(p[at[:, parent[j]], at[:, j]])
                else:
                    odds += sign * np.log(alone[at[:, j]])
        belief = 1 / (1 + np.exp(-np.clip(odds, -20, 20)))
    truth = np.where(belief >= 0.5, 1, -1)
    accuracy = {}
    for j, name in enumerate(names):
        voted = votes[:, j] != 0
        hits = (counts * (votes[:, j] == truth))[voted].sum()
        accuracy[name] = float((hits + 1) / (counts[voted].sum() + 2))
    return LabelModel(accuracy, {names[j]: names[p] if p >= 0 else None for j, p in enumerate(parent)}, belief)


@dataclass
class Classifier:
    """Weights of a linear classifier over words, word beginnings, fixed lexicons and patterns."""

    bias: float
    weights: dict[str, float]
    fixed: tuple[float, ...]
    labels: LabelModel | None = None

    def score(self, text: str) -> float:
        z, weights, of_word = self.bias, self.weights, self.of_word
        if text:
            low = text.lower()
            words = set(listed := _WORD.findall(low))
            if len(of_word) > 200_000:
                of_word.clear()
            for w in words.difference(of_word):
                of_word[w] = tuple(f for f in (w, *(w[:n] + "*" for n in STEMS if len(w) > n)) if f in weights)
            found = set(chain.from_iterable(map(of_word.__getitem__, words)))
            z += math.fsum(sorted(weights[f] for f in found))
            lexicons = (not words.isdisjoint(own) for own in _LEXICONS.values())
            hits = (*lexicons, *pattern_hits(text, low, listed, words))
            z += math.fsum(w for w, hit in zip(self.fixed, hits, strict=True) if hit)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def __post_init__(self) -> None:
        #: the features of words met before
        self.of_word: dict[str, tuple[str, ...]] = {}


class Voters:
    """All voters on a text as the bits of a number: lexicons, patterns, mined words, mined beginnings by length."""

    SIZE = len(_LEXICONS) + len(PATTERNS) + 1 + len(STEMS)

    def __init__(self, sure: Iterable[str]) -> None:
        self.sure, self.of_word = frozenset(sure), {}

    def _bits(self, word: str) -> int:
        mined = len(_LEXICONS) + len(PATTERNS)
        bits = sum(1 << i for i, listed in enumerate(_LEXICONS.values()) if word in listed)
        bits |= (word in self.sure) << mined
        for i, n in enumerate(STEMS):
            bits |= (len(word) > n and word[:n] + "*" in self.sure) << (mined + 1 + i)
        return bits

    def __call__(self, text: str) -> int:
        of_word, bits = self.of_word, 0
        if len(of_word) > 200_000:
            of_word.clear()
        low = text.lower()
        words = set(listed := _WORD.findall(low))
        for w in words.difference(of_word):
            of_word[w] = self._bits(w)
        for own in set(map(of_word.__getitem__, words)):
            bits |= own
        for i, hit in enumerate(pattern_hits(text, low, listed, words), len(_LEXICONS)):
            bits |= hit << i
        return bits

    @classmethod
    def votes(cls, bits: np.ndarray) -> np.ndarray:
        """A row of votes for each number: 1 or 0, and last a vote against where none is for."""
        marks = bits[:, None] >> np.arange(cls.SIZE) & 1
        return np.column_stack([marks, -(bits == 0).astype(np.int64)])


def _fit(rows: list[np.ndarray], extra: np.ndarray, target: np.ndarray, size: int, steps: int = 400, ridge: float = 2e-4) -> tuple:
    """Logistic regression on sparse rows (indices of features) and a few dense columns, by adaptive gradient steps."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows) if rows else np.empty(0, np.int64)
    w, d, b = np.zeros(size), np.zeros(extra.shape[1]), -2.0
    share = target.sum() / max(1, len(target))
    balance = np.where(target >= 0.5, 0.5 / max(share, 0.05), 0.5 / max(1 - share, 0.05))
    gw, gd, gb = np.full(size, 1e-6), np.full(extra.shape[1], 1e-6), 1e-6
    for _ in range(steps):
        z = b + np.bincount(owner, w[index], len(rows)) + extra @ d
        miss = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / max(1, len(rows))
        one, two, three = np.bincount(index, miss[owner], size) + ridge * w, extra.T @ miss + ridge * d, miss.sum()
        gw, gd, gb = gw + one**2, gd + two**2, gb + three**2
        w, d, b = w - 0.5 * one / np.sqrt(gw), d - 0.5 * two / np.sqrt(gd), b - 0.5 * three / math.sqrt(gb)
    return float(b), w, d


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's label is for testing only; a NULL id has no label to learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """All distinct texts with a label that is not held out: key, text, toxic.

    A document with several labels has the one that most of them say, toxic on a tie.
    """
    own = labels.filter(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    own = own.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("toxic"))
    texts = docs.filter(~held_out(id_col) & F.col(id_col).isNotNull() & (F.length(text_col) > 0))
    texts = texts.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    # which row stands for a text is settled on ids and keys; then each text is moved once, by both,
    # so that copies of one text do not meet; the same plan at every size
    chosen = texts.select("_id", "key").join(own.hint("merge"), "_id")
    chosen = stage(chosen.groupBy("key").agg(F.min("_id").alias("_id"), F.max("toxic").alias("toxic")))
    # most rows without a label are told by a bitmap of bounded size and not moved at all
    named = F.xxhash64("_id", "key")
    maybe = texts.filter(_marked(named, chosen.select(named.alias("named"))))
    found = maybe.join(chosen.hint("merge"), ["key", "_id"]).dropDuplicates(["key", "_id"])
    return found.select("key", "text", "toxic")


def _marked(value: Column, held: DataFrame, bits: int = 1 << 23) -> Column:
    """Whether a hash may be among those of ``held`` (column ``named``): never false for one that is.

    The bitmap is 1 MB whatever the number of rows; with many more rows than bits
    it lets all pass, and the join alone decides.
    """
    place = F.pmod("named", F.lit(bits))
    words = held.select(place.alias("place")).groupBy(F.expr("cast(place div 64 as int)").alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")).collect()
    table = np.zeros(bits // 64, np.int64)
    table[[r["word"] for r in words]] = [r["bits"] for r in words]
    own = F.pmod(value, F.lit(bits))
    word = F.element_at(literal(table.tolist(), "array<bigint>"), (F.call_function("div", own, F.lit(64)) + 1).cast("int"))
    return F.call_function("shiftrightunsigned", word, (own % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def vote_counts(docs: DataFrame, known: DataFrame, sure: Iterable[str], text_col: str) -> DataFrame:
    """How many distinct texts of all ``docs`` have which votes (bits) and label: bits, given (1, -1, or 0 without), n."""
    voters = Voters(sure)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "bits": [voters(t) for t in batch["text"]]})

    texts = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")).filter(F.length("text") > 0)
    seen = texts.mapInPandas(run, "key long, bits long").groupBy("key").agg(F.min("bits").alias("bits"))
    given = F.coalesce(2 * F.col("toxic") - 1, F.lit(0)).alias("given")
    return seen.join(known.select("key", "toxic"), "key", "left").groupBy("bits", given).agg(F.count(F.lit(1)).alias("n"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    most: int = 20_000,
    least_texts: int = 3,
    mined: int = 6000,
    seed: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Classifier:
    """Mine the lexicons, fit the label model, train the classifier.

    ``most`` bounds the labelled texts that the classifier is fitted on, drawn at
    random, ``mined`` the features.  Without any labelled text the fixed lexicons
    alone make the classifier.
    """
    known = stage(labelled(docs, labels, label_col, id_col, text_col))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bad: Counter[str] = Counter()
        good: Counter[str] = Counter()

        def told() -> pd.DataFrame:
            keys = [k for k in bad.keys() | good.keys() if len(k) > 2]
            return pd.DataFrame({"feature": keys, "bad": [bad[k] for k in keys], "good": [good[k] for k in keys]})

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                (bad if toxic else good).update(features(text))
                if len(good) + len(bad) > 500_000:
                    yield told()
                    bad.clear()
                    good.clear()
        if bad or good:
            yield told()

    whole = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_good = whole.get(1, 0), whole.get(0, 0)
    ratio = F.log(((F.col("bad") + 0.1) / (n_bad + 1)) / ((F.col("good") + 0.5) / (n_good + 1)))
    strong = (
        known.mapInPandas(counted, "feature string, bad long, good long")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .filter((F.col("bad") >= least_texts) & (ratio >= 2.0))
        .orderBy((F.col("bad") * ratio).desc(), "feature")
        .limit(mined)
        .collect()
    )
    vocabulary = {r["feature"]: i for i, r in enumerate(strong)}
    # a mined voter needs features that are rare in clean texts
    sure = {r["feature"] for r in strong if r["bad"] >= 20 * r["good"]}
    fixed = sorted(set().union(*_LEXICONS.values()) - vocabulary.keys())
    vocabulary |= {w: len(strong) + i for i, w in enumerate(fixed)}
    names = [*_LEXICONS, *PATTERNS, "word", *(f"stem{n}" for n in STEMS), "clean"]

    def voted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voters = Voters(sure)
        for batch in batches:
            out = []
            for key, text, toxic in zip(batch["key"], batch["text"], batch["toxic"], strict=True):
                bits, own = voters(text), features(text)
                out.append((key, bits, 1 if toxic else -1, sorted(vocabulary[f] for f in own if f in vocabulary)))
            yield pd.DataFrame(out, columns=["key", "bits", "given", "found"])

    sample = known
    if n_bad + n_good > most:
        sample = known.filter(unit_interval(F.lit(seed), F.col("key")) < F.lit(most / (n_bad + n_good)))
    rows = sorted(sample.mapInPandas(voted, "key long, bits long, given int, found array<int>").collect(), key=lambda r: r["key"])
    if not rows or not n_bad or not n_good:
        return Classifier(-4.0, dict.fromkeys(sorted(_INSULTS), 6.0), (0.0,) * len(_LEXICONS) + (2.0, 1.0, 0.5, 0.0, 1.0))
    patterns = sorted((r["bits"], r["given"], r["n"]) for r in vote_counts(docs, known, sure, text_col).collect())
    bits, given, counts = (np.array(x) for x in zip(*patterns, strict=True))
    model = label_model(Voters.votes(bits), given, counts.astype(np.float64), names)
    of = {(b, g): i for i, (b, g, _) in enumerate(patterns)}
    target = model.posterior[[of[r["bits"], r["given"]] for r in rows]]
    hits = Voters.votes(np.array([r["bits"] for r in rows]))[:, : len(_LEXICONS) + len(PATTERNS)].astype(float)
    bias, w, d = _fit([np.array(r["found"], np.int64) for r in rows], hits, target, len(vocabulary))
    weights = {f: round(float(w[i]), 6) for f, i in vocabulary.items() if abs(w[i]) > 1e-3}
    return Classifier(round(bias, 6), weights, tuple(round(float(x), 6) for x in d), model)


def score(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """Rows (row, score): ``row`` is the whole row of ``docs`` as a struct; a NULL text counts as empty."""
    packed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scored = F.pandas_udf(lambda texts: texts.map(model.score).astype("float64"), "double")
    return packed.select("row", scored("text").alias("score"))


def rate(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.5, **options: object
) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1, higher is more toxic), predicted (1 from ``cut`` on).

    Empty and NULL texts get the score of a text without any evidence; NULL
    ids are scored and not held out; repeated rows score alike; an empty table
    gives no rows.  Other columns of either table are not read.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    found = score(docs.select(F.col(id_col), F.col(text_col)), model, text_col)
    own = F.col("row")[id_col]
    return found.select(own.alias(id_col), "score").select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def keep_clean(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.5, **options: object
) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    return score(docs, model, text_col).filter(F.col("score") < cut).select("row.*")

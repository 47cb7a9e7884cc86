"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text is cut into clauses and words. The lexicon transducer maps words to
symbols: I (insult), H (threat), Y (target), N (negation), R (reported speech),
o (other). Three more transducers rewrite the symbols of a clause in turn:

1. negation: an N opens ``NEGATION_REACH`` words in which I becomes n and H becomes h;
2. reported speech: an R opens the rest of its clause, in which I becomes r and H becomes q;
3. target: Y within ``TARGET_REACH`` words of a plain I or H makes it T or K.

Each final symbol has a weight; a clause's score is the sum of the weights it
emits (an insult's weight grows with the evidence of its lexicon entry), and a
document's score is the logistic of its matched clauses' scores and a bias.

The lexicon and the weights are learned from labelled rows only. Entries are
words and word stems (prefixes of ``STEMS`` letters) that occur, neither negated
nor reported, significantly more often in toxic documents, counted on at most ``LEARN_ROWS`` labelled rows
(the documented bound); an entry needs several distinct contexts, so that copies
of one document prove nothing. Seed insults stay beside the learned entries: each
counts as ``SEED_ROWS`` toxic rows before any label, and goes only where the labels
bring its toxic share down to that of any row. Each class is sampled up to half of the bound, so a
sampled clean row counts as many times as makes the classes stand as in all training
labels: in the shares, the evidence and the fit. Weights start at prior values and
are fitted by regularised logistic regression on the same rows. Without labels the prior
weights and seed words alone decide. Labels, ids, sources and languages are
never inputs of a score.

A null or empty text matches nothing and gets the score of the bias.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, fold, reliable

# Seed words of the symbol classes (any language of the corpus).
INSULTS = "idiot idiots moron morons imbecile stupid dumb scum worthless pathetic loser losers disgusting".split()
THREATS = "kill hurt destroy strangle stab shoot beat murder töten umbringen tuer frapper matar golpear".split()
TARGETS = ("you your yours yourself they them their he him she her people person du dich dir ihr euch sie er vous "
           "toi tu te ils elles tú usted ustedes ellos ellas").split()
NEGATIONS = ("not no never nor neither without isn aren wasn weren don doesn didn nicht kein keine keinen nie niemals "
             "pas jamais aucun aucune nunca jamás ningún ninguna").split()
REPORTS = ("said says say wrote writes called calls claimed claims quoted quotes reported reports according sagte "
           "schrieb nannte laut dit écrit appelé selon dijo escribió llamó según").split()

NEGATION_REACH = 3
TARGET_REACH = 4
STEMS = (4, 5, 6, 7, 8)
LEARN_ROWS = 20_000
MIN_ROWS = 4
SEED_ROWS = 4
MIN_CONTEXTS = 3
MIN_EVIDENCE = 14.0
MIN_LIFT = 2.5
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_NEGATING, _REPORTING = frozenset(NEGATIONS), frozenset(REPORTS)
# Final symbols that weigh, with prior weights: plain insult, at a target,
# negated, reported, plain threat, threat at a target, negated threat, reported threat.
EMITTED = "ITnrHKhq"
PRIOR = np.array([3.0, 4.0, 0.5, 0.3, 0.5, 3.0, 0.2, 0.3])
_DENIED, _TOLD = {"I": "n", "H": "h"}, str.maketrans("IH", "rq")
PRIOR_BIAS = -2.5


@dataclass
class Grammar:
    """Lexicon (entry to evidence in 0..1) and weights; picklable and small."""

    lexicon: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 1.0))
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    bias: float = PRIOR_BIAS
    kept: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        self.fixed = {w: s for s, words in (("H", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS))
                      for w in words}
        self.stems = tuple(sorted({len(k) - 1 for k in self.lexicon if k.endswith("*")}))

    def strength(self, word: str) -> float:
        """Evidence of the strongest lexicon entry that covers the word."""
        return max([self.lexicon.get(word, 0.0),
                    *(self.lexicon.get(word[:n] + "*", 0.0) for n in self.stems if len(word) >= n)])

    def symbol(self, word: str) -> str:
        s = self.kept.get(word)
        if s is None:
            if len(self.kept) > 500_000:
                self.kept.clear()
            s = "." if not word[0].isalpha() else "I" if self.strength(word) > 0 else self.fixed.get(word, "o")
            self.kept[word] = s
        return s

    def clauses(self, text: str) -> Iterator[tuple[list[str], str]]:
        """Words and lexicon symbols of the clauses that hold an insult or a threat."""
        words = _TOKEN.findall(text.lower())
        symbols = "".join(map(self.symbol, words))
        if "I" not in symbols and "H" not in symbols:
            return
        at = 0
        for part in symbols.split("."):
            if "I" in part or "H" in part:
                yield words[at:at + len(part)], part
            at += len(part) + 1

    def features(self, text: str | None) -> np.ndarray:
        """Summed strength of each emitted symbol over the document's matched clauses."""
        out = np.zeros(len(EMITTED))
        for words, symbols in self.clauses(text) if text else ():
            for word, s in zip(words, target(reported(negated(symbols)))):
                k = EMITTED.find(s)
                if k >= 0:
                    out[k] += self.strength(word) if s in "ITnr" else 1.0
        return out

    def score(self, text: str | None) -> float:
        z = float(saturated(self.features(text)) @ self.weights) + self.bias
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def saturated(x: np.ndarray) -> np.ndarray:
    """One match counts most; each further one adds less."""
    return np.log2(1 + x)


def negated(symbols: str) -> str:
    if "N" not in symbols:
        return symbols
    out, left = [], 0
    for s in symbols:
        left = NEGATION_REACH if s == "N" else left
        out.append(_DENIED.get(s, s) if left > 0 else s)
        left -= s != "N"
    return "".join(out)


def reported(symbols: str) -> str:
    head, mark, rest = symbols.partition("R")
    return head + mark + rest.translate(_TOLD) if mark else symbols


def target(symbols: str) -> str:
    if "Y" not in symbols:
        return symbols
    out = list(symbols)
    for k, s in enumerate(symbols):
        if s in "IH" and "Y" in symbols[max(0, k - TARGET_REACH):k + TARGET_REACH + 1]:
            out[k] = "T" if s == "I" else "K"
    return "".join(out)


def plain(words: list[str]) -> set[str]:
    """Words that are neither negated nor reported in their clause."""
    out, left, told = set(), 0, False
    for w in words:
        if not w[0].isalpha():
            left, told = 0, False
        elif w in _NEGATING:
            left = NEGATION_REACH
        elif w in _REPORTING:
            told = True
        elif left:
            left -= 1
        elif not told:
            out.add(w)
    return out


def _entries(word: str) -> Iterator[str]:
    yield word
    for n in STEMS:
        if len(word) >= n:
            yield word[:n] + "*"


def _learn_rows(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, float]:
    """(doc_id, text, toxic) of at most ``rows`` labelled rows outside the held-out fold, in hash order.

    Both classes get half of the bound. With it, how many rows a sampled clean
    one stands for, where a sampled toxic one stands for one: 1.0 below the bound.
    """
    own = labels.where((fold(F.col("doc_id"), 5) != 0) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    one = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = (max(1.0, sizes.get(value, 0) / max(1, rows // 2)) for value in (1, 0))
    chosen = None
    for value in (0, 1):
        part = one.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id"), F.col("text")).where(F.col("text").isNotNull())
    # Of texts that share an id, the least in byte order is learned from.
    learned = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
               .select("doc_id", "text", "toxic"))
    return reliable(learned), clean / toxic


_COUNTS = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
_CONTEXTS = pa.schema([("entry", pa.string()), ("context", pa.int64())])


def learn(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> Grammar:
    """Lexicon and weights from the labelled training rows."""
    learned, stands = _learn_rows(docs, labels, rows)
    by = {r["toxic"]: r["n"] for r in learned.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = by.get(1, 0), by.get(0, 0)
    if not n_toxic or not n_clean:
        return Grammar()

    def tally(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update({e for w in plain(_TOKEN.findall(text.lower())) for e in _entries(w)})
            clean, toxic = counts
            yield from batches(((e, toxic[e], clean[e]) for e in toxic.keys() | clean.keys()), _COUNTS)

    # Clean rows at their number in all training labels; of those not sampled,
    # half a row more than the sample shows, as none there doesn't mean none.
    t, seen = F.col("t"), F.col("c")
    c = seen * F.lit(stands) + 0.5 * max(0.0, stands - 1)
    base = n_toxic / (n_toxic + n_clean * stands)
    share = t / (t + c)
    # Log-likelihood gain of the entry's own toxic share over the base share, in nats.
    gain = t * F.log(share / base) + F.when(c > 0, c * F.log((1 - share) / (1 - base))).otherwise(0.0)
    lift = F.log((t + 0.5) / (n_toxic + 1) / ((seen + 0.5) / (n_clean + 1)))
    least = min(MIN_EVIDENCE, 0.35 * n_toxic * -math.log(base))
    counts = reliable(learned.select("text", "toxic").mapInArrow(tally, "entry string, toxic long, clean long")
                      .groupBy("entry").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
                      .where((t >= MIN_ROWS) | F.col("entry").isin(INSULTS)))
    strong = (counts.where((t >= MIN_ROWS) & (lift >= MIN_LIFT)).select("entry", gain.alias("gain"), share.alias("share"))
              .where(F.col("gain") >= least))
    # Entries of the sampled rows only, so the documented bound on rows bounds them too.
    found = {r["entry"]: (r["gain"], r["share"]) for r in strong.collect()}

    def contexts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            seen: set[tuple[str, int]] = set()
            for text in batch.column(0).to_pylist():
                words = _TOKEN.findall(text.lower())
                for k, w in enumerate(words):
                    for e in _entries(w):
                        if e in found:
                            seen.add((e, hash_of(words[max(0, k - 1):k] + words[k + 1:k + 2])))
            yield from batches(seen, _CONTEXTS)

    if found:
        proven = (learned.where("toxic = 1").select("text").mapInArrow(contexts, "entry string, context long")
                  .distinct().groupBy("entry").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_CONTEXTS))
        proven = {r["entry"] for r in proven.collect()}
        found = {e: v for e, v in found.items() if e in proven}
    seeds = dict.fromkeys(INSULTS, 1.0)
    for r in counts.where(F.col("entry").isin(INSULTS)).collect():
        seeds[r["entry"]] = (r["t"] + SEED_ROWS) / (r["t"] + SEED_ROWS + r["c"] * stands)
    shares = {e: share for e, share in seeds.items() if share > base}
    shares |= {e: max(share, shares.get(e, 0.0)) for e, (_, share) in found.items()}
    grammar = Grammar(lexicon=_reduced(shares))

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([grammar.features(x) for x in texts], dtype=object)

    # At most ``rows`` rows of a few numbers each.
    got = learned.select(features.asNondeterministic()("text").alias("x"), "toxic").collect()
    x = np.array([r["x"] for r in got])
    grammar.weights, grammar.bias = fit(saturated(x), np.array([r["toxic"] for r in got], float), stands)
    grammar.kept = {}
    return grammar


def hash_of(words: list[str]) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(" ".join(words)) - (1 << 63)


def _reduced(shares: dict[str, float]) -> dict[str, float]:
    """Entries without those that a shorter stem covers with the same strength."""
    out: dict[str, float] = {}
    for e in sorted(shares, key=lambda e: (not e.endswith("*"), len(e), e)):
        word = e.rstrip("*")
        over = max((out.get(word[:n] + "*", 0.0) for n in STEMS if len(word) >= n and word[:n] + "*" != e), default=0.0)
        if shares[e] > over + 0.02:
            out[e] = shares[e]
    return out


def fit(x: np.ndarray, y: np.ndarray, stands: float = 1.0, strength: float = 1.0,
        rounds: int = 50) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, drawn to the prior weights by ``strength``.

    A row of class 0 counts ``stands`` times.
    """
    z = np.column_stack([x, np.ones(len(x))])
    prior = np.append(PRIOR, PRIOR_BIAS)
    w = prior.copy()
    pull = np.append(np.full(len(PRIOR), strength), 0.1)
    count = np.where(y > 0, 1.0, stands)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -60, 60)))
        slope = z.T @ (count * (p - y)) + pull * (w - prior)
        curve = (z * (count * p * (1 - p))[:, None]).T @ z + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, grammar: Grammar, column: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(
        {"lexicon": grammar.lexicon, "weights": grammar.weights, "bias": grammar.bias})
    cached: list[Grammar] = []

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not cached:
            cached.append(Grammar(**shared.value))
        return pd.Series([cached[0].score(t) for t in texts], dtype="float64")
    return docs.withColumn(column, scored.asNondeterministic()(F.col(text_col)))


def report(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = docs.select("doc_id", "text")
    scored = score(docs, learn(docs, labels, rows))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))

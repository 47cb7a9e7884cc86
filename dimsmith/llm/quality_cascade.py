"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is one boolean expression that rejects a document. Its cost (time
per row) and selectivity (share of rows rejected) are measured on a bounded
sample; rules then run in the order of rejections per cost inside one CASE, so
a document stops at the first rule that rejects it. The order changes the work
and never the verdict.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words and is
rejected by ``few_words``. Empty tables use the rules in the order given.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, fresh, reliable

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
SAMPLE_ROWS = 1000


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside its lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text.

    64-bit window hashes decide whether any window can repeat; only texts with
    equal hashes compare the windows themselves, so the count is exact.
    """
    def hashes(w):
        h = F.transform(w, lambda x: F.xxhash64(x))
        return let(h, lambda a: F.transform(
            F.sequence(F.lit(0), F.size(a) - window),
            lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(window)])))

    def exact(w):
        keyed = F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - window),
            lambda i: F.struct(F.array_join(F.slice(w, i + 1, F.lit(window)), " ").alias("w"), i.alias("i"))))
        starts = let(keyed, lambda s: F.sort_array(F.filter(F.transform(
            s, lambda x, j: F.when((F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"]), x["i"])),
            lambda i: i.isNotNull())))
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("at"))
        return F.aggregate(
            starts, zero,
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(window), i - acc["at"])).alias("n"), i.alias("at")),
            lambda acc: acc["n"])

    none = F.lit(0).cast("long")
    return let(words, lambda w: F.when(F.size(w) <= window, none).when(
        let(hashes(w), lambda h: F.size(F.array_distinct(h)) == F.size(h)), none).otherwise(exact(w)))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def production_rules(text: Column, words: Column, n_words: Column, repeats: Column,
                     symbols: Column, chars: Column, dup_lines: Column) -> list[Rule]:
    """The base checks and the cascade's own rules, over given measures.

    The own rules only reject plain junk: words that mostly carry mark-up
    symbols, shouting, words of impossible mean length, pages of repeated lines.
    """
    upper = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\p{Lu}"))
    return [
        Rule("few_words", n_words < MIN_WORDS),
        Rule("repeated_words", 100 * repeats > MAX_REPEAT_PERCENT * n_words),
        Rule("symbols", 2 * symbols > n_words),
        Rule("word_length", (chars < 2 * n_words) | (chars > 25 * n_words)),
        Rule("repeated_lines", 10 * dup_lines > 3 * (F.regexp_count(
            F.coalesce(text, F.lit("")), F.lit("\n")) + 1)),
        Rule("shouting", 10 * upper > 6 * chars),
    ]


def _rules(text: Column, words: Column) -> list[Rule]:
    return production_rules(text, words, F.size(words).cast("long"), n_repeat_words(words), n_symbols(text),
                            word_chars(words), n_dup_lines(text))


def measure(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[dict]:
    """Cost and selectivity of each rule on at most ``sample_rows`` rows, best first.

    The sample is spread over the whole table. Rejections per second of rule
    time order the rules; an empty sample leaves the order as it is.
    """
    total = docs.count()
    t = fresh(docs, "t")
    share = min(1.0, 1.2 * sample_rows / total) if total else 1.0
    sample = reliable(docs.select(F.col(text_col).alias(t)).sample(share, seed).limit(sample_rows))
    rules, found = _rules(F.col(t), words_of(F.col(t))), []
    rows = sample.count()
    base = _clock(sample.select(F.count(F.length(t))))[0]
    for place, rule in enumerate(rules):
        took, rejected = _clock(sample.select(F.count_if(rule.rejects)))
        cost = max(took - base, 1e-3) / max(rows, 1)
        found.append({"rule": rule.name, "cost": cost, "rejects": rejected / max(rows, 1), "place": place})
    return sorted(found, key=lambda x: (-(x["rejects"] / x["cost"]), x["place"]) if rows else (0, x["place"]))


def _clock(df: DataFrame) -> tuple[float, int]:
    began = time.perf_counter()
    value = df.first()[0]
    return time.perf_counter() - began, value or 0


def cascade(rules: list[Rule], order: list[str]) -> Column:
    """Name of the first rule, in this order, that rejects the row; null if none does."""
    by = {r.name: r.rejects for r in rules}
    out = None
    for name in order:
        out = F.when(by[name], name) if out is None else out.when(by[name], name)
    return out


def keep(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows that no rule rejects, all columns as they were."""
    order = [x["rule"] for x in measure(docs, text_col, sample_rows)]
    words = fresh(docs, "words")
    text = F.col(text_col)
    held = docs.withColumn(words, words_of(text))
    return held.where(cascade(_rules(text, F.col(words)), order).isNull()).drop(words)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All measures and the verdict of every row.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed and kept.
    """
    order = [x["rule"] for x in measure(docs, text_col, sample_rows)]
    c = F.col
    measured = (docs.select(c(id_col).alias("doc_id"), c(text_col).alias("text"))
                .withColumn("words", words_of(c("text")))
                .select("doc_id", "text", F.size("words").cast("long").alias("n_words"),
                        word_chars(c("words")).alias("word_chars"), n_symbols(c("text")).alias("n_symbols"),
                        n_dup_lines(c("text")).alias("n_dup_lines"),
                        n_repeat_words(c("words")).alias("n_repeat_words")))
    rules = production_rules(c("text"), None, c("n_words"), c("n_repeat_words"), c("n_symbols"),
                             c("word_chars"), c("n_dup_lines"))
    failed = (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), cascade(rules, order).isNull().alias("kept"))

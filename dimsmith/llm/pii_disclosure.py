"""Personal data: exact patterns, and terms that reveal a protected entity by co-occurrence.

Protected entities are the values that the patterns find (e-mail and IP
addresses, card and phone numbers). A word t supports an entity e in every
document that holds both, however far apart; words inside a mention don't count.
Words are runs of letters and digits of any length: the shares reject common ones.
The corpus gives P(e | t): of the distinct documents that hold t, the share that
hold e. Documents with the same text are one. The disclosure of t is
log2(P(e | t) / P(e)), with P(e) the share of all distinct documents that hold e.
A word with at least ``MIN_DOCS`` documents that hold e, P(e | t) of ``MIN_SHARE``
and ``MIN_BITS`` of disclosure is a span wherever it occurs: generalised, or
removed where P(e | t) reaches ``REMOVE_SHARE``. Those documents must be of as many
sketches (the least hash of a document's ``SHINGLE`` words in a row), so that a few
near copies prove nothing. All counts are over all documents.

A null or empty text has no spans. Repeated rows are rows of their own in the
result and count once in the statistics.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, fresh, reliable

KINDS = ("email", "ip", "card", "phone")
MIN_DOCS = 3
SHINGLE = 5
MIN_SHARE = 0.8
REMOVE_SHARE = 0.95
MIN_BITS = 3.0
BLOCK_TERMS = 50_000

# The patterns of the base kinds. Each starts where a maximal run
# starts, so that scanning stays linear; the matches are those of the plain forms.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _entity(kind: str, value: str) -> int:
    plain = value.lower() if kind in ("email", "ip") else _NOT_DIGIT.sub("", value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


def _terms(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _TERM.finditer(text)]


def _outside(terms: list[tuple[str, int, int]], spans: list[tuple[str, int, int]]) -> Iterator[str]:
    """The words that begin in no span."""
    covered = sorted((a, b) for _, a, b in spans)
    k, end = 0, 0
    for word, a, _ in terms:
        while k < len(covered) and covered[k][0] <= a:
            end = max(end, covered[k][1])
            k += 1
        if end <= a:
            yield word


def _document(text: str) -> int:
    """Copies of a text are one document."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _sketch(words: list[str]) -> int:
    """Near copies mostly share it; documents with one line in common mostly don't."""
    return min(xxhash.xxh64_intdigest("\x1f".join(words[i:i + SHINGLE]))
               for i in range(max(1, len(words) - SHINGLE + 1))) - (1 << 63)


def evidence(text: str | None) -> tuple[int, int, list[int], list[str]] | None:
    """(document, sketch, its entities, its words outside mentions); None without a mention."""
    spans = base_spans(text)
    if not spans:
        return None
    terms = _terms(text)
    return (_document(text), _sketch([t[0] for t in terms]), sorted({_entity(kind, text[a:b]) for kind, a, b in spans}),
            sorted(set(_outside(terms, spans))))


_EVIDENCE = pa.schema([("doc", pa.int64()), ("sketch", pa.int64()), ("entities", pa.list_(pa.int64())), ("terms", pa.list_(pa.string()))])
_SEEN = pa.schema([("term", pa.string()), ("doc", pa.int64())])


def disclosing_terms(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, share, bits) of the words that reveal an entity, from all documents."""
    text = docs.select(F.col(text_col).alias("text"))
    nothing = docs.sparkSession.createDataFrame([], "term string, share double, bits double")

    def gather(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = {}
            for t in batch.column(0):
                found = evidence(t.as_py())
                if found:
                    rows[found[0]] = found
            yield from batches(rows.values(), _EVIDENCE, 500)

    held = reliable(text.mapInArrow(gather, "doc long, sketch long, entities array<long>, terms array<string>")
                    .dropDuplicates(["doc"]))
    mentions = held.select("doc", F.explode("entities").alias("entity"))
    # No word can have more documents with an entity than the entity has.
    entity = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= MIN_DOCS)
    pairs = mentions.join(entity, "entity").join(held.drop("entities"), "doc")
    near = reliable(pairs.select("entity", "n_entity", "sketch", F.explode("terms").alias("term"))
                    .groupBy("entity", "n_entity", "term", "sketch").agg(F.count(F.lit(1)).alias("n"))
                    .groupBy("entity", "n_entity", "term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sketches"))
                    .where(F.col("sketches") >= MIN_DOCS).drop("sketches"))
    if near.isEmpty():
        return nothing
    # The documents with mentions are a part of all: a word that misses the share there misses it everywhere.
    part = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_part"))
    near = reliable(near.join(part, "term").where(F.col("n") / F.col("n_part") >= MIN_SHARE).drop("n_part"))
    candidates = reliable(near.groupBy("term").agg(F.max("n").alias("most")))
    # P(e | t) >= MIN_SHARE needs no more documents than this anywhere, so each
    # batch gives up to one more of the smallest: enough to decide exactly.
    found = None
    for block in _blocks(candidates.selectExpr("term", f"cast(most / {MIN_SHARE} as long) + 1 as enough")):
        part = text.mapInArrow(_seen(docs.sparkSession.sparkContext.broadcast(dict(block))), "term string, doc long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return nothing
    total = text.where("text is not null").select(F.xxhash64("text").alias("doc")).distinct().count()
    everywhere = found.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    share = F.col("n") / F.col("n_term")
    bits = F.log2(share * F.lit(float(total)) / F.col("n_entity"))
    scored = near.join(everywhere, "term").select("term", share.alias("share"), bits.alias("bits"))
    return reliable(scored.where((F.col("share") >= MIN_SHARE) & (F.col("bits") >= MIN_BITS))
                    .groupBy("term").agg(F.max("share").alias("share"), F.max("bits").alias("bits")))


def _blocks(rows: DataFrame, size: int = BLOCK_TERMS) -> Iterator[list[tuple]]:
    """Rows in lists of at most ``size``, the most that is ever broadcast at once."""
    held: list[tuple] = []
    for row in rows.orderBy("term").toLocalIterator():
        held.append(tuple(row))
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def _seen(enough: Broadcast):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = enough.value
        for batch in it:
            seen: dict[str, set[int]] = {}
            for t in batch.column(0):
                text = t.as_py()
                terms = [x for x in _terms(text) if x[0] in need] if text else ()
                if not terms:
                    continue
                doc = _document(text)
                for w in set(_outside(terms, base_spans(text))):
                    documents = seen.setdefault(w, set())
                    documents.add(doc)
                    if len(documents) > 4 * need[w] + 64:
                        seen[w] = set(sorted(documents)[:need[w]])
            yield from batches(((w, d) for w, ds in seen.items() for d in sorted(ds)[:need[w]]), _SEEN)
    return run


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, column: str, text_col: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """``docs`` with an array of spans: the base kinds in order, then ``term`` and ``term-removed``."""
    shares = _shares(docs, text_col, terms)
    first, text = shares[0], F.col(text_col)

    @F.pandas_udf(_SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([all_spans(t, first.value) for t in texts], dtype=object)

    out = docs.withColumn(column, spans.asNondeterministic()(text))
    for more in shares[1:]:
        @F.pandas_udf(_SPANS)
        def others(texts: pd.Series, more=more) -> pd.Series:
            return pd.Series([term_spans(t, more.value, base_spans(t)) for t in texts], dtype=object)
        out = out.withColumn(column, F.concat(F.col(column), others.asNondeterministic()(text)))
    return out


def _shares(docs: DataFrame, text_col: str, terms: DataFrame | None) -> list[Broadcast]:
    """P(e | t) of the disclosing terms, in blocks (at least one, maybe empty)."""
    terms = disclosing_terms(docs, text_col) if terms is None else terms
    return [docs.sparkSession.sparkContext.broadcast(dict(b)) for b in [*_blocks(terms.select("term", "share"))] or [[]]]


def term_spans(text: str | None, share: dict[str, float], base: list[tuple[str, int, int]]) -> list[dict]:
    """Spans of the disclosing terms, outside the base spans."""
    if not text or not share:
        return []
    found = [{"kind": "term-removed" if share[w] >= REMOVE_SHARE else "term", "start": a, "end": b}
             for w, a, b in _terms(text) if w in share]
    return [s for s in found if not any(a < s["end"] and s["start"] < b for _, a, b in base)]


def all_spans(text: str | None, share: dict[str, float]) -> list[dict]:
    base = base_spans(text)
    return [{"kind": k, "start": a, "end": b} for k, a, b in base] + term_spans(text, share, base)


def joined(spans: Iterable[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shares = _shares(rows, "text", None)
    one = shares[0] if len(shares) == 1 else None
    source = rows.withColumn("found", F.lit(None)) if one else find(
        rows, "found", terms=rows.sparkSession.createDataFrame(
            [x for b in shares for x in b.value.items()], "term string, share double"))

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def digest(given: pd.Series) -> pd.DataFrame:
        out = []
        for item in given:
            spans = all_spans(item, one.value) if one else item
            order = {k: i for i, k in enumerate((*KINDS, "term", "term-removed"))}
            spans = sorted(spans, key=lambda s: (order[s["kind"]], s["start"]))
            own = [s for s in spans if s["kind"] in KINDS]
            out.append((*(sum(s["kind"] == k for s in own) for k in KINDS),
                        hashlib.sha256(joined(own).encode()).hexdigest(), joined(spans)))
        return pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return source.select("doc_id", digest.asNondeterministic()(F.col("text" if one else "found")).alias("x")).select(
        "doc_id", "x.*")


def replaced(text: str, spans: Iterable[dict]) -> str:
    """The text with each stretch of spans replaced by the kind that begins it; removed terms give nothing."""
    out, at, end = [], 0, 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= end:
            out += [text[at:s["start"]], "" if s["kind"] == "term-removed" else f"<{s['kind'].upper()}>"]
        end = at = max(end, s["end"])
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, with the spans of the text generalised or removed."""
    terms = disclosing_terms(docs, text_col)
    shares = _shares(docs, text_col, terms)
    if len(shares) == 1:  # one pass of one function
        @F.pandas_udf("string")
        def clean(texts: pd.Series) -> pd.Series:
            return pd.Series([_cleaned(t, all_spans(t, shares[0].value)) for t in texts], dtype=object)
        return docs.withColumn(text_col, clean(F.col(text_col)))

    @F.pandas_udf("string")
    def clean_found(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_cleaned(t, s) for t, s in zip(texts, found)], dtype=object)

    column = fresh(docs, "found")
    return find(docs, column, text_col, terms).withColumn(text_col, clean_found(F.col(text_col), F.col(column))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def _cleaned(text: str | None, spans) -> str | None:
    return text if text is None or not len(spans) else replaced(text, spans)

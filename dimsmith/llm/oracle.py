"""DuckDB SQL of the training-data queries that SQL can express."""

import re

from .license_templates import BASE, TEMPLATES, WEIGHT

SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '{SPACE_WORD}') AS words FROM d),
g AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
h AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS win FROM g),
k AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM h) WHERE n > 1),
c AS (SELECT r, sum(least(5, i - coalesce(lag_i, i - 5))) AS n_repeat_words
      FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS lag_i FROM k) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
y AS (SELECT r, sum(n - 1) AS n_dup_lines FROM (SELECT r, line, count(*) AS n FROM l
      WHERE regexp_matches(line, '{SPACE_WORD}') GROUP BY r, line) GROUP BY r),
m AS (SELECT w.doc_id, w.text, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(coalesce(y.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        len(string_split(w.text, chr(10))) AS n_lines, len(regexp_extract_all(w.text, '\p{{Lu}}')) AS n_upper
      FROM w LEFT JOIN c ON c.r = w.r LEFT JOIN y ON y.r = w.r),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 2 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words
       OR 10 * n_dup_lines > 3 * n_lines OR 10 * n_upper > 6 * word_chars) AS kept
FROM f"""

DECONTAMINATION = rf"""
WITH b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '{ALNUM_WORD}') AS words
           FROM benchmark),
s AS (SELECT item, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0),
v AS (SELECT DISTINCT item, array_to_string(words[i:i + 9], ' ') AS win, least(len(words), 10) AS size FROM s),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{ALNUM_WORD}') AS words FROM documents),
z AS (SELECT DISTINCT size FROM v),
p AS (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, z WHERE len(words) >= size),
o AS (SELECT p.r, p.i, p.size, v.item FROM p JOIN v ON v.size = p.size AND v.win = array_to_string(words[i:i + p.size - 1], ' ')),
q AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS pos FROM o) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN q ON q.r = d.r LEFT JOIN t ON t.r = d.r"""



def _pattern(template: str) -> str:
    """A template as a regular expression over words, each followed by a blank."""
    out = template
    out = re.sub(r"<<opt>>", " ( ", out)
    out = re.sub(r"<</opt>>", " )? ", out)
    out = re.sub(r"<<var (\d+)>>", r" [^_]+{0,\1} ", out)
    parts = []
    for p in out.split():
        if p == "(":
            parts.append("(?:")
        elif p == ")?":
            parts.append(p)
        elif p.startswith("["):
            parts.append("(?:[^ ]+ )" + p[p.index("{"):])
        else:
            parts.append(p + " ")
    return " " + "".join(parts)


def _accepts(template: str) -> str:
    if "<<" in template:
        return f"regexp_matches(j, '{_pattern(template)}')"
    return f"contains(j, ' {template} ')"


def _licenses() -> str:
    everything = [(label, "phrase", t) for label, t in BASE] + list(TEMPLATES)
    labels = ", ".join(f"CASE WHEN {_accepts(t)} THEN '{label}' END" for label, _, t in everything)
    weights = ", ".join(f"CASE WHEN {_accepts(t)} THEN {WEIGHT[kind]} ELSE 0.0 END"
                        for _, kind, t in everything)
    places = "\nUNION ALL ".join(
        f"SELECT r, unnest(range(1, len(words) - {n - 2})) AS i, words, '{label}' AS label, '{t}' AS phrase, {n} AS n "
        f"FROM w WHERE contains(j, ' {t} ')" for label, t in BASE for n in [len(t.split())])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{ALNUM_WORD}') AS words FROM documents),
w AS (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS j FROM d),
p AS ({places}),
b AS (SELECT r, count(*) AS n_base, min(i - 1) AS first_word, max(i - 1) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
      FROM p WHERE array_to_string(words[i:i + n - 1], ' ') = phrase GROUP BY r),
x AS (SELECT r, list_sort(list_distinct(list_filter([{labels}], lambda z: z IS NOT NULL))) AS ls,
        greatest({weights}) AS s FROM w)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(array_to_string(ls, ','), '') AS labels, CAST(s AS DOUBLE) AS score
FROM w JOIN x ON x.r = w.r LEFT JOIN b ON b.r = w.r"""


SQL: dict[str, str] = {"op1_license_templates": _licenses(), "op5_quality_rules": QUALITY,
                       "op9_decontamination": DECONTAMINATION}

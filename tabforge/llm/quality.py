"""Line-first quality rules, in DataFrame operations only.

Every line is judged first: too many symbols, a navigation bar, boilerplate, or a long run of
words without any sentence end.  Failing lines are removed, and a document that loses more than
``MAX_LOST`` of its text is rejected, as is one that fails the base rules on whole-text counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import free, table

# The contract's word separators and symbols.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Line rules.
MIN_SYMBOLS, WORDS_PER_SYMBOL = 3, 10      # at least 3 symbols and more than one per 10 words
MIN_SEPARATORS, WORDS_PER_ITEM = 3, 4      # a navigation bar: at least 3 separators, at most 4 words for each
UNPUNCTUATED_WORDS = 25                    # so many words without a sentence end are no prose; a wrapped line of prose has fewer
BOILERPLATE_CHARS = 200                    # boilerplate phrases count in lines up to this long
SEPARATORS = "|>»•·"
SENTENCE_END = "[.!?:;…。！？।॥۔؟]"
BOILERPLATE = ("all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy", "cookie policy", "cookie settings",
               "accept cookies", "accept all cookies", "use cookies", "uses cookies",
               "enable javascript", "sign in", "log in", "click here", "read more", "subscribe to", "subscribe now", "share this", "lorem ipsum")
# A phrase counts as whole words only.
PHRASE = rf"(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(BOILERPLATE)})(?:$|[^\p{{L}}\p{{N}}])"
# A document that loses more than this share of its characters (of lines with words) is rejected.
MAX_LOST = (1, 2)

_POSITION_BITS = 26


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def _pieces(text: Column) -> Column:
    """The text cut at every separator: the words, and an empty piece between separators side by side."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(text, " ", -1)  # a single plain character splits without a regular expression


def _count_of(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def _repeated(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more, each word counted once.

    Windows are sorted by (hash, position) packed in a long; windows that share a hash are then
    compared as text, so the count is exact.  Positions have 26 bits: 67 million words in a text.
    """
    windows = F.size(w) - 2
    hashed = lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), _POSITION_BITS).bitwiseOR(i.cast("long"))
    beside = lambda s: F.array_distinct(F.flatten(F.transform(
        F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda j: F.shiftright(F.get(s, j).bitwiseXOR(F.get(s, j - 1)), _POSITION_BITS) == 0),
        lambda j: F.array(F.get(s, j - 1), F.get(s, j)))))
    place = lambda x: x.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int")
    window = lambda x: F.struct(F.get(w, place(x)).alias("a"), F.get(w, place(x) + 1).alias("b"), F.get(w, place(x) + 2).alias("c"), place(x).alias("p"))
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    twice = lambda s: F.filter(s, lambda x, j: F.coalesce(same(x, F.get(s, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, j + 1)), F.lit(False)))
    found = _let(F.sort_array(F.transform(F.sequence(F.lit(0), windows - 1), hashed)), beside)
    found = F.when(windows > 1, found)
    exact = _let(found, lambda c: F.when(F.size(c) > 0, _let(F.sort_array(F.transform(c, window)), twice)))
    covered = F.array_distinct(F.flatten(F.transform(exact, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))))
    return F.coalesce(F.size(covered), F.lit(0)).cast("long")


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def _line_fails(line: Column, marks: Column) -> Column:
    """``marks``: whether the text has symbols or separators enough for any line to fail by them."""
    words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    symbols, separators = _count_of(line, SYMBOLS), _count_of(line, SEPARATORS)
    phrase = _let(F.lower(line), lambda x: reduce(or_, (F.contains(x, F.lit(p)) for p in BOILERPLATE)) & x.rlike(PHRASE))
    return (
        (marks & (((symbols >= MIN_SYMBOLS) & (symbols * WORDS_PER_SYMBOL > words))
                  | ((separators >= MIN_SEPARATORS) & (words <= separators * WORDS_PER_ITEM))))
        | (~line.rlike(SENTENCE_END) & (words >= UNPUNCTUATED_WORDS))
        | ((F.length(line) <= BOILERPLATE_CHARS) & phrase)
    )


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``kept`` and ``cleaned`` (the text without failing lines).

    A null text counts as one without words: all counts 0, base failed, ``cleaned`` null.  Every
    row is judged by itself, so repeated rows and rows without doc_id need nothing special.
    Columns of these names in ``docs`` are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    counts = _let(_pieces(t), lambda p: _let(F.array_remove(p, ""), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), (F.size(p) - 1).alias("spaces"), _repeated(w).alias("n_repeat_words"))))
    symbols = _count_of(t, SYMBOLS)
    marks = lambda n: reduce(or_, (F.contains(t, F.lit(c)) for c in SEPARATORS if c not in SYMBOLS), n >= min(MIN_SYMBOLS, MIN_SEPARATORS))
    size = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    lines = _let(symbols, lambda n: _let(marks(n), lambda m: _let(F.filter(F.split(t, "\n", -1), _has_word), lambda a: F.struct(
        (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        size(a).alias("length"), n.alias("n_symbols"), size(F.filter(a, lambda x: _line_fails(x, m))).alias("lost")))))
    c, l = free(docs, "_c", "_l")  # noqa: E741
    out = docs.withColumns({c: counts, l: lines}).withColumns({
        "n_words": F.col(f"{c}.n_words"),
        "word_chars": (F.length(t) - F.col(f"{c}.spaces")).cast("long"),
        "n_symbols": F.col(f"{l}.n_symbols").cast("long"),
        "n_dup_lines": F.col(f"{l}.n_dup_lines"),
        "n_repeat_words": F.col(f"{c}.n_repeat_words"),
    })
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    part, whole = MAX_LOST
    out = out.withColumn("base_failed", base_failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col(f"{l}.lost") * whole <= F.col(f"{l}.length") * part))
    cleaned = _let(marks(symbols), lambda m: F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda x: ~_has_word(x) | ~_line_fails(x, m)), "\n"))
    return out.withColumn("cleaned", cleaned).drop(c, l)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: counts and verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS a FROM d),
g AS (SELECT rid, i, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, x, y, z) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY rid),
lines AS (SELECT rid, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
                 length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS symbols,
                 length(x) - length(regexp_replace(x, '[{SEPARATORS}]', '', 'g')) AS separators
          FROM (SELECT rid, unnest(a) AS x FROM w)),
f AS (SELECT rid, sum(length(x)) AS whole,
             sum(CASE WHEN (symbols >= {MIN_SYMBOLS} AND symbols * {WORDS_PER_SYMBOL} > words)
                        OR (separators >= {MIN_SEPARATORS} AND words <= separators * {WORDS_PER_ITEM})
                        OR (words >= {UNPUNCTUATED_WORDS} AND NOT regexp_matches(x, '{SENTENCE_END}'))
                        OR (length(x) <= {BOILERPLATE_CHARS} AND regexp_matches(lower(x), '{PHRASE}'))
                      THEN length(x) ELSE 0 END) AS lost
      FROM lines GROUP BY rid),
c AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(a) - len(list_distinct(a)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND coalesce(lost * {MAX_LOST[1]} <= whole * {MAX_LOST[0]}, TRUE)) AS kept
FROM b LEFT JOIN f USING (rid)
"""

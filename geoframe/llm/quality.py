"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import table

#: Inside a character class of a regular expression.
WHITE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Frequent function words of the four languages.
STOP_WORDS = tuple(
    "the be to of and that have with a in is it for on was as at by this are or from an not but which "
    "le la de et les des en un une du que est pour qui dans par sur au pas plus ne se avec "
    "der die und das ist den von mit zu ein eine nicht auf im dem des sich auch es "
    "el los las y del con para por no una su lo como al".split()
)


class Rule(NamedTuple):
    feature: str
    least: float | None
    most: float | None


#: A text is kept if every feature lies in its range. Ratios are to words, lines with a word or word characters.
RULES = (
    Rule("mean_word", 3.0, 10.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_words", 0.08, None),
    Rule("alphabetic_words", 0.8, None),
    Rule("capitals", None, 0.3),
    Rule("marks_per_word", None, 0.2),
    Rule("duplicate_lines", None, 0.35),
    Rule("ended_lines", 0.2, None),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once for each row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _count(text: Column, characters: str) -> Column:
    """How many characters of a class a text has."""
    return F.regexp_count(text, F.lit(f"[{characters}]")).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside the WINDOW-word windows that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash. A sort by hash finds equal ones; their places in order then
    give the covered words. Texts without an equal pair, found by a hash set, are not sorted.
    """
    hashes = F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0))), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<bigint>"))

    def covered(sorted_: Column) -> Column:
        same = lambda s, k: F.coalesce(F.get(sorted_, k)["h"] == s["h"], F.lit(False))
        places = F.array_sort(F.filter(F.transform(sorted_, lambda s, k: F.when(same(s, k - 1) | same(s, k + 1), s["i"])), lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(places, start, lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")))["n"]

    ordered = lambda h: F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered(h), covered))).cast("long")


def measure(text: Column) -> Column:
    """A struct of the counts and of the features that RULES name, for a whole text; null counts as empty."""

    def lines_of(t: Column) -> Column:
        return F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{WHITE}]"))

    def words_of(t: Column) -> Column:
        return F.filter(F.split(t, f"[{WHITE}]+", -1), lambda w: w != "")

    def counts(t: Column) -> Column:
        return let(F.struct(words_of(t).alias("words"), lines_of(t).alias("lines")), lambda s: F.struct(
            F.size(s["words"]).cast("long").alias("n_words"),
            F.char_length(F.regexp_replace(t, f"[{WHITE}]+", "")).cast("long").alias("word_chars"),
            _count(t, SYMBOLS).alias("n_symbols"),
            (F.size(s["lines"]) - F.size(F.array_distinct(s["lines"]))).cast("long").alias("n_dup_lines"),
            _repeat_words(s["words"]).alias("n_repeat_words"),
            F.size(s["lines"]).cast("long").alias("n_lines"),
            F.size(F.filter(F.split(F.regexp_replace(F.lower(t), f"[.,;:!?]++(?=[{WHITE}]|\\z)", ""), f"[{WHITE}]+", -1), lambda w: w.isin(*STOP_WORDS))).alias("stops"),
            (F.size(s["words"]) - F.regexp_count(t, F.lit(f"(?<![^{WHITE}])[^\\p{{L}}{WHITE}]++(?![^{WHITE}])"))).alias("alphabetic"),
            _count(t, "A-Z").alias("capitals"),
            _count(t, "!?").alias("marks"),
            F.size(F.filter(s["lines"], lambda x: x.rlike(f"[.!?:;\\p{{Pe}}\\p{{Pf}}\"'][{WHITE}]*$"))).alias("ended"),
        ))

    def ratios(c: Column) -> Column:
        words, lines, chars = (F.greatest(c[x], F.lit(1)) for x in ("n_words", "n_lines", "word_chars"))
        ratio = {"mean_word": c["word_chars"] / words, "symbols_per_word": c["n_symbols"] / words, "stop_words": c["stops"] / words, "alphabetic_words": c["alphabetic"] / words, "capitals": c["capitals"] / chars, "marks_per_word": c["marks"] / words, "duplicate_lines": c["n_dup_lines"] / lines, "ended_lines": c["ended"] / lines}
        failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
        verdict = ~failed
        for rule in RULES:
            if rule.least is not None:
                verdict &= ratio[rule.feature] >= rule.least
            if rule.most is not None:
                verdict &= ratio[rule.feature] <= rule.most
        return F.struct(*(c[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), failed.alias("base_failed"), verdict.alias("kept"), *(v.alias(k) for k, v in ratio.items()))

    return let(F.coalesce(text, F.lit("")), lambda t: let(counts(t), ratios))


def judge(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with a struct column ``quality`` of counts, base_failed, kept and ratios, which replaces a column of that name; the rest stays."""
    return docs.withColumn("quality", measure(F.col(text_col)))


def accepted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that all rules keep, columns as given. Null and empty texts go."""
    return docs.where(measure(F.col(text_col))["kept"])


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = table(spark, sf_dir, "documents").select("doc_id", measure(F.col("text")).alias("quality"))
    return judged.select("doc_id", *(F.col(f"quality.{x}").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def _rules_sql() -> str:
    feature = {"mean_word": "word_chars / greatest(n_words, 1)", "symbols_per_word": "n_symbols / greatest(n_words, 1)", "stop_words": "stops / greatest(n_words, 1)", "alphabetic_words": "alphabetic / greatest(n_words, 1)", "capitals": "capitals / greatest(word_chars, 1)", "marks_per_word": "marks / greatest(n_words, 1)", "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)", "ended_lines": "ended / greatest(n_lines, 1)"}
    terms = [f"{feature[r.feature]} {sign} {bound}" for r in RULES for sign, bound in ((">=", r.least), ("<=", r.most)) if bound is not None]
    return " AND ".join(terms)


OP2_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (
  SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
g AS (
  SELECT rid, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL THEN w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o END AS win
  FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
k AS (
  SELECT rid, i, win IS NOT NULL AND count(*) OVER (PARTITION BY rid, win) > 1 AS twice FROM g),
v AS (
  SELECT rid, bool_or(twice) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM k),
r AS (
  SELECT rid, count(*) FILTER (inside) AS n_repeat_words FROM v GROUP BY rid),
c AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(ws, lambda x: list_contains({list(STOP_WORDS)}, rtrim(lower(x), '.,;:!?')))) AS stops,
    len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS alphabetic,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals, length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS marks,
    len(list_filter(ls, lambda x: regexp_matches(x, '[.!?:;\p{{Pe}}\p{{Pf}}"''][\x20\x09-\x0D]*$'))) AS ended
  FROM w LEFT JOIN r USING (rid)),
b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND {_rules_sql()} AS kept
FROM b
"""

"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a whole number taken from the whole text by built-in functions; every rule compares two
measures by cross-multiplication, so verdicts do not depend on floating point. No shuffle, no user function.

Defined results: a null or empty text has no words and fails; equal rows get equal verdicts; an empty table
gives an empty result; further columns are ignored by :func:`judge` and kept by :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.text import GAP_CHARS, given, only, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Common words of the corpus languages, lower case.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "on", "are", "this", "by", "be", "from",
    "de", "la", "le", "et", "les", "des", "une", "un", "du", "que", "dans", "pour", "qui", "pas", "sur", "au",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "für", "auf", "im",
    "el", "los", "las", "una", "en", "por", "con", "para", "del", "se", "y", "es", "no", "su",
)


@dataclass(frozen=True)
class Rule:
    """``100 * part`` must lie between ``at_least * whole`` and ``at_most * whole``, for texts of ``from_words`` words or more."""

    name: str
    part: str
    whole: str
    at_least: int | None = None
    at_most: int | None = None
    from_words: int = 0

    def broken(self) -> str:
        """SQL condition under which a text breaks the rule."""
        tests = []
        if self.at_least is not None:
            tests.append(f"100 * {self.part} < {self.at_least} * {self.whole}")
        if self.at_most is not None:
            tests.append(f"100 * {self.part} > {self.at_most} * {self.whole}")
        return f"(n_words >= {self.from_words} AND ({' OR '.join(tests)}))"


#: Failing one of these fails the text whatever else holds.
BASE_RULES = (
    Rule("too_short", "n_words", "1", at_least=1000),
    Rule("repeated_windows", "n_repeat_words", "n_words", at_most=20),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", at_least=200, at_most=1500),
    Rule("symbols", "n_symbols", "n_words", at_most=10),
    Rule("stop_words", "n_stop", "n_words", at_least=2, from_words=50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", at_most=50),
)


def _repeat_windows(w: Column) -> Column:
    """One hash per window of consecutive words; none in texts shorter than a window."""
    starts = F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures the rules speak of.

    Repeated windows are found by sorting a text's window hashes (64 bits) beside their places; only texts
    whose windows are not all distinct are sorted.
    """
    c, zero = F.col, F.lit(0).cast("long")
    out = docs.withColumns({"_text": given(c(text)), "_words": words(c(text))})
    out = out.withColumn("_windows", _repeat_windows(c("_words")))
    out = out.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("hash"), i.alias("at")))),
    ))
    same = lambda i, k: F.get(c("_sorted"), i)["hash"] == F.get(c("_sorted"), i + k)["hash"]
    out = out.withColumn("_places", F.sort_array(F.transform(
        F.filter("_sorted", lambda x, i: F.coalesce(same(i, 1), F.lit(False)) | F.coalesce(same(i, -1), F.lit(False))),
        lambda x: x["at"],
    )))
    covered = F.aggregate(
        F.transform("_places", lambda x, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(c("_places"), i + 1) - x, F.lit(WINDOW)))),
        zero, lambda total, x: total + x,
    )
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(GAP_CHARS)) != ""))
    return out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_stop": F.size(F.filter("_words", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # Always 0 is added: a filter is not moved below a column that depends on the row's place. Below the steps above it would
        # compute them anew in every lambda.
        "n_repeat_words": F.coalesce(covered, zero) + F.pmod(F.monotonically_increasing_id(), F.lit(1)),
    }).drop("_text", "_words", "_windows", "_sorted", "_places", "_lines")


def broken(rules: tuple[Rule, ...]) -> Column:
    """Names of the rules a text breaks, in the order of the table."""
    return F.filter(
        F.array(*[F.when(F.expr(r.broken()), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    ) if rules else F.array().cast("array<string>")


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: its measures, the rules it breaks and whether it is kept."""
    rows = only(docs, doc_id, text)
    out = measures(rows, text).drop(text).withColumns({"base_broken": broken(base), "broken": broken(rules)})
    out = out.withColumn("base_failed", F.size("base_broken") > 0)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that break no rule, unchanged."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_judged"))
    out = measures(rows, "_judged")
    return out.where((F.size(broken(base)) == 0) & (F.size(broken(rules)) == 0)).select("_row.*")

"""Quality rules as one Spark projection.

Counts of words, symbols, lines and repeated phrases are columns made of built-in functions; a
table of thresholds on their ratios is compiled into one expression.  No user functions and no
shuffle; each document is judged alone, whole.

The stop words are those of four languages (English, German, French, Spanish): long texts in others
hold too few and fail.  For other languages pass ``rules`` without that one, or with more words.

Null text and text without words have all counts 0 and fail.  Null or repeated ids are judged row
by row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not are at from this or have an they which",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er",
    "de la le et les des en un une du est que dans qui par pour au sur pas avec ne se ce il",
    "de la que el en y los se del las un por con no una su para es al lo como más o",
)


@dataclass(frozen=True)
class Rule:
    """``least <= top / bottom <= most``; a document without the bottom passes."""

    name: str
    top: str
    bottom: str
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        top, bottom = F.col(self.top), F.col(self.bottom)
        parts = [top >= F.lit(self.least) * bottom] if self.least is not None else []
        parts += [top <= F.lit(self.most) * bottom] if self.most is not None else []
        return (bottom == 0) | reduce(Column.__and__, parts, F.lit(True))


#: The threshold table.
RULES = (
    Rule("word length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop words", "n_stop_words", "n_words", least=0.02),
    Rule("upper case", "n_upper", "word_chars", most=0.4),
    Rule("exclamations", "n_exclaims", "n_words", most=0.5),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=0.5),
)


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the counts that the rules compare."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    stops = sorted({w for line in STOP_WORDS for w in line.split()})
    return docs.select(F.col(id_column).alias("doc_id"), text.alias("_text"), words.alias("_words"), lines.alias("_lines")).select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words("_words").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(stops))).cast("long").alias("n_stop_words"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        (F.length("_text") - F.length(F.translate("_text", "!", ""))).cast("long").alias("n_exclaims"),
    )


def _repeated_words(words: str) -> Column:
    """Words in three-word windows found twice or more, first included.

    Windows are sorted with their places, so equal ones are neighbours; no window is compared
    with all others.
    """
    at = F.sequence(F.lit(1), F.size(words) - 2)
    windows = F.transform(at, lambda i: F.struct(F.array_join(F.slice(words, i, 3), " ").alias("w"), i.alias("i")))
    ordered = F.sort_array(windows)

    def covered(sorted_: Column) -> Column:
        pairs = F.zip_with(F.slice(sorted_, 1, F.size(sorted_) - 1), F.slice(sorted_, 2, F.size(sorted_)), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
        starts = F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    found = F.get(F.transform(F.array(ordered), covered), 0)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(found).cast("long")


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed (too short or too repetitive) and kept (all rules hold)."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdict = reduce(Column.__and__, (r.holds() for r in rules), F.lit(True))
    counted = measured(docs, id_column, text_column).withColumn("base_failed", base)
    return counted.withColumn("kept", ~F.col("base_failed") & verdict)

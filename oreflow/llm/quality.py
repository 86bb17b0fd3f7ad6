"""Quality of texts by how far their distributions lie from those of their language.

A text has two histograms: of character classes, and of the common words of its language with all other words as
one more cell. The reference of a language is the mean of the histograms of all its texts, each text counting
alike. The distance is the square root of the Jensen-Shannon divergence with logarithms to base 2, from 0 to 1.
Short texts scatter more: below a minimum length a distance says nothing, and the bound on the word distance
falls with the square root of the length. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import stored

SPACE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"

# The most common short function words of each language.
COMMON = {
    "en": "the of and to a in is that it for was on with as be by this are at from or have an not which but",
    "fr": "de la le et les des en un du une que pour est par qui dans avec sur pas au ou il elle ne se",
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als auch es an",
    "es": "de la que el en y los se del las un con por no su una para es al lo como más o pero sus",
}


@dataclass(frozen=True)
class Rules:
    """Bounds: at least so many words for a test, and the distances beyond which a text fails."""

    char_words: int = 30
    char_distance: float = 0.32
    both_words: int = 60
    both_char_distance: float = 0.14
    both_word_distance: float = 0.2
    both_word_scatter: float = 0.9


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def measures(docs: DataFrame, id: str, text: str, lang: str) -> DataFrame:
    """Base figures and histograms of every row; ``chars`` and ``common`` hold shares."""
    own = docs.select(F.col(id), F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lists = F.create_map(*(x for k, v in COMMON.items() for x in (F.lit(k), F.split(F.lit(v), " "))))
    own = own.select(
        id,
        "lang",
        F.length("text").alias("n_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.array_remove(F.split(F.lower("text"), r"[\x20\x09-\x0D.,;:!?]+"), "").alias("bare"),
        F.coalesce(F.try_element_at(lists, "lang"), F.array().cast("array<string>")).alias("listed"),
        _without(F.col("text"), "[a-z]+").alias("r1"),
    )
    gram = lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(5)))
    starts = F.expr("if(size(hashes) < 5, cast(array() as array<int>), sequence(0, size(hashes) - 5))")
    own = own.select(
        id, "lang", "n_chars", "n_symbols", "listed", "r1",
        F.size("hashes").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(starts, gram).alias("grams"),
        F.size("bare").alias("n_bare"),
        F.filter("bare", lambda w: F.array_contains("listed", w)).alias("found"),
        _without(F.col("r1"), r"[\x20\x09-\x0D]+").alias("r2"),
    )
    placed = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    own = own.select(
        "*",
        _without(F.col("r2"), "[A-Z]+").alias("r3"),
        # windows in the order of their hashes, only where one is found again at all
        F.when(F.size(F.array_distinct("grams")) < F.size("grams"), placed).alias("placed"),
    )
    own = own.select("*", _without(F.col("r3"), "[0-9]+").alias("r4"), F.col("placed.g").alias("g"))
    again = lambda x, k: F.coalesce(x["g"] == F.get("g", k - 1), F.lit(False)) | F.coalesce(
        x["g"] == F.get("g", k + 1), F.lit(False)
    )
    own = own.select(
        "*",
        _without(F.col("r4"), r"""[.,;:!?'"()-]+""").alias("r5"),
        F.sort_array(F.filter("placed", again)["i"]).alias("places"),
    )
    own = own.select("*", _without(F.col("r5"), r"[\x21-\x7e]+").alias("r6"))
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("places", k + 1) - p, F.lit(5)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    left = [F.length(f"r{k}") for k in range(1, 7)]
    classes = [F.col("n_chars") - left[0], *(a - b for a, b in zip(left, left[1:])), left[5]]
    common = F.transform("listed", lambda c: F.size(F.filter("found", lambda w: w == c)))
    n_chars, n_bare = F.greatest("n_chars", F.lit(1)), F.greatest("n_bare", F.lit(1))
    return own.select(
        id,
        "lang",
        "n_words",
        # what is neither a white character nor removed with them
        (F.col("n_chars") - (left[0] - left[1])).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.array(*(c / n_chars for c in classes)).alias("chars"),
        F.transform(F.concat(common, F.array(F.col("n_bare") - F.size("found"))), lambda x: x / n_bare).alias("common"),
    )


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)) / 2)


def references(measured: DataFrame) -> DataFrame:
    """(lang, char_reference, common_reference): mean shares over all texts of a language that have words."""
    own = measured.where("n_words > 0")

    def means(column: str, name: str) -> DataFrame:
        cells = own.select("lang", F.posexplode(column).alias("k", "x")).groupBy("lang", "k").agg(F.avg("x").alias("x"))
        array = F.array_sort(F.collect_list(F.struct("k", "x")))["x"]  # a few dozen cells
        return cells.groupBy("lang").agg(array.alias(name))

    chars, common = means("chars", "char_reference"), means("common", "common_reference")
    both = chars.alias("a").join(common.alias("b"), F.expr("a.lang <=> b.lang"))
    return both.select("a.lang", "char_reference", "common_reference")


def quality_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", rules: Rules = Rules()
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_distance, word_distance, base_failed, kept).

    A text fails the base rules with fewer than ten words or if over a fifth of its words are in five-word windows
    found again in it. Else it fails if it is long enough and its characters lie far from those of its language, or
    its characters and its common words both lie rather far.

    Defined cases. A null text is empty and fails. A null language is a language of its own; for languages without
    a list of common words, and texts without words, the word distance is that of a single cell, 0. Rows are judged
    one by one, so repeated rows get equal results; their histograms count as often as they come. An empty table
    gives an empty result. Columns other than the three named are not read.
    """
    measured = stored(measures(docs, id, text, lang), "measures")
    # the references are one row per language; sizes known to Spark decide how they are joined
    joined = measured.alias("m").join(stored(references(measured), "references").alias("r"), F.expr("m.lang <=> r.lang"), "left")
    n = F.col("n_words")
    far = joined.select(
        f"m.`{id}`", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce(distance("chars", "char_reference"), F.lit(0.0)).alias("char_distance"),
        F.coalesce(distance("common", "common_reference"), F.lit(0.0)).alias("word_distance"),
        ((n < 10) | (100 * F.col("n_repeat_words") > 20 * n)).alias("base_failed"),
    )
    strange = (n >= rules.char_words) & (F.col("char_distance") > rules.char_distance)
    odd = (
        (n >= rules.both_words)
        & (F.col("char_distance") > rules.both_char_distance)
        & (F.col("word_distance") > rules.both_word_distance + rules.both_word_scatter / F.sqrt(n))
    )
    return far.withColumn("kept", ~(F.col("base_failed") | strange | odd))

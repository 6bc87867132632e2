"""Quality rules: each document's distributions against the reference of its language.

Two histograms are taken of a text: its marks by class, and its words by a list of common words. Both are compared by the
Jensen-Shannon divergence with the median histogram of all documents of the same language. A text below the minimum length is
not compared. Repetition and length rules stand beside it.

Defined results: a null text is empty; a null language is a language of its own; an empty text fails the length rule;
repeated rows are judged alike, each on its own; other columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import BLANKS, lookup_join, stored

# Frequent short words of the four languages, compared in lower case without outer punctuation.
COMMON_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "with",
    "de", "la", "le", "et", "les", "des", "un", "une", "que", "qui",
    "der", "die", "und", "den", "von", "das", "mit", "sich", "ist", "nicht",
    "el", "en", "los", "se", "las", "por", "del", "no", "para", "con",
]

# Code points by class. The number of words stands beside them as the measure of length.
CLASSES = {
    "upper": r"\p{Lu}",
    "digit": r"\p{Nd}",
    "symbol": r"[#*$%&|<>=+~^\\_@{}\[\]/]",
    "point": r"[.,;:!?'\"()-]",
    "letter": r"[\p{L}&&[^\p{Lu}]]",
}

# Punctuation at the outer ends of words; a run of it is looked at from its start only.
OUTER = r"(?<![^\x20\x09-\x0D])\p{P}++|(?<!\p{P})\p{P}++(?![^\x20\x09-\x0D])"


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; the divergences are in bits, between 0 and 1.

    A short text's histogram strays by chance: the limits are raised by ``noise_words`` and ``word_noise_words`` / number
    of words. The word limit lies between good texts (99 in 100 of 200 words stray less than 0.04) and texts without any
    common word (0.11 to 0.12).
    """

    min_words: int = 50
    max_repeat_pct: int = 50
    max_class_divergence: float = 0.1
    max_word_divergence: float = 0.02
    noise_words: float = 6.0
    word_noise_words: float = 4.0


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the rules and the two histograms ``_classes`` and ``_common``; one pass, no shuffle.

    Marks are what is left of a text without the letters a-z and white space; classes are counted in them, beside the
    number of words. Common words are counted in lower case and without outer punctuation.
    """
    rows = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumns(
        {
            "_words": F.array_remove(F.split("_text", BLANKS), ""),
            "_marks": F.regexp_replace("_text", r"[a-z\x20\x09-\x0D]+", ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    plain = F.split(F.regexp_replace(F.lower("_text"), OUTER, ""), BLANKS)
    rows = rows.withColumn("_hits", F.filter(plain, lambda w: w.isin(COMMON_WORDS)))
    count = lambda pattern: F.regexp_count("_marks", F.lit(pattern)).cast("long")
    per_word = [F.size("_hits") - F.size(F.array_remove("_hits", w)) for w in COMMON_WORDS]
    rows = _repeats(rows).withColumns(
        {
            "n_chars_read": F.length("_text").cast("long"),
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": count(r"[#*$%&|<>]"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_classes": F.array(
                *[count(p) for p in CLASSES.values()], F.size("_words").cast("long")
            ),
            "_common": F.transform(
                F.array(*per_word, F.size("_words") - F.size("_hits")), lambda n: n.cast("long")
            ),
        }
    )
    return rows.drop("_text", "_words", "_marks", "_lines", "_hits")


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def _with_shares(rows: DataFrame) -> DataFrame:
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumns({f"{c}_total": add(c) for c in ("_classes", "_common")})
    return rows.withColumns(
        {
            c: _shares(F.col(c), F.greatest(F.col(f"{c}_total"), F.lit(1e-9)))
            for c in ("_classes", "_common")
        }
    ).drop("_classes_total", "_common_total")


def language_references(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per language: the median share of each class and common word over its texts of the minimum length.

    Medians, scaled to a sum of 1, describe the usual text even where much of a language is junk.
    """
    rows = _with_shares(measured.filter(F.col("n_words") >= rules.min_words))
    widths = {"_classes": len(CLASSES) + 1, "_common": len(COMMON_WORDS) + 1}
    middle = rows.groupBy(F.col("lang").alias("_ref_lang")).agg(
        *[
            F.percentile_approx(F.col(c)[i], 0.5, 10_000).alias(f"{c}{i}")
            for c, n in widths.items()
            for i in range(n)
        ]
    )
    middle = middle.select(
        "_ref_lang", *[F.array(*[f"{c}{i}" for i in range(n)]).alias(c) for c, n in widths.items()]
    )
    return _with_shares(middle).withColumnsRenamed({c: f"_ref{c}" for c in widths})


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence of two arrays of shares, in bits."""

    def half(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(F.lit(2.0) * x / (x + y))).otherwise(0.0)

    return F.aggregate(
        F.zip_with(p, q, lambda x, y: half(x, y) + half(y, x)),
        F.lit(0.0),
        lambda a, x: a + x,
    ) / 2


def _repeats(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words covered by 3-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash. Only texts whose hashes repeat are sorted.
    """
    n = F.size("_words") - 2
    rows = rows.withColumn("_ids", F.transform("_words", lambda w: F.xxhash64(w)))
    pair = lambda x, y: F.xxhash64(x, y)
    rows = rows.withColumn(
        "_hashes",
        F.when(
            n > 0,
            F.zip_with(
                F.zip_with(F.slice("_ids", 1, n), F.slice("_ids", 2, n), pair),
                F.slice("_ids", 3, n),
                pair,
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
            F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    at = lambda i: F.get(F.col("_sorted"), i)["h"]
    rows = rows.withColumn(
        "_starts",
        F.sort_array(
            F.transform(
                F.filter(
                    "_sorted",
                    lambda x, i: F.coalesce(x["h"] == at(i - 1), F.lit(False))
                    | F.coalesce(x["h"] == at(i + 1), F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            (s + 3).alias("end"), (a["n"] + F.least(F.lit(3), s + 3 - a["end"])).alias("n")
        ),
        lambda a: a["n"],
    )
    return rows.withColumn("n_repeat_words", covered).drop("_ids", "_hashes", "_sorted", "_starts")


def judge(
    measured: DataFrame, references: DataFrame | None = None, rules: Rules = Rules()
) -> DataFrame:
    """``measured`` rows with divergences, ``base_failed`` and ``kept``. Without references those of the rows are taken."""
    if references is None:
        references = stored(language_references(measured, rules), "quality-references")
    same = F.col("lang").eqNullSafe(F.col("_ref_lang"))
    rows = _with_shares(lookup_join(measured, references, same))
    compared = (F.col("n_words") >= rules.min_words) & F.col("_ref_classes").isNotNull()
    rows = rows.withColumns(
        {
            "class_divergence": F.when(
                compared, divergence(F.col("_classes"), F.col("_ref_classes"))
            ),
            "word_divergence": F.when(compared, divergence(F.col("_common"), F.col("_ref_common"))),
            "base_failed": (F.col("n_words") < rules.min_words)
            | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words")),
        }
    )
    per_word = F.lit(1.0) / F.greatest(F.col("n_words"), F.lit(1).cast("long"))
    odd = F.coalesce(
        (F.col("class_divergence") > rules.max_class_divergence + rules.noise_words * per_word)
        | (F.col("word_divergence") > rules.max_word_divergence + rules.word_noise_words * per_word),
        F.lit(False),
    )
    return rows.withColumn("kept", ~F.col("base_failed") & ~odd).drop(
        "_classes", "_common", "_ref_lang", "_ref_classes", "_ref_common"
    )

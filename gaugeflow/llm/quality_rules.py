"""Rule-based quality verdicts: a table of thresholds compiled into one projection.

Everything is built-in expressions over one row, so the operator is a scan: no
shuffle, no user function, and a very long text costs only its own row.
"""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
NO_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au auf aus das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "avec ce dans de du elle en est et la le les par pas pour que qui sur un une "
    "al con del el los las no para por se su y"
).split()

# name, counted part, whole, least and most parts in a thousand of the whole.
RULES = (
    ("word_length", "word_chars", "n_words", 2_500, 12_000),
    ("symbols", "n_symbols", "n_words", None, 100),
    ("stop_words", "n_stop_words", "n_words", 50, None),
    ("alphabetic_words", "n_alphabetic", "n_words", 700, None),
    ("short_lines", "n_short_lines", "n_lines", None, 900),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 500),
    ("stuttering", "n_same_as_before", "n_words", None, 300),
)
SHORT_LINE_WORDS = 3


def bind(value, body):
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words, n=WINDOW):
    """Words inside n-word windows that occur twice or more in the array, first ones included.

    Windows are compared by a 64-bit hash, within one text only.
    """

    def positions(pairs):
        """Starts of windows with an equal neighbour in hash order, ascending."""
        same = F.transform(
            pairs,
            lambda x, k: F.when(
                F.coalesce(F.get(pairs, k - 1).g == x.g, F.lit(False))
                | F.coalesce(F.get(pairs, k + 1).g == x.g, F.lit(False)),
                x.i,
            ),
        )
        return F.sort_array(F.array_compact(same))

    def covered(starts):
        """Each start covers n words, or as many as there are up to the next start."""
        reach = F.transform(starts, lambda p, k: F.least(F.lit(n), F.get(starts, k + 1) - p))
        return F.aggregate(reach, F.lit(0), lambda total, r: total + r)

    def search(grams):
        pairs = F.sort_array(
            F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        )
        found = bind(pairs, lambda p: bind(positions(p), covered))
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), found).otherwise(0)

    grams = F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n))
    )
    return F.when(F.size(words) > n, bind(grams, search)).otherwise(0)


def compiled(rules):
    """One condition: every rule holds. A whole of nothing breaks no rule."""

    def holds(part, whole, least, most):
        share = F.col(part) * 1000
        low = F.lit(True) if least is None else share >= F.col(whole) * least
        high = F.lit(True) if most is None else share <= F.col(whole) * most
        return low & high

    return reduce(and_, [holds(*rule[1:]) for rule in rules], F.lit(True))


def quality_rules(docs: DataFrame, id_col="doc_id", text_col="text", rules=RULES) -> DataFrame:
    """id, the measures of the text, base_failed and kept.

    A text fails the base with fewer than 20 words or with more than 30 % of its words in
    repeated 8-word windows; it is kept if it passes and every rule of the table holds.
    Null and empty texts have 0 of everything and fail. Null ids stay null, repeated
    rows give repeated results, other columns are ignored.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    words, lines = F.col("_words"), F.col("_lines")
    stop = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]

    def number(column):
        return column.cast("long")

    def measured(*columns):
        # Through a one-element generator, so that a filter on the verdict is not pushed
        # below it, where it would repeat every measure.
        return F.explode(F.array(F.struct(*columns)))

    return (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
        .withColumns(
            {
                "_words": F.array_remove(F.split(text, BLANK), ""),
                "_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_BLANK)),
            }
        )
        .select(
            "_id",
            measured(
                number(F.size(words)).alias("n_words"),
                number(F.length(F.array_join(words, ""))).alias("word_chars"),
                number(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
                number(F.size(lines)).alias("n_lines"),
                number(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
                number(
                    F.size(
                        F.filter(
                            lines,
                            lambda x: F.size(F.array_remove(F.split(x, BLANK), "")) < SHORT_LINE_WORDS,
                        )
                    )
                ).alias("n_short_lines"),
                number(repeated_words(words)).alias("n_repeat_words"),
                number(F.size(F.filter(words, lambda w: w.isin(stop)))).alias("n_stop_words"),
                number(F.size(F.filter(words, lambda w: w.rlike(r"\p{L}")))).alias("n_alphabetic"),
                number(
                    F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1))))
                ).alias("n_same_as_before"),
            ).alias("_m"),
        )
        .select("_id", "_m.*")
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED),
        )
        .select(
            F.col("_id").alias(id_col),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & compiled(rules)).alias("kept"),
            "n_lines",
            "n_short_lines",
            "n_stop_words",
            "n_alphabetic",
            "n_same_as_before",
        )
    )

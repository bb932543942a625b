"""Quality rules with thresholds learnt per language and source.

Each text is measured with built-in expressions. Mergeable quantile sketches
(``approx_percentile``) of each measure give an upper fence per language and source,
which replaces a fixed cutoff; a text beyond any fence is rejected.

Defined results: a null or empty text has no words and fails the base rule. Null
language and null source are groups of their own. Repeated rows are judged one by
one and count as often as they occur. An empty table gives an empty result. Other
columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base rule.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: The measures, and the least width of the band between quartile and fence. The width
#: keeps a group in which nearly all texts are alike from rejecting ordinary ones.
MEASURES = {
    "symbol_share": 0.03,
    "upper_share": 0.30,
    "repeat_share": 0.45,
    "duplicate_line_share": 0.50,
    "word_length": 3.0,
}
#: A fence lies so many distances between the quartiles above the upper one.
FENCE = 6.0
#: A group of so many texts counts as much for its fence as its language, and a language as
#: much as all texts; larger ones count for more, smaller ones for less.
EVEN_GROUP = 10
ACCURACY = 10_000

_WORDS = "array_remove(split(_text, '[\\\\x20\\\\x09-\\\\x0D]+'), '')"

#: Words in 3-word windows that occur twice or more: sort the windows of a text with
#: their places, keep those equal to a neighbour, and count the words that they cover.
_WINDOWS = """slice(transform(_words, (x, i) ->
    xxhash64(x, get(_words, i + 1), get(_words, i + 2))), 1, greatest(size(_words) - 2, 0))"""
_SORTED = "sort_array(transform(_windows, (h, i) -> struct(h, i)))"
_REPEATED = """sort_array(transform(filter(_sorted, (e, i) ->
    coalesce(e.h = get(_sorted, i - 1).h, false) or
    coalesce(e.h = get(_sorted, i + 1).h, false)), e -> e.i))"""
_COVERED = """aggregate(transform(_repeated, (p, i) ->
    least(3, coalesce(get(_repeated, i + 1) - p, 3))), 0L, (a, x) -> a + x)"""


def measure(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
            groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Counts of every text: no shuffle, no Python."""
    rows = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(groups[0]).alias("_lang"),
        F.col(groups[1]).alias("_source"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    rows = rows.withColumn("_words", F.expr(_WORDS)).withColumn(
        "_lines", F.expr("filter(split(_text, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    rows = rows.withColumn("_windows", F.expr(_WINDOWS))
    unrepeated = F.size(F.array_distinct("_windows")) == F.size("_windows")
    rows = rows.withColumn("_sorted", F.when(~unrepeated, F.expr(_SORTED)))
    rows = rows.withColumn("_repeated", F.when(F.col("_sorted").isNotNull(), F.expr(_REPEATED)))
    counts = F.struct(
        "doc_id", F.xxhash64("_text").alias("_key"), "_lang", "_source",
        F.size("_words").cast("long").alias("n_words"),
        F.expr("aggregate(_words, 0L, (a, x) -> a + length(x))").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]", "")))
        .cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.expr(_COVERED), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
        F.expr("size(filter(_words, x -> length(x) > 1 and x = upper(x) and x <> lower(x)))")
        .cast("long").alias("_n_upper"),
    )
    # A generator's output is never replaced by its expression. Else a filter on the counts
    # would be pushed below these projections, and every element would compute the arrays anew.
    return rows.select(F.inline(F.array(counts)))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def _with_measures(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "symbol_share": _share("n_symbols", "word_chars"),
        "upper_share": _share("_n_upper", "n_words"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "duplicate_line_share": _share("n_dup_lines", "_n_lines"),
        "word_length": _share("word_chars", "n_words"),
    })


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def fences(measured: DataFrame) -> DataFrame:
    """One row of fences per language and source, from sketches merged across tasks."""
    quartiles = [
        F.percentile_approx(name, [0.25, 0.75], ACCURACY).alias(name) for name in MEASURES
    ]
    levels = measured.rollup("_lang", "_source").agg(
        F.grouping_id().alias("_level"), F.count(F.lit(1)).alias("_rows"), *quartiles)
    columns = [
        (F.col(name)[1] + FENCE * F.greatest(F.col(name)[1] - F.col(name)[0],
                                             F.lit(width / FENCE))).alias(name)
        for name, width in MEASURES.items()
    ]
    levels = levels.select("_lang", "_source", "_level", "_rows", F.struct(*columns).alias("_fence"))
    own = levels.filter("_level = 0")
    language = levels.filter("_level = 1").select(
        F.col("_lang").alias("_l"), F.col("_fence").alias("_of_language"),
        _weight("_rows").alias("_language_weight"))
    whole = levels.filter("_level = 3").select(F.col("_fence").alias("_of_all"),
                                               F.lit(0).alias("_one"))
    joined = own.withColumn("_one", F.lit(0)).join(
        language, F.col("_lang").eqNullSafe(F.col("_l")), "left").join(whole, "_one", "left")
    fence = F.struct(*(
        _between(_weight("_rows"), F.col(f"_fence.{name}"), _between(
            F.col("_language_weight"), F.col(f"_of_language.{name}"), F.col(f"_of_all.{name}"))
                 ).alias(name) for name in MEASURES))
    return joined.select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"),
                         fence.alias("_fence"))


def _weight(rows: str) -> Column:
    return F.col(rows) / (F.col(rows) + EVEN_GROUP)


def _between(weight: Column, own: Column, wider: Column) -> Column:
    return weight * own + (1 - weight) * wider


def judge(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
          groups: tuple[str, str] = ("lang", "source"), measured: DataFrame | None = None,
          ) -> DataFrame:
    """Counts and verdict of every text.

    ``measured`` may be a stored result of ``measure``, so that the texts are read once.
    """
    rows = _with_measures(measure(documents, doc_id, text, groups) if measured is None
                          else measured)
    limits = fences(rows)
    joined = rows.join(
        limits,
        F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
    within = F.lit(True)
    for name in MEASURES:
        within = within & (F.col(name) <= F.col(f"_fence.{name}"))
    return joined.select(
        "doc_id", "_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(within, F.lit(True))).alias("kept"),
        *MEASURES,
    )


def accepted(documents: DataFrame, judged: DataFrame, doc_id: str = "doc_id", text: str = "text",
             ) -> DataFrame:
    """The documents, all columns, that are kept; rows are told apart by id and text."""
    good = judged.filter("kept").select(F.col("doc_id").alias("_id"), "_key").distinct()
    return documents.join(
        good, F.col(doc_id).eqNullSafe(F.col("_id"))
        & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_key")), "left_semi")

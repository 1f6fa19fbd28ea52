"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression over the whole text; a rule is a metric with a lower and
an upper bound, and a document is kept if it meets all of them. No user functions.

Defined cases: a null text counts as empty and fails; ties and repeated rows are judged one by
one; an empty table gives no rows; input columns named like a metric are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import WORD, text_or_empty

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his are this at from or have an they which you were "
    "de la le et les des en un du une que est pour qui dans par sur pas plus au ce il avec elle "
    "der die und den von zu das mit sich dem ein ist im für nicht auf eine als auch es "
    "el los las y no se por con para su al lo como más o pero sus"
).split()
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: metric, lower bound, upper bound (None: open); ratios are of words, characters or lines as named.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 10, None),
    ("repeat_word_ratio", None, 0.2),
    ("mean_word_chars", 2, 15),
    ("symbol_word_ratio", None, 0.3),
    ("upper_ratio", None, 0.6),
    ("exclamation_word_ratio", None, 0.4),
    ("stop_word_ratio", 0.03, None),
    ("duplicate_line_ratio", None, 0.5),
]


def _repeat_words(grams: Column, by_gram: Column) -> Column:
    """Words covered by a window that occurs twice or more; by_gram: windows as (hash, position), sorted."""
    n = F.size(by_gram)
    repeated = F.filter(
        by_gram,
        lambda x, i: ((i > 0) & (F.get(by_gram, i - 1)["h"] == x["h"])) | ((i < n - 1) & (F.get(by_gram, i + 1)["h"] == x["h"])),
    )
    at = F.array_sort(F.transform(repeated, lambda x: x["p"]))
    return F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame) -> DataFrame:
    """docs with the metrics of the whole text: counts as long, ratios as double."""
    text = text_or_empty()
    step = docs.withColumns({"_text": text, "_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0))})
    grams = F.when(
        F.size("_words") >= WINDOW,
        F.transform(
            F.slice("_words", F.lit(1), F.size("_words") - (WINDOW - 1)),
            lambda w, i: F.xxhash64(w, *[F.get(F.col("_words"), i + k) for k in range(1, WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD))
    step = step.withColumns(
        {
            "_grams": grams,
            "_lines": lines,
            "_joined": F.array_join("_words", ""),
            "n_words": F.size("_words").cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long"),
            "_stop": F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))),
            "_shouts": F.regexp_count("_text", F.lit(r"![\x20\x09-\x0D]")),
        }
    )
    step = step.withColumn("_repeats", F.size(F.array_distinct("_grams")) < F.size("_grams"))
    step = step.withColumn(
        "_by_gram",
        F.when(F.col("_repeats"), F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))),
    )
    step = step.withColumns(
        {
            "word_chars": F.length("_joined").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("_repeats"), _repeat_words(F.col("_grams"), F.col("_by_gram"))).otherwise(F.lit(0)).cast("long"),
        }
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    n = F.col("n_words")
    return step.withColumns(
        {
            "mean_word_chars": ratio(F.col("word_chars"), n),
            "symbol_word_ratio": ratio(F.col("n_symbols"), n),
            "stop_word_ratio": ratio(F.col("_stop") + 1, n),  # plus one: a short text may hold none
            "exclamation_word_ratio": ratio(F.col("_shouts"), n),
            "repeat_word_ratio": ratio(F.col("n_repeat_words"), n),
            "duplicate_line_ratio": ratio(F.col("n_dup_lines"), F.col("n_lines")),
            "upper_ratio": ratio(F.regexp_count("_joined", F.lit(r"\p{Lu}")), F.col("word_chars")),
        }
    ).drop("_text", "_words", "_grams", "_lines", "_joined", "_stop", "_shouts", "_repeats", "_by_gram")


def verdict(thresholds=THRESHOLDS) -> Column:
    """The threshold table as one boolean expression over the metrics."""
    meets = F.lit(True)
    for metric, low, high in thresholds:
        if low is not None:
            meets = meets & (F.col(metric) >= F.lit(low))
        if high is not None:
            meets = meets & (F.col(metric) <= F.lit(high))
    return meets


def judge(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """docs with all metrics, base_failed (too short, or too many words in repeated windows) and kept."""
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return measure(docs).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(thresholds))


def keep_good(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The documents that meet every rule, columns as they came."""
    names = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(c).alias(n) for c, n in names.items()]).withColumn("text", F.col(names["text"]))
    # the row number keeps the filter above the projection: pushed below, it would repeat every metric's expression
    judged = judge(renamed, thresholds).withColumn("_at", F.monotonically_increasing_id())
    return judged.where("kept and _at >= 0").select(*[F.col(n).alias(c) for c, n in names.items()])

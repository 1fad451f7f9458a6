"""Quality rules with thresholds that follow the data.

Measures of each text (symbols per word, repeated lines, repeated word runs, word length) are
summed up in quantile sketches by language and source. A sketch is a table of counts by
log-linear bucket: buckets are as wide as 1/32 of the value, so a quantile is off by at most
that share, and sketches merge by adding counts, in any order, with the same result.

No limit is a fixed value. Each measure has ranks (``RANKS``): a limit lies ``FENCE`` times as far beyond the upper
rank's quantile as that lies beyond the inner one's, or as a bucket is wide, as a sketch can't tell less; word length has limits on
both sides. The distribution of a language and source is
shrunk towards that of the language, and that towards the whole table's, as by ``PRIOR_ROWS`` rows more: a
sparse group follows its language, a large one itself, and nothing jumps between. A text is rejected if
a measure lies beyond a limit of its group.

Only DataFrame operations. Three-word windows are compared by 64-bit hash within a text.

Defined results: a null, empty or word-less text has all counts 0 and fails the base rules; null
languages and sources are groups of their own; repeated rows are judged alike; a very long text is counted whole,
as a row of one task; an empty table gives an empty one. ``keep_good`` returns the columns of ``docs``, whatever their
names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import columns, fresh
from .scratch import stored

FENCE = 6
PRIOR_ROWS = 1000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Measures in thousandths: the upper and the inner rank in percent, and whether small values are judged too. Symbols
#: and word length are near alike in most texts, so what a seventh has not is far out; lines and runs that repeat are
#: rare in all texts, and only the last hundredth tells how often they are.
RANKS = {
    "symbols": (85, 50, False),
    "dup_lines": (99, 85, False),
    "repeats": (99, 85, False),
    "word_length": (85, 50, True),
}
#: Shares of rows are whole numbers of this, so that they come out alike in any order of adding.
WHOLE = 1_000_000
BUCKET_BITS = 6
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur more than once."""

    def window_hash(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def repeated(windows: Column) -> Column:
        return F.filter(
            windows,
            lambda x, k: F.coalesce(x["hash"] == F.get(windows, k - 1)["hash"], F.lit(False))
            | F.coalesce(x["hash"] == F.get(windows, k + 1)["hash"], F.lit(False)),
        )

    def covered(at: Column) -> Column:
        each = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda total, n: total + n)

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.sort_array(F.transform(starts, lambda i: F.struct(window_hash(i).alias("hash"), i.alias("at"))))
    at = let(windows, lambda w: F.sort_array(F.transform(repeated(w), lambda x: x["at"])))
    return F.when(F.size(words) >= 3, let(at, covered)).otherwise(F.lit(0).cast("long"))


def text_counts(text: Column) -> Column:
    """The ``COUNTS`` of a text and ``n_lines``, its lines with a word, as a struct."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    by_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")
        ),
    )
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")
    return F.struct(by_words.alias("words"), by_lines.alias("lines"), symbols.alias("n_symbols"))


def bucket_width(value: Column) -> Column:
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - BUCKET_BITS)
    return F.expr("1L") * F.pow(F.lit(2), shift).cast("long")


def bucket(value: Column) -> Column:
    """The largest value of the value's log-linear bucket."""
    return value - value % bucket_width(value) + bucket_width(value) - 1


def sketches(stats: DataFrame, groups: list[str]) -> DataFrame:
    """Counts by group, measure and bucket."""
    measures = F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in RANKS))
    long = stats.select(*groups, F.inline(measures))
    return long.groupBy(*groups, "measure", "bucket").agg(F.count("*").alias("rows"))


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    return sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("rows").alias("rows"))


def counts_of(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """The sketch of each group and measure as an array in order of buckets; some hundred at most."""
    return sketch.groupBy(*groups, "measure").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "rows"))).alias("counts"), F.sum("rows").alias("n")
    )


def share_of(part: Column, whole: Column) -> Column:
    return F.call_function("div", part, whole)


def up_to(counts: Column, bucket_: Column) -> Column:
    below = F.filter(counts, lambda c: c["bucket"] <= bucket_)
    return F.aggregate(below, F.lit(0).cast("long"), lambda total, c: total + c["rows"])


def curve(counts: Column, n: Column) -> Column:
    """The share of rows up to each bucket."""
    return F.transform(
        counts, lambda c: F.struct(c["bucket"].alias("bucket"), share_of(up_to(counts, c["bucket"]) * WHOLE, n).alias("share"))
    )


def shrunk(counts: Column, n: Column, towards: Column, prior_rows: int) -> Column:
    """As ``curve``, with ``prior_rows`` rows of another curve added."""
    return F.transform(
        towards,
        lambda t: F.struct(
            t["bucket"].alias("bucket"),
            share_of(up_to(counts, t["bucket"]) * WHOLE + t["share"] * prior_rows, n + prior_rows).alias("share"),
        ),
    )


def quantile(curve_: Column, percent: int) -> Column:
    return F.element_at(F.filter(curve_, lambda c: c["share"] >= percent * WHOLE // 100), 1)["bucket"]


def limits_of(curve_: Column, measure: str) -> tuple[Column, Column]:
    upper, inner, both = RANKS[measure]

    def beyond(outer: int, middle: int) -> tuple[Column, Column]:
        at = quantile(curve_, outer)
        return at, FENCE * F.greatest(F.abs(at - quantile(curve_, middle)), bucket_width(at))

    at, spread = beyond(upper, inner)
    if not both:
        return F.lit(0).cast("long"), at + spread
    low, low_spread = beyond(100 - upper, 100 - inner)
    return low - low_spread, at + spread


def thresholds(stats: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """One row per ``lang`` and ``source``: the limits of each measure, in values of buckets."""
    own = stored(sketches(stats, ["lang", "source"]), "sketches")
    by_lang = merged(own, ["lang"])
    every = counts_of(merged(by_lang, []), []).select("measure", curve(F.col("counts"), F.col("n")).alias("every"))
    lang = counts_of(by_lang, ["lang"]).join(every, "measure").select(
        F.col("lang").alias("_lang"),
        F.col("measure").alias("_measure"),
        shrunk(F.col("counts"), F.col("n"), F.col("every"), prior_rows).alias("towards"),
    )
    lang = stored(lang, "curves")
    groups = counts_of(own, ["lang", "source"])
    met = groups.join(lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_measure")))
    met = met.withColumn("curve", shrunk(F.col("counts"), F.col("n"), F.col("towards"), prior_rows))
    columns = []
    for measure in RANKS:
        here = F.col("measure") == measure
        least, most = limits_of(F.col("curve"), measure)
        columns += [F.min(F.when(here, least)).alias(f"{measure}_least"), F.max(F.when(here, most)).alias(f"{measure}_most")]
    return met.groupBy("lang", "source").agg(*columns)


def quality_verdicts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    prior_rows: int = PRIOR_ROWS,
) -> DataFrame:
    """One row per document: its id, ``text_hash``, ``lang``, ``source``, the ``COUNTS``, ``base_failed`` and ``kept``."""
    counted = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
        F.col(lang_column).alias("lang"),
        F.col(source_column).alias("source"),
        text_counts(F.col(text_column)).alias("c"),
    ).select("id", "text_hash", "lang", "source", "c.words.*", "c.lines.*", "c.n_symbols")
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))

    def thousandths(count: str, of: Column) -> Column:
        return F.floor(F.col(count) * 1000 / of).cast("long")

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stats = stored(
        counted.withColumns(
            {
                "base_failed": failed,
                "symbols": thousandths("n_symbols", words),
                "dup_lines": thousandths("n_dup_lines", lines),
                "repeats": thousandths("n_repeat_words", words),
                "word_length": thousandths("word_chars", words),
            }
        ),
        "counts",
    )
    limits = thresholds(stats.where("not base_failed"), prior_rows)
    limits = stored(limits.withColumnsRenamed({"lang": "_lang", "source": "_source"}), "thresholds")
    inside = F.lit(True)
    for measure in RANKS:
        inside &= bucket(F.col(measure)).between(F.col(f"{measure}_least"), F.col(f"{measure}_most"))
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    judged = stats.join(limits, on, "left")
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return judged.select(F.col("id").alias(id_column), "text_hash", "lang", "source", *COUNTS, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` without rejected texts."""
    verdicts = quality_verdicts(docs, id_column, text_column, **options)
    mark = fresh(docs, "_key")
    key = F.struct(F.col(id_column).alias("id"), "lang", "source", "text_hash")
    good = stored(verdicts.where("kept").select(key.alias(mark)).distinct(), "kept")
    lang, source = options.get("lang_column", "lang"), options.get("source_column", "source")
    here = F.struct(
        F.col(id_column).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.xxhash64(text_column).alias("text_hash")
    )
    return docs.withColumn(mark, here).join(good, mark, "left_semi").select(*columns(docs))

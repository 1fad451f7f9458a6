"""Importance resampling towards a target: weights from arrays, winners by distributed quickselect.

Words (or short runs of them) are hashed into buckets. A bucket's gain is the logarithm of how much
likelier the target is to hit it than the documents are; a document's weight is the sum of the gains of
its words, and its score that weight plus Gumbel noise from its id. The documents with the highest
scores are a sample drawn without replacement, in proportion to their weights' exponentials.

Bucket counts are summed inside each task before anything is shuffled, so ``buckets`` rows a task
go out and ``buckets`` rows reach the driver, whatever the corpus. Scores are stored as narrow keys,
equal rows as one key with a count. Nothing is sorted to find the limit: random keys are drawn
as pivots, copies before and at each are counted exactly, and the interval that holds the wanted
rank is cut again, until the key at that rank is one of the pivots. Only winners are sorted, by range.

Defined results: null, empty and word-less texts have no features and weight 0; documents under
``least_words`` words and all documents where the share gives none are not drawn; an id of null has the noise of an
empty id and stands behind others with its score; repeated rows are drawn one by one and are ranked one behind the
other; rows with the same id and other columns stand in the order of their content's hash; a very long text is a row like any other;
an empty table gives an empty one; an empty target has gains too, from what the documents lack.
``resampling_plan`` returns the columns listed there only; ``resample`` returns the columns of
``docs``, whatever their names.
"""

import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .arrays import ALPHANUMERIC, LOWER, blocks, word_bounds
from .names import columns, fresh
from .runs import numbered_copies, row_hash
from .scratch import stored

BUCKETS = 10_000
LONGEST_RUN = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

#: Random keys drawn in a round, and the places around the wanted rank at which they become pivots.
SAMPLE = 256
AROUND = (-32, -16, -8, -4, -2, -1, 0, 1, 2, 4, 8, 16, 32)
#: Longer words are hashed one by one.
LONG_WORD = 40
SPACE = 0x20


def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = crc_table()


def crc_step(state: np.ndarray, byte) -> np.ndarray:
    return CRC[(state ^ byte) & np.uint32(0xFF)] ^ (state >> np.uint32(8))


def crc_spans(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the bytes of each span, one byte of all spans at a time."""
    state, length = state.copy(), ends - starts
    for i in np.flatnonzero(length > LONG_WORD):
        state[i] = zlib.crc32(data[starts[i] : ends[i]], int(~state[i])) ^ 0xFFFFFFFF
    at, k = np.flatnonzero(length <= LONG_WORD), 0
    at = at[length[at] > 0]
    while len(at):
        state[at] = crc_step(state[at], data[starts[at] + k])
        k += 1
        at = at[length[at] > k]
    return state


def feature_buckets(data: np.ndarray, offsets: np.ndarray, longest_run: int, buckets: int):
    """The row of each word, then for runs of one, two, ... words their rows and buckets."""
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets, ALPHANUMERIC)
    row = np.searchsorted(offsets, starts, "right") - 1
    at = np.arange(len(starts))
    state = crc_spans(np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32), data, starts, ends)
    found = [(row, ~state % np.uint32(buckets))]
    for r in range(1, longest_run):
        goes_on = at + r < len(row)
        goes_on[goes_on] = row[at[goes_on] + r] == row[at[goes_on]]
        at, state = at[goes_on], crc_step(state[goes_on], np.uint32(SPACE))
        state = crc_spans(state, data, starts[at + r], ends[at + r])
        found.append((row[at], ~state % np.uint32(buckets)))
    return row, found


def bucket_counts(texts: DataFrame, text_column: str, longest_run: int, buckets: int) -> np.ndarray:
    """Features in each bucket over the whole table."""

    def count_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for data, offsets in blocks(batch.column(0)):
                for _, bucket in feature_buckets(data, offsets, longest_run, buckets)[1]:
                    totals += np.bincount(bucket, minlength=buckets)
        hit = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(totals[hit])], names=["bucket", "n"])

    parts = texts.select(F.col(text_column).cast("string")).mapInArrow(count_part, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the target's and the documents' smoothed rates, rounded down."""
    n = len(own)
    own_total, target_total = float(own.sum() + n), float(target.sum() + n)
    ratios = ((t + 1.0) * own_total / ((s + 1.0) * target_total) for s, t in zip(own.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def text_weights(text: Column, gains, longest_run: int) -> Column:
    """``(n_words, n_features, weight)`` of a text; ``gains`` is a broadcast array."""
    fields = ("n_words", "n_features", "weight")

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [np.zeros((3, 0), dtype=np.int64)]
            for data, offsets in blocks(batch):
                n = len(offsets) - 1
                row, found = feature_buckets(data, offsets, longest_run, len(gains.value))
                out = np.zeros((3, n), dtype=np.int64)
                out[0] = np.bincount(row, minlength=n)
                for at, bucket in found:
                    numbers = np.bincount(at, minlength=n)
                    sums = np.concatenate([[0], np.cumsum(gains.value[bucket])])
                    ends = np.cumsum(numbers)
                    out[1] += numbers
                    out[2] += sums[ends] - sums[ends - numbers]
                parts.append(out)
            yield pa.StructArray.from_arrays([pa.array(a) for a in np.concatenate(parts, axis=1)], fields)

    return compute(text)


def noise(id_column: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def scored(docs: DataFrame, target: DataFrame, id_column: str, text_column: str, target_text: str, longest_run: int, buckets: int, seed: int):
    """A column for ``docs``: a struct of ``n_words``, ``n_features`` and ``weight``; and one of noise."""
    own = bucket_counts(docs, text_column, longest_run, buckets)
    wanted = bucket_counts(target, target_text, longest_run, buckets)
    gains = docs.sparkSession.sparkContext.broadcast(bucket_gains(own, wanted))  # ``buckets`` numbers
    return text_weights(F.col(text_column).cast("string"), gains, longest_run), noise(F.col(id_column), seed)


def place_of(score: Column, id_: Column, hash_: Column) -> Column:
    """What rows are ordered by: high scores first, then small ids, null last, then the content."""
    return F.struct((-score).alias("s"), id_.isNull().alias("none"), id_.alias("id"), hash_.alias("hash"))


def literal(place: Row, kind) -> Column:
    return F.struct(*(F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(place, kind.fields)))


def sort_key(place: Row) -> tuple:
    return tuple(0 if value is None else value for value in place)


def random_keys(keys: DataFrame, n_keys: int, number: int) -> list[Row]:
    """About ``SAMPLE`` of the keys in order, all if there are no more. Which ones is decided by a hash, so that
    a task that runs again draws the same."""
    if n_keys > 2 * SAMPLE:
        at = F.pmod(F.xxhash64(F.lit(number), "place"), F.lit(1 << 40))
        keys = keys.where(at < (2 * SAMPLE * (1 << 40)) // n_keys)
    drawn = keys.select("place", "copies").orderBy(F.xxhash64(F.lit(number), "place")).limit(SAMPLE).collect()
    return sorted(drawn, key=lambda row: sort_key(row.place))


def quickselect(keys: DataFrame, rank: int, n_rows: int, n_keys: int) -> tuple[Row, int]:
    """The key that holds the row of ``rank`` (from 1) in ``keys``, a table of distinct ``place`` with
    their ``copies``, and how many of its copies have that rank or less."""
    kind = keys.schema["place"].dataType
    inside, below = keys, 0
    for number in count():
        sample = random_keys(inside, n_keys, number)
        weights = [0, *accumulate(row.copies for row in sample)]
        centre = bisect_left(weights, (rank - below) / n_rows * weights[-1]) - 1
        chosen = range(len(sample)) if n_keys <= len(AROUND) else {
            min(max(place, 0), len(sample) - 1) for place in (*(centre + d for d in AROUND), len(sample) // 4, len(sample) * 3 // 4)
        }
        pivots = [sample[i] for i in sorted(chosen)]
        before = [F.col("place") < literal(p.place, kind) for p in pivots]
        counted = inside.agg(
            *(F.coalesce(F.sum(F.when(b, F.col("copies"))), F.lit(0)) for b in before), *(F.count_if(b) for b in before)
        ).first()
        rows_before, keys_before = counted[: len(pivots)], counted[len(pivots) :]
        low, low_rows, low_keys = None, 0, 0
        for pivot, rows, n in zip(pivots, rows_before, keys_before):
            if below + rows + pivot.copies >= rank:
                if below + rows < rank:
                    return pivot.place, rank - below - rows
                inside = inside.where(F.col("place") < literal(pivot.place, kind))
                n_rows, n_keys = rows, n
                break
            low, low_rows, low_keys = pivot, rows + pivot.copies, n + 1
        if low is not None:
            inside = inside.where(F.col("place") > literal(low.place, kind))
        below, n_rows, n_keys = below + low_rows, n_rows - low_rows, n_keys - low_keys


def ranked(winners: DataFrame, count_column: str) -> DataFrame:
    """``winners`` with ``first_rank``: one more than the rows before it in order of ``place``."""
    ranges = stored(winners.repartitionByRange("place").withColumn("cell", F.spark_partition_id()), "winners")
    # one row a range: as many as the shuffle has partitions
    cells = sorted(ranges.groupBy("cell").agg(F.sum(count_column).alias("n")).collect())
    firsts = zip((c.cell for c in cells), accumulate((c.n for c in cells), initial=1))
    offsets = winners.sparkSession.createDataFrame(list(firsts), "cell int, offset long")
    earlier = Window.partitionBy("cell").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranges.withColumn("ahead", F.coalesce(F.sum(count_column).over(earlier), F.lit(0)))
    return numbered.join(F.broadcast(offsets), "cell").withColumn("first_rank", F.col("ahead") + F.col("offset")).drop("cell", "ahead", "offset")


def limit_of(keys: DataFrame, least_words: int, percent: int):
    """The last place that is drawn and how many of its copies; and the most copies of any key."""
    fit = keys.where(F.col("n_words") >= least_words)
    sums = fit.agg(F.sum("copies").alias("rows"), F.count("*").alias("keys")).first()
    drawn = (sums.rows or 0) * percent // 100
    return quickselect(fit.select("place", "copies"), drawn, sums.rows, sums.keys) if drawn else None


def resampling_plan(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    longest_run: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: id, ``row_hash``, ``n_words``, ``n_features``, ``weight``, ``score`` and
    ``rank`` (from 1 among the drawn ``percent`` of documents with ``least_words`` words; else null)."""
    weights, random = scored(docs, target, id_column, text_column, target_text, longest_run, buckets, seed)
    rows = docs.select(F.col(id_column).alias("id"), row_hash(docs).alias("row_hash"), weights.alias("w"), random.alias("noise"))
    rows = rows.select("id", "row_hash", "w.n_words", "w.n_features", "w.weight", (F.col("w.weight") + F.col("noise")).alias("score"))
    keys = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    keys = stored(keys.withColumn("place", place_of(F.col("score"), F.col("id"), F.col("row_hash"))), "scores")
    largest = keys.agg(F.max("copies")).first()[0] or 0
    limit = limit_of(keys, least_words, percent)
    out = ["id", "row_hash", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("long")
    if limit is None:
        plan = numbered_copies(keys, "copies", "k", largest).select(*out, none.alias("rank"))
    else:
        last, taken = limit
        last = literal(last, keys.schema["place"].dataType)
        won = F.when(F.col("n_words") < least_words, 0).when(F.col("place") < last, F.col("copies")).when(F.col("place") == last, taken).otherwise(0)
        keys = keys.withColumn("won", won.cast("long")).withColumn("lost", F.col("copies") - F.col("won"))
        winners = numbered_copies(ranked(keys.where("won > 0"), "won"), "won", "k", largest)
        losers = numbered_copies(keys, "lost", "k", largest)
        plan = winners.select(*out, (F.col("first_rank") + F.col("k")).alias("rank")).union(losers.select(*out, none.alias("rank")))
    return plan.withColumnRenamed("id", id_column)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    longest_run: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """The drawn rows of ``docs``. Texts are scored again rather than shuffled to their ranks; of
    equal rows at the limit, as many come as are drawn."""
    weights, random = scored(docs, target, id_column, text_column, target_text, longest_run, buckets, seed)
    weight, content, place = (fresh(docs, name) for name in ("_weight", "_content", "_place"))
    rows = docs.withColumn(content, row_hash(docs)).withColumn(weight, weights)
    score = F.col(f"{weight}.weight") + random
    rows = rows.withColumn(place, place_of(score, F.col(f"`{id_column}`"), F.col(content))).where(F.col(f"{weight}.n_words") >= least_words)
    keys = stored(rows.groupBy(F.col(place).alias("place")).agg(F.count("*").alias("copies")).withColumn("n_words", F.lit(least_words)), "scores")
    limit = limit_of(keys, least_words, percent)
    if limit is None:
        return docs.where(F.lit(False))
    last = literal(limit[0], keys.schema["place"].dataType)
    number, times = fresh(docs, "_k"), fresh(docs, "_copies")
    at_limit = rows.where(F.col(place) == last).limit(1).withColumn(times, F.lit(limit[1]).cast("long"))
    at_limit = numbered_copies(at_limit, times, number, limit[1])
    return rows.where(F.col(place) < last).select(*columns(docs)).union(at_limit.select(*columns(docs)))

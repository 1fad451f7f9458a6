"""Benchmark decontamination: test windows are looked up in every document.

The windows of a benchmark are runs of ``window_words`` normalised words (a shorter item is
one window). Their hashes are broadcast; a task hashes every run of words of its documents,
looks the hashes up, compares the words of each hit, and marks the words that are inside an
occurrence. Scanning needs no shuffle.

The broadcast is sized before it is made: the bytes of all (window, item) pairs are added up,
and a benchmark over ``block_bytes`` is cut by hash into blocks that fit. Each block is
looked for in all documents, and what the blocks found is put together per text.

Defined results: null, empty and word-less texts have no words and are clean; an item without
words has no window; items that repeat count once per id, an item without an id hits but is not
listed; repeated documents are each judged; a very long text is scanned whole by the task that has it; an empty table gives an
empty one; a column named like ``into`` is replaced, other columns stay, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .arrays import ALPHANUMERIC, LOWER, blocks, span_hashes, spread, word_bounds
from .names import fresh
from .scratch import stored

WINDOW_WORDS = 10
#: Bytes of window text in one broadcast.
BLOCK_BYTES = 16 << 20

UPPER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOUND = "n_words long, spans array<struct<first: int, last: int>>, items array<long>"


def benchmark_windows(items: DataFrame, id_column: str, text_column: str, window_words: int) -> DataFrame:
    """Distinct ``(window, n, item)``; the words of ``window`` are joined with spaces."""
    lowered = F.translate(F.col(text_column), UPPER_LETTERS, UPPER_LETTERS.lower())
    words = F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    n = F.size("words")
    windows = F.when(
        n > window_words,
        F.transform(
            F.sequence(F.lit(1), n - window_words + 1),
            lambda i: F.array_join(F.slice(F.col("words"), i, window_words), " "),
        ),
    ).otherwise(F.array(F.array_join("words", " ")))
    return (
        items.select(F.col(id_column).cast("long").alias("item"), words.alias("words"))
        .where(n > 0)
        .select("item", F.least(n, F.lit(window_words)).alias("n"), F.explode(windows).alias("window"))
        .distinct()
    )


class WindowIndex:
    """Hashes of windows, by window length, with their words and items."""

    def __init__(self, rows):
        entries: dict[int, dict[bytes, set[int]]] = {}
        for row in rows:
            listed = entries.setdefault(row.n, {}).setdefault(row.window.encode(), set())
            if row.item is not None:
                listed.add(row.item)
        self.lengths = []
        for n, windows in entries.items():
            keys = list(windows)
            data = np.frombuffer(b" ".join(keys), np.uint8)
            starts, ends = word_bounds(data, np.zeros(1, np.int64), ALPHANUMERIC)
            found = run_hashes(spread(span_hashes(data, starts, ends)), np.arange(0, len(starts), n), n)
            order = np.argsort(found)
            shift = np.uint64(64 - max(16, int(len(keys) * 64).bit_length()))
            seen = np.zeros(1 << (64 - int(shift)), dtype=bool)
            seen[found >> shift] = True
            self.lengths.append((n, found[order], order, keys, [sorted(windows[k]) for k in keys], shift, seen))


def run_hashes(word_hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return span_hashes(word_hashes, at, at + n)


def scan(data: np.ndarray, offsets: np.ndarray, index: WindowIndex):
    """Word bounds, the row of each word, whether it is hit, and the items found per row."""
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets, ALPHANUMERIC)
    row = np.searchsorted(offsets, starts, "right") - 1
    edge = np.zeros(len(starts) + 1, dtype=np.int32)
    items: dict[int, set[int]] = {}
    hashes = spread(span_hashes(data, starts, ends)) if index.lengths else None
    for n, keys, order, windows, listed, shift, seen in index.lengths:
        if len(starts) < n:
            continue
        at = np.arange(len(starts) - n + 1)
        runs = run_hashes(hashes, at, n)
        maybe = np.flatnonzero(seen[runs >> shift] & (row[at] == row[at + n - 1]))
        low = np.searchsorted(keys, runs[maybe], "left")
        high = np.searchsorted(keys, runs[maybe], "right")
        for i, a, b in zip(maybe[high > low], low[high > low], high[high > low]):
            run = b" ".join(data[starts[k] : ends[k]].tobytes() for k in range(i, i + n))
            for k in order[a:b]:
                if windows[k] == run:
                    edge[i] += 1
                    edge[i + n] -= 1
                    items.setdefault(int(row[i]), set()).update(listed[k])
    return starts, ends, row, np.cumsum(edge[:-1]) > 0, items


def scan_rows(data: np.ndarray, offsets: np.ndarray, index: WindowIndex) -> Iterator[dict]:
    starts, _, row, hit, items = scan(data, offsets, index)
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    ends = np.cumsum(n_words)
    for r, (n, end) in enumerate(zip(n_words.tolist(), ends.tolist())):
        flags = hit[end - n : end]
        spans = []
        if flags.any():
            turns = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
            spans = [{"first": a, "last": b - 1} for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())]
        yield {"n_words": n, "spans": spans, "items": sorted(items.get(r, ()))}


def look_up(text: Column, index) -> Column:
    """A struct ``FOUND`` per text; ``index`` is a broadcast WindowIndex. Spans count words."""
    kind = to_arrow_type(StructType.fromDDL(FOUND))

    @F.arrow_udf(FOUND)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [r for data, offsets in blocks(batch) for r in scan_rows(data, offsets, index.value)]
            yield pa.array(rows, kind)

    return compute(text)


def without_words(text: bytes, spans: list[dict]) -> str:
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_bounds(LOWER[data], np.array([0, len(data)]), ALPHANUMERIC)
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : starts[span["first"]]])
        at = ends[span["last"]]
    return b"".join([*kept, text[at:]]).decode()


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what stands between those words."""

    @F.arrow_udf("string")
    def compute(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            pairs = zip(texts.cast(pa.large_binary()), found)
            yield pa.array([without_words(t.as_py(), s.as_py()) if len(s) else None for t, s in pairs], pa.string())

    return F.when(F.size(spans) > 0, compute(text, spans)).otherwise(text)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window_words: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    into: str = "found",
) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``n_hit`` (words inside
    an occurrence), ``items`` (ids whose windows occur) and ``spans`` (hit words, by number)."""
    context = docs.sparkSession.sparkContext
    windows = stored(benchmark_windows(items, item_id, item_text, window_words), "windows")
    total = windows.agg(F.sum(F.length("window") + 16)).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    if n_blocks == 1:
        index = context.broadcast(WindowIndex(windows.collect()))
        out = docs.withColumn(into, look_up(F.col(text_column), index))
    else:
        pieces, key, own = None, fresh(docs, "_digest"), fresh(docs, "_own")
        digest = F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)
        for b in range(n_blocks):
            part = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks)) == b)
            index = context.broadcast(WindowIndex(part.collect()))
            hits = docs.select(digest.alias(key), look_up(F.col(text_column), index).alias("f"))
            piece = stored(hits.where(F.size("f.spans") > 0).select(key, "f.spans", "f.items").distinct(), "hits")
            index.unpersist()
            pieces = piece if pieces is None else pieces.union(piece)
        merged = stored(
            pieces.groupBy(key).agg(
                F.struct(
                    F.flatten(F.collect_list("spans")).alias("spans"),
                    F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                ).alias(own)
            ),
            "hits",
        )
        counted = look_up(F.col(text_column), context.broadcast(WindowIndex([])))
        words = fresh(docs, "_words")
        out = docs.withColumn(key, digest).withColumn(words, counted).join(merged, key, "left")
        none = F.array().cast("array<struct<first: int, last: int>>")
        out = out.withColumn(
            into,
            F.struct(
                F.col(f"{words}.n_words").alias("n_words"),
                joined_spans(F.coalesce(F.col(f"{own}.spans"), none)).alias("spans"),
                F.coalesce(F.col(f"{own}.items"), F.array().cast("array<long>")).alias("items"),
            ),
        ).drop(key, words, own)
    width = F.aggregate(
        F.col(f"{into}.spans"), F.lit(0).cast("long"), lambda sum_, s: sum_ + (s["last"] - s["first"] + 1)
    )
    return out.withColumn(
        into,
        F.struct(
            F.col(f"{into}.n_words").alias("n_words"),
            width.alias("n_hit"),
            F.col(f"{into}.items").alias("items"),
            F.col(f"{into}.spans").alias("spans"),
        ),
    )


def joined_spans(spans: Column) -> Column:
    """Spans in order, those that touch or overlap joined."""
    start = F.array().cast("array<struct<first: int, last: int>>")

    def add(done: Column, span: Column) -> Column:
        end = F.element_at(done, -1)
        longer = F.struct(end["first"].alias("first"), F.greatest(end["last"], span["last"]).alias("last"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] + 1 >= span["first"])
        return F.when(
            touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), start, add)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those in which a benchmark window occurs."""
    found = fresh(docs, "_found")
    judged = find_contamination(docs, items, into=found, **options)
    return judged.where(F.col(f"{found}.n_hit") == 0).drop(found)


def cut_contamination(docs: DataFrame, items: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """``docs`` with every occurrence of a benchmark window cut out of the text."""
    found = fresh(docs, "_found")
    judged = find_contamination(docs, items, text_column, into=found, **options)
    return judged.withColumn(text_column, cut_spans(F.col(text_column), F.col(f"{found}.spans"))).drop(found)

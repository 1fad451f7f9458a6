"""Periodic runs of words: stretches such as ``a b c a b c a b c a b c``, found by minimizers of many scales.

A run is a stretch of words with smallest period q (words q apart are the same) and at least
``max(6, 4 * q)`` words that can't be made longer on either side. Periods under ``SHORT`` are found by
comparing the words with themselves at each lag. Longer ones are found by scales: scale s
looks for periods from 2**s to below 2**(s + 1), with windows of w = 2**(s - 1) words.

* The hashes of all w words on end are made from those of the scale below, two by two.
* The smallest hash in every window of w places is its minimizer, the first one of equals. Inside a run
  windows one period apart hold the same words, so minimizers repeat at the period's distance.
* Two equal minimizers at a distance of this scale are a seed: the words are compared at that distance, both
  ways from the seed, until they differ.

Places that only continue a run with a period up to w / 3 (found at a scale below) are no candidates for
minimizers. So equal ones are over w / 3 apart, no place has more than 12 partners, and a text that is one long run
costs no more than any other. Nothing is lost by it: places that are left out by themselves for a whole period
would all continue one and the same shorter run, and then the longer period would not be the smallest.

The work is per text, in tasks over blocks of texts of a few MB, without a shuffle. Words are
compared by 64-bit hashes.

Defined results: a null text has no words; null, empty and word-less texts and those under six words have no run; the
collapsed text of a null text is empty; repeated rows come out alike; a text longer than a block is a block of its
own; an empty table gives an empty one; a column named like ``into`` is replaced, all other columns stay.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .arrays import SPACED, blocks, span_hashes, spread, word_bounds

#: What makes a run.
LEAST_WORDS = 6
LEAST_PERIODS = 4

#: Periods below this are looked for lag by lag; 2 to the power of the first scale.
SHORT = 16
FIRST_SCALE = 4

RUNS = "runs array<struct<start: int, length: int, period: int>>"
FOUND = f"n_words int, {RUNS}, collapsed string"

ODD = np.uint64(0x9E3779B97F4A7C15)
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def stretches(same: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Begin and end of the stretches of True that are at least so long."""
    if least <= 1 or len(same) >= least:
        at = np.flatnonzero(same)
        if len(at) >= least:
            breaks = np.flatnonzero(np.diff(at) > 1)
            begins = at[np.concatenate([[0], breaks + 1])]
            ends = at[np.concatenate([breaks, [len(at) - 1]])] + 1
            long = ends - begins >= least
            yield from zip(begins[long].tolist(), ends[long].tolist())


class Runs:
    """Runs by place: the smallest period of each."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.period[start, end] = min(period, self.period.get((start, end), period))

    def listed(self) -> list[tuple[int, int, int]]:
        return sorted((start, end - start, period) for (start, end), period in self.period.items())


def short_periods(words: np.ndarray, found: Runs) -> None:
    for lag in range(1, min(SHORT, len(words))):
        for begin, end in stretches(words[lag:] == words[:-lag], least_length(lag) - lag):
            found.add(begin, end + lag, lag)


def window_minima(hashes: np.ndarray, allowed: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest hash in each window of ``width`` places, the first of equals."""
    bits = np.uint64(int(len(hashes)).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    keys = np.where(allowed, (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), NEVER)
    step = 1
    while step < width:  # minima of 2, 4, 8, ... places
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return (keys[keys != NEVER] & low).astype(np.int64)


def equal_pairs(hashes: np.ndarray, at: np.ndarray, least: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of equal minimizers that are from ``least`` to under ``below`` apart."""
    order = np.argsort(hashes[at], kind="stable")
    at, values = at[order], hashes[at[order]]
    places, distances, step = [], [], 1
    here = np.arange(len(at) - 1) if len(at) else np.arange(0)
    while len(here):
        here = here[here + step < len(at)]
        apart = at[here + step] - at[here]
        near = (values[here + step] == values[here]) & (apart < below)
        here, apart = here[near], apart[near]
        places.append(at[here[apart >= least]])
        distances.append(apart[apart >= least])
        step += 1
    if not places:
        return np.arange(0), np.arange(0)
    places, distances = np.concatenate(places), np.concatenate(distances)
    order = np.lexsort((places, distances))
    return places[order], distances[order]


def same_ahead(words: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on are the same as those ``lag`` further on."""
    done, size, last = 0, 64, len(words) - lag - at
    while done < last:
        size = min(size, last - done)
        a = at + done
        differ = words[a : a + size] != words[a + lag : a + lag + size]
        if differ.any():
            return done + int(differ.argmax())
        done += size
        size *= 2
    return done


def same_behind(words: np.ndarray, at: int, lag: int) -> int:
    """How many words before ``at`` are the same as those ``lag`` further on."""
    done, size = 0, 64
    while done < at:
        size = min(size, at - done)
        a = at - done
        differ = (words[a - size : a] != words[a + lag - size : a + lag])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done += size
        size *= 2
    return done


def long_periods(words: np.ndarray, longest: int, found: Runs) -> None:
    """Runs with periods from ``SHORT`` up to ``longest``."""
    hashes = words
    width = 1
    for _ in range(FIRST_SCALE - 1):
        hashes, width = doubled(hashes, width), 2 * width
    while 2 * width <= longest and len(hashes) >= width:
        allowed = np.ones(len(hashes), dtype=bool)
        for (start, end), period in found.period.items():
            if 3 * period <= width:  # the places whose words continue a shorter run
                allowed[start + period : max(start + period, end - width + 1)] = False
        at = window_minima(hashes, allowed, width)
        known: tuple[int, int] = (0, -1)
        for place, lag in zip(*(a.tolist() for a in equal_pairs(hashes, at, 2 * width, 4 * width))):
            if known[0] == lag and place < known[1]:
                continue  # in the stretch that the seed before it gave
            begin = place - same_behind(words, place, lag)
            end = place + same_ahead(words, place, lag) + lag
            known = (lag, end - lag)
            if end - begin >= least_length(lag):
                found.add(begin, end, lag)
        if len(hashes) <= width:
            break
        hashes, width = doubled(hashes, width), 2 * width


def doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """From hashes of ``width`` words on end those of twice as many."""
    if len(hashes) <= width:
        return hashes[:0]
    return spread(spread(hashes[:-width] * ODD) + hashes[width:])


def find_in_words(words: np.ndarray, longest_text: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs; what separates texts occurs once only."""
    found = Runs()
    short_periods(words, found)
    if longest_text >= LEAST_PERIODS * SHORT:
        long_periods(words, longest_text // LEAST_PERIODS, found)
    return found.listed()


def scan_block(data: np.ndarray, offsets: np.ndarray) -> Iterator[dict]:
    """Words, runs and the collapsed text of each row."""
    starts, ends = word_bounds(data, offsets, SPACED)
    row = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    firsts = np.cumsum(n_words) - n_words
    hashes = spread(span_hashes(data, starts, ends))
    runs: list[list[dict]] = [[] for _ in n_words]
    texts = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    # Texts of like length go together, so that short ones take no part in the scales of long ones.
    sizes = np.frexp(np.maximum(n_words, 1))[1]
    for size in np.unique(sizes[n_words >= LEAST_WORDS]).tolist():
        chosen = np.flatnonzero((sizes == size) & (n_words >= LEAST_WORDS))
        parts, begins, at = [], [], 0
        for i in chosen.tolist():
            # between two texts stands a value that occurs nowhere else
            parts += [hashes[firsts[i] : firsts[i] + n_words[i]], spread(np.array([(1 << 63) + i], dtype=np.uint64))]
            begins.append(at)
            at += int(n_words[i]) + 1
        bounds = np.array(begins)
        for start, length, period in find_in_words(np.concatenate(parts), int(n_words[chosen].max())):
            k = int(np.searchsorted(bounds, start, "right")) - 1
            runs[chosen[k]].append({"start": start - begins[k], "length": length, "period": period})
    for own, words in zip(runs, texts):
        yield {"n_words": len(words), "runs": own, "collapsed": collapsed(words, own)}


def collapsed(words: list[bytes], runs: list[dict]) -> str:
    """The words joined by spaces, of each run only the first period."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for run in runs:
            kept[run["start"] + run["period"] : run["start"] + run["length"]] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words).decode()


def periodic_runs(text: Column) -> Column:
    """A struct ``FOUND`` for each text: runs by start, then period, counted in words from 0."""
    kind = to_arrow_type(StructType.fromDDL(FOUND))

    @F.arrow_udf(FOUND)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([r for data, offsets in blocks(batch) for r in scan_block(data, offsets)], kind)

    return compute(text.cast("string"))


def find_runs(docs: DataFrame, text_column: str = "text", into: str = "periodic") -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``runs`` and ``collapsed``."""
    return docs.withColumn(into, periodic_runs(F.col(text_column)))


def collapse_runs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with each run of words cut down to its first period; the words left are joined by single
    spaces. A null text stays null."""
    shorter = periodic_runs(F.col(text_column))["collapsed"]
    return docs.withColumn(text_column, F.when(F.col(text_column).isNotNull(), shorter))

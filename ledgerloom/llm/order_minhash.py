"""Order MinHash: document fingerprints that are sensitive to edit distance.

Every run of ``kmer_bytes`` bytes of a text is a k-mer, numbered by how often it has occurred so
far, so that repeats count. Numbered k-mers are put into an order by a hash, which is cut into ``cells``
equal ranges (one permutation in place of many). Of each cell the ``picked`` smallest are selected, put
back into the order in which they stand in the text, and hashed together, as k-mers without their numbers. So a
cell agrees between two texts only if they share its smallest k-mers *and* have them in the same order:
unlike MinHash, moving passages about lowers the likeness, as it raises the edit distance.

A fingerprint has four hex digits for each cell, ``0000`` for one without k-mers. The likeness of two is the
share of agreeing cells among those that are not empty in both.

Fingerprints are made text by text in tasks and need no shuffle. ``with_next`` brings each document together
with the one after it by one range shuffle of the texts; a task walks over its range in order, and only
the first and last rows of ranges are joined afterwards.

Defined results: null and empty texts have the empty fingerprint, which is like itself (1) and unlike
all others (0); a text shorter than a k-mer is one k-mer; equal texts have equal fingerprints, wherever they
stand; a very long text is read whole, by the task that has it. ``fingerprint_docs`` leaves other columns as
they are (one named like ``into`` is replaced). In ``with_next`` an id of null stands last, repeated ids are in
the order of their texts' hashes, repeated rows one behind the other; a single row is followed by itself; an empty table
gives an empty one.
"""

import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .arrays import spread
from .scratch import stored

KMER_BYTES = 8
PICKED = 2
CELLS = 64

DIGITS = 4
WORD = 8
ODD = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
#: Rows of one batch that ``with_next`` gives out.
OUT_ROWS = 1000


def kmers(text: bytes, size: int) -> np.ndarray:
    """A hash of each run of ``size`` bytes; of 8 to 16 bytes all are looked at, in two words."""
    if not 1 <= size <= 2 * WORD:
        raise ValueError(f"k-mers of {size} bytes, not 1 to {2 * WORD}")
    if not text:
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(text) - size + 1)
    padded = text + bytes(2 * WORD)
    words = np.ndarray((n,), dtype="<u8", buffer=padded, strides=(1,)).copy()
    if size < WORD:
        words &= np.uint64((1 << 8 * size) - 1)
    elif size > WORD:
        words = spread(words * ODD) + np.ndarray((n,), dtype="<u8", buffer=padded, offset=size - WORD, strides=(1,))
    return spread(words * ODD + np.uint64(min(len(text), size)))


def signature(text: bytes, size: int = KMER_BYTES, picked: int = PICKED, cells: int = CELLS) -> np.ndarray:
    """The cells' hashes, 0 for an empty one. ``cells`` is a power of 2."""
    hashes = kmers(text, size)
    n = len(hashes)
    if not n:
        return np.zeros(cells, dtype=np.uint16)
    # a place in the text fits the low bits, the rest of a number orders
    low = np.uint64((1 << n.bit_length()) - 1)
    numbered = np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64))
    here = np.arange(n, dtype=np.uint64)
    first = np.concatenate([[True], (numbered[1:] & ~low) != (numbered[:-1] & ~low)])
    occurrence = here - np.maximum.accumulate(np.where(first, here, np.uint64(0)))
    at = numbered & low
    order = spread((numbered & ~low) * OTHER + occurrence * ODD)
    smallest = np.sort((spread(order * ODD) & ~low) | at)
    shift = np.uint64(64 - (cells.bit_length() - 1))
    bounds = np.searchsorted(smallest >> shift if cells > 1 else np.zeros(n, np.uint64), np.arange(cells + 1, dtype=np.uint64))
    chosen = bounds[:-1, None] + np.arange(picked)
    there = chosen < bounds[1:, None]
    places = np.where(there, (smallest[np.minimum(chosen, n - 1)] & low).astype(np.int64), n)
    places.sort(axis=1)
    values = np.append(hashes, np.uint64(0))[places]
    out = np.zeros(cells, dtype=np.uint64)
    for column in range(picked):
        out = spread(out * ODD + values[:, column] + np.uint64(column))
    out = np.maximum(out >> np.uint64(64 - 4 * DIGITS), 1)
    return np.where(there[:, 0], out, 0).astype(np.uint16)


def as_bytes(cells: np.ndarray) -> bytes:
    return cells.astype(">u2").tobytes()


def as_text(cells: np.ndarray) -> str:
    return as_bytes(cells).hex()


def likeness_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of agreeing cells along the last axis; 1 where all are empty."""
    used = ((a != 0) | (b != 0)).sum(axis=-1)
    agree = ((a == b) & (a != 0)).sum(axis=-1)
    return np.where(used == 0, 1.0, agree / np.maximum(used, 1))


def fingerprint(text: Column, size: int = KMER_BYTES, picked: int = PICKED, cells: int = CELLS) -> Column:
    """The fingerprint of each text as a string."""

    @F.arrow_udf("string")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = batch.cast(pa.large_binary())
            yield pa.array((as_text(signature(v.as_py() or b"", size, picked, cells)) for v in values), pa.string())

    return compute(text.cast("string"))


def likeness(a: Column, b: Column) -> Column:
    """How like two fingerprints are, 0 to 1; null if one of them is null."""

    @F.arrow_udf("double")
    def compute(left: pa.Array, right: pa.Array) -> pa.Array:
        whole = [x.as_py() + y.as_py() if x.is_valid and y.is_valid else None for x, y in zip(left, right)]
        pairs = (None if p is None else np.frombuffer(bytes.fromhex(p), ">u2").reshape(2, -1) for p in whole)
        return pa.array([None if p is None else float(likeness_of(p[0], p[1])) for p in pairs], pa.float64())

    return compute(a, b)


def fingerprint_docs(docs: DataFrame, text_column: str = "text", into: str = "fingerprint", **options) -> DataFrame:
    return docs.withColumn(into, fingerprint(F.col(text_column), **options))


class Doc:
    """A document on its way through a task; its signature is made once."""

    def __init__(self, id_, text: str | None, *options):
        self.id, self.text, self.options = id_, text or "", options

    @cached_property
    def signature(self) -> np.ndarray:
        return signature(self.text.encode(), *self.options)


def with_next(docs: DataFrame, make: Callable[[Doc, Doc], dict], made: str, id_column: str, text_column: str, *options) -> DataFrame:
    """``make(document, next one)`` for each row, in descending order of ids; the last one is followed by the
    first. ``made`` lists the columns that come out besides the id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    # equal rows may stand in any order, so a number that spreads them over ranges settles their ties
    order = [F.desc_nulls_last("id"), F.asc("hash"), F.asc("tie")]
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    kind = rows.schema
    out = StructType([StructField("id", kind["id"].dataType), *StructType.fromDDL(made).fields])
    loose = StructType([*StructType.fromDDL("cell int, part string").fields, *out.fields, kind["text"]])
    arrow_out, arrow_loose = to_arrow_schema(out), to_arrow_schema(loose)

    def gathered(found: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in found:
            rows.append(row)
            if len(rows) == OUT_ROWS:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cell, held = TaskContext.get().partitionId(), None
        for batch in batches:
            for id_, text in zip(*batch.columns):
                doc = Doc(id_.as_py(), text.as_py(), *options)
                if held is None:
                    yield {"cell": cell, "part": "first", "text": doc.text}
                else:
                    yield {"cell": cell, "part": "whole", "id": held.id, **make(held, doc)}
                held = doc
        if held is not None:
            yield {"cell": cell, "part": "last", "id": held.id, "text": held.text}

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for id_, text, following in zip(*batch.columns):
                doc = Doc(id_.as_py(), text.as_py(), *options)
                yield {"id": doc.id, **make(doc, Doc(None, following.as_py(), *options))}

    walked = stored(rows.mapInArrow(lambda batches: gathered(walk(batches), arrow_loose), loose), "walked")
    # one number a range: as many as the shuffle has partitions
    cells = sorted(row.cell for row in walked.where("part = 'first'").select("cell").collect())
    following = spark.createDataFrame(list(zip(cells, [*cells[1:], *cells[:1]])), "cell int, next_cell int")
    firsts = walked.where("part = 'first'").select(F.col("cell").alias("next_cell"), F.col("text").alias("next_text"))
    ends = walked.where("part = 'last'").join(F.broadcast(following), "cell").join(firsts, "next_cell")
    met = ends.select("id", "text", "next_text").mapInArrow(lambda batches: gathered(meet(batches), arrow_out), out)
    whole = walked.where("part = 'whole'").select(*out.fieldNames())
    return whole.union(met).withColumnRenamed("id", id_column)


#: What goes through the stored table: bytes take half the room of their digits.
EDITED = (
    "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def edited(text: str, other: str) -> str:
    """The last third of ``text`` replaced by as much of the beginning of ``other``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + other[:cut]


def compare(doc: Doc, following: Doc) -> dict:
    changed = Doc(None, edited(doc.text, following.text), *doc.options)
    near_edited, near_next = likeness_of(doc.signature, np.stack([changed.signature, following.signature])).tolist()
    return {
        "n_chars": len(doc.text),
        "edited_sha256": hashlib.sha256(changed.text.encode()).digest(),
        "fingerprint": as_bytes(doc.signature),
        "edited_fingerprint": as_bytes(changed.signature),
        "near_edited": near_edited,
        "near_next": near_next,
    }


def edit_report(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = KMER_BYTES,
    picked: int = PICKED,
    cells: int = CELLS,
) -> DataFrame:
    """Id and the columns of ``EDITED``, bytes as hex digits: each document's fingerprint beside that of its
    edited text, and how like it is to that and to the next document's."""
    found = with_next(docs, compare, EDITED, id_column, text_column, size, picked, cells)
    digits = {name: F.lower(F.hex(name)) for name, kind in found.dtypes if kind == "binary" and name != id_column}
    return found.withColumns(digits)

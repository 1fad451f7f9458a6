"""SimHash near-duplicates, found by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; bit i is set if it is set in over half of the hashes of the
text's word shingles. Two fingerprints at most ``max_bits`` bits apart have a common
variant within half that distance of both. So every distinct fingerprint emits its
variants, the variants are shuffled, and fingerprints that meet on one are linked. Copies
with equal fingerprints are merged before that and cost nothing; a variant is met by no
more distinct fingerprints than its ball holds (65 for a radius of 2), whatever the data.

Defined results: null and empty texts and texts without words have fingerprint zero and are
linked like any other; a text with fewer words than a shingle is one shingle; repeated rows
and rows with the same id are rows of their own in the fingerprint table; an id of null
never names a component unless all its rows have none. A very long text is read whole by the task that has it. An
empty table gives an empty one. Columns of ``docs`` may have any names; ``keep_one_per_component`` returns them.
"""

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .names import columns, fresh
from .runs import row_hash, row_key
from .scratch import stored

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Hashes whose bits are counted at once.
COUNT_ROWS = 1 << 16


def fingerprint_of(text: bytes, shingle_words: int) -> int:
    words = text.lower().split()  # bytes: only A-Z change, only \x20 and \x09-\x0D split
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(shingle_words))) if len(words) >= shingle_words else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), COUNT_ROWS):
        part = hashes[i : i + COUNT_ROWS].view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a (signed) long."""

    @F.arrow_udf("long")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = batch.cast(pa.large_binary())
            yield pa.array((fingerprint_of(v.as_py() or b"", shingle_words) for v in values), pa.int64())

    return compute(text)


def as_hex(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def link_fingerprints(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs ``(a, b)`` of the distinct fingerprints in column ``fp`` that, with all they
    reach, connect every two fingerprints at most ``max_bits`` apart.

    For an odd distance one of the two goes half a bit further: variants are emitted within
    the larger half, and those who meet are linked to the smallest one that lies within the
    smaller half.
    """
    wide, narrow = (max_bits + 1) // 2, max_bits // 2
    masks = [sum(1 << i for i in c) for k in range(wide + 1) for c in combinations(range(64), k)]
    n_narrow = sum(comb(64, k) for k in range(narrow + 1))
    # a narrow table has few partitions, and each row becomes many: it is spread first
    spread = fps.repartition(split_count(fps, len(masks)), "fp")
    variants = spread.select(
        "fp", F.posexplode(F.array(*(F.lit(signed(m)) for m in masks))).alias("k", "mask")
    ).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), (F.col("k") < n_narrow).alias("near"))
    centre = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("variant"))
    return (
        variants.select(centre.alias("a"), F.col("fp").alias("b"))
        .where("a != b")
        .distinct()
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


#: About the most variants that one task emits.
ROWS_PER_TASK = 1 << 20


def split_count(fps: DataFrame, n_masks: int) -> int:
    """Partitions for the fingerprints, counted, so that none makes many more than ``ROWS_PER_TASK`` variants."""
    return max(1, -(-fps.count() * n_masks // ROWS_PER_TASK))


def simhash_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: its id, ``fp``, ``text_hash`` (of the exact text), ``row_hash`` (of all
    columns), ``root`` (the smallest fingerprint that it reaches over links) and ``component_id``, the smallest id."""
    rows = stored(
        docs.select(
            F.col(id_column),
            F.xxhash64(F.col(text_column)).alias("text_hash"),
            row_hash(docs).alias("row_hash"),
            fingerprint(F.col(text_column), shingle_words).alias("fp"),
        ),
        "fingerprints",
    )
    fps = stored(rows.groupBy("fp").agg(F.min(id_column).alias("first_id")), "distinct")
    labels = components(link_fingerprints(fps.select("fp"), max_bits))
    members = stored(
        fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", F.coalesce("label", "fp").alias("root")
        ),
        "members",
    )
    roots = stored(members.groupBy("root").agg(F.min("first_id").alias("component_id")), "roots")
    named = stored(members.join(roots, "root").select("fp", "root", "component_id"), "named")
    return rows.join(named, "fp").select(id_column, "fp", "text_hash", "row_hash", "root", "component_id")


def keep_one_per_component(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each component left: the one with the smallest id, of
    several rows with that id the one whose text has the smallest hash, then the one whose other columns
    have. Rows that are equal in all columns are one."""
    found = stored(simhash_components(docs, id_column, text_column, shingle_words, max_bits), "components")
    first = F.min(
        F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), "text_hash", "row_hash")
    )
    kept = found.groupBy("component_id", "root").agg(first.alias("kept"))
    mark = fresh(docs, "_key")
    kept = kept.select(F.struct("kept.id", F.col("kept.row_hash").alias("hash")).alias(mark))
    # equal rows are left, of which one is wanted; texts are shuffled once, by the key
    chosen = docs.withColumn(mark, row_key(docs, id_column)).join(kept, mark, "left_semi").dropDuplicates([mark])
    return chosen.select(*columns(docs))

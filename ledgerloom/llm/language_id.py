"""Language identification in two steps: family first, then the language within it.

Both steps are one-versus-one linear support vector machines over hashed three-byte runs of
letters. Families are told apart by coarse differences; within a family each pair of languages has
a machine of its own, which only has to know what separates those two. A family or language wins
with the most pairs, ties go to the larger sum of margins, then to the smaller name. Where more than
``FAN_OUT`` families or languages would meet, they are first put into groups of like ones, so pairs grow with the
number of languages and not with its square.

Languages are all those of the labelled rows outside fold 0, however rare; one that ``FAMILIES`` doesn't list is a family by
itself. The training sample is bounded for each language: ``ROWS_PER_LANGUAGE`` rows, fewer where there are many
languages, but ``LEAST_ROWS`` if a language has them. Of a long text, ``PIECES`` pieces spread over all of it are
learned, so texts of any length teach their language. A prediction reads the whole text and nothing else.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text if
nothing could be learned; with one learned language every other text is that, with score 1.
Repeated rows are predicted alike; a very long text is read whole by the task that has it; an empty table gives an empty
one. A column named like ``into`` is replaced, all others stay, whatever their names.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .arrays import LOWER, blocks
from .sampling import fold

UNKNOWN = "und"
#: Languages by family.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "hi", "mr", "ne", "pa", "ur"),
}
#: Rows of each language that are learned from: as many as make up ``SAMPLE_ROWS`` in all, within bounds.
SAMPLE_ROWS = 4000
ROWS_PER_LANGUAGE = 500
LEAST_ROWS = 10
#: Pieces of a long text, and their letters.
PIECES = 5
PIECE_CHARS = 1000
#: Besides them the machines learn a small piece, as short texts are the hard ones.
PIECE_BYTES = 80
#: Families or languages that meet one another at most.
FAN_OUT = 16
#: A machine has a weight for each place of a table, which is smaller where there are very many languages,
#: so that all machines together take about ``MODEL_BYTES``.
TABLE_BITS = 13
LEAST_BITS = 8
MODEL_BYTES = 64 << 20
STEPS = 150
PENALTY = 1e-4

PREDICTED = "lang string, family string, score double"

#: a-z and all beyond ASCII as they are, everything else a space
LETTERS = LOWER.copy()
LETTERS[:128][~np.isin(LOWER[:128], np.arange(ord("a"), ord("z") + 1))] = 32


@dataclass
class Machines:
    """Linear machines between pairs of names: positive is the first of the pair."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    biases: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def decide(self, counts: np.ndarray) -> tuple[str, float]:
        """The winner, and the least margin by which it won."""
        if len(self.names) == 1:
            return self.names[0], np.inf
        margins = counts @ self.weights / max(1, counts.sum()) + self.biases
        wins, sums = np.zeros(len(self.names)), np.zeros(len(self.names))
        for (a, b), m in zip(self.pairs, margins):
            wins[a if m > 0 else b] += 1
            sums[a] += m
            sums[b] -= m
        best = max(range(len(self.names)), key=lambda i: (wins[i], sums[i], -i))
        own = [m if a == best else -m for (a, b), m in zip(self.pairs, margins) if best in (a, b)]
        return self.names[best], float(min(own))


@dataclass
class Node:
    """Machines between groups of languages, and what is below each group: a node, or a language."""

    machines: Machines
    below: dict[str, "Node | str"]

    def decide(self, counts: np.ndarray) -> tuple[str, float]:
        name, margin = self.machines.decide(counts)
        below = self.below[name]
        if isinstance(below, str):
            return below, margin
        lang, inner = below.decide(counts)
        return lang, min(margin, inner)


@dataclass
class LanguageModel:
    root: Node | None
    bits: int = TABLE_BITS

    def predict(self, data: np.ndarray) -> dict:
        if self.root is None:
            return {"lang": UNKNOWN, "family": UNKNOWN, "score": 0.0}
        lang, margin = self.root.decide(run_counts(data, self.bits))
        return {"lang": lang, "family": family_of(lang), "score": float(1 / (1 + np.exp(-2 * min(margin, 30.0))))}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang.lower().split("-")[0] in langs), lang)


def run_counts(data: np.ndarray, bits: int) -> np.ndarray:
    """Counts by table place of each run of three bytes of one text, with a space before and after."""
    padded = np.concatenate([[32], data, [32]]).astype(np.uint8)
    letters = LETTERS[padded].astype(np.uint32)
    runs = letters[:-2] << 16 | letters[1:-1] << 8 | letters[2:]
    return np.bincount((runs * np.uint32(2654435761)) >> np.uint32(32 - bits), minlength=1 << bits)


def fit_machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by gradient steps with momentum; ``y`` is 1 or -1.
    Both sides weigh the same, whatever their sizes. The weights are a sum of rows: with fewer rows than
    steps it is the rows' shares that are moved, which takes their products only."""
    few = len(x) < 2 * STEPS
    seen = x @ x.T if few else x  # what gives the margins out of shares, or out of weights
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()).astype(np.float32)
    w, ahead, b, b_ahead = np.zeros(seen.shape[1], np.float32), np.zeros(seen.shape[1], np.float32), 0.0, 0.0
    reach = float((weight * (x**2).sum(axis=1)).sum()) + 1
    for step in range(STEPS):
        slack = np.maximum(0, 1 - y * (seen @ ahead + b_ahead)) * y * weight
        new = ahead + (2 * (slack if few else x.T @ slack) - PENALTY * ahead) / (2 * reach)
        b_new = b_ahead + 2 * slack.sum() / (2 * reach)
        push = step / (step + 3)
        ahead, b_ahead = new + push * (new - w), b_new + push * (b_new - b)
        w, b = new, b_new
    return (x.T @ w if few else w), b


def fit_machines(x: np.ndarray, names_of: np.ndarray, scale: np.ndarray) -> Machines:
    names = sorted(set(names_of.tolist()))
    m = Machines(names, list(combinations(range(len(names)), 2)))
    columns, biases = [], []
    for a, b in m.pairs:
        use = (names_of == names[a]) | (names_of == names[b])
        w, bias = fit_machine(x[use], np.where(names_of[use] == names[a], 1, -1).astype(np.float32))
        columns.append((w * scale).astype(np.float32))
        biases.append(bias)
    if columns:
        m.weights, m.biases = np.stack(columns, axis=1), np.array(biases)
    return m


def like_groups(centres: np.ndarray, most: int) -> list[list[int]]:
    """Rows in at most ``most`` groups of like ones: the largest group is cut in two across its
    longest direction, again and again."""
    groups = [list(range(len(centres)))]
    while len(groups) < most and len(max(groups, key=len)) > 1:
        group = max(groups, key=len)
        part = centres[group] - centres[group].mean(axis=0)
        direction = np.linalg.eigh(part @ part.T)[1][:, -1]
        order = np.argsort(direction, kind="stable")
        half = len(group) // 2
        groups.remove(group)
        groups += [sorted(group[i] for i in order[:half]), sorted(group[i] for i in order[half:])]
    return sorted(groups)


def fit_node(groups: list[list[str]], x: np.ndarray, langs: np.ndarray, scale: np.ndarray) -> Node:
    """Groups of languages against one another, and the languages of each group among themselves."""
    if len(groups) > FAN_OUT:
        centres = np.stack([x[np.isin(langs, g)].mean(axis=0) for g in groups])
        bundles = [[groups[i] for i in bundle] for bundle in like_groups(centres, FAN_OUT)]
    else:
        bundles = [[g] for g in groups]
    name_of = {lang: bundle[0][0] for bundle in bundles for g in bundle for lang in g}
    here = np.isin(langs, list(name_of))
    machines = fit_machines(x[here], np.array([name_of[lang] for lang in langs[here].tolist()]), scale)
    below: dict[str, Node | str] = {}
    for bundle in bundles:
        inner = bundle if len(bundle) > 1 else [[lang] for lang in bundle[0]]
        below[bundle[0][0]] = inner[0][0] if len(inner) == 1 else fit_node(inner, x, langs, scale)
    return Node(machines, below)


def table_bits(n_languages: int) -> int:
    """Of ``FAN_OUT`` that meet, each has about half as many machines."""
    machines = max(1, n_languages) * FAN_OUT // 2
    bits = TABLE_BITS
    while bits > LEAST_BITS and machines * (4 << bits) > MODEL_BYTES:
        bits -= 1
    return bits


def fit(sample: list[tuple[str, str]]) -> LanguageModel:
    """From pairs of text and language."""
    if not sample:
        return LanguageModel(None)
    names = sorted({lang for _, lang in sample})
    bits = table_bits(len(names))
    rows, langs = [], []
    for text, lang in sample:
        data = np.frombuffer(text.encode(), np.uint8)
        middle = max(0, len(data) // 2 - PIECE_BYTES // 2)
        for part in (data, data[middle : middle + PIECE_BYTES]):
            counts = run_counts(part, bits)
            rows.append((counts / counts.sum()).astype(np.float32))
            langs.append(lang)
    x, langs = np.stack(rows), np.array(langs, dtype=object).astype(str)
    scale = (1 / np.sqrt(x.mean(axis=0) + 1e-6)).astype(np.float32)
    x *= scale
    families: dict[str, list[str]] = {}
    for lang in names:
        families.setdefault(family_of(lang), []).append(lang)
    return LanguageModel(fit_node([families[f] for f in sorted(families)], x, langs, scale), bits)


def spread_pieces(text: Column) -> Column:
    """The letters of a text; of a long one, pieces that are spread evenly over all of it."""
    letters = F.trim(F.regexp_replace(text, r"[^\p{L}]+", " "))
    n = F.length(letters)
    starts = ((n - PIECE_CHARS) * k / (PIECES - 1) + 1 for k in range(PIECES))
    pieces = F.concat_ws(" ", *(F.substring(letters, F.floor(s).cast("int"), F.lit(PIECE_CHARS)) for s in starts))
    return F.when(n > PIECES * PIECE_CHARS, pieces).otherwise(letters)


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """A model from labelled rows outside fold 0, the same in every run."""
    labelled = docs.where(fold(id_column) > 0).where(F.col(lang_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    )
    part = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    usable = labelled.where(F.col("text").rlike(r"\p{L}")).withColumn("order", part)
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("order").alias("least"))
    n_languages = counts.count()
    if not n_languages:
        return fit([])
    most = max(LEAST_ROWS, min(ROWS_PER_LANGUAGE, SAMPLE_ROWS // n_languages))
    # of a language with many rows about twice as many as needed by hash, then exactly those with the smallest
    # hashes; of equal rows, tasks pass on no more than are wanted
    near = usable.join(F.broadcast(counts), "lang")
    early = F.col("order") < 2.0 * most / F.col("n") * (1 << 30)
    near = near.where((F.col("n") <= 4 * most) | early | (F.col("order") == F.col("least")))
    near = near.select("lang", "order", "id", spread_pieces(F.col("text")).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id", "text"))
    sample = near.withColumn("place", place).where(F.col("place") <= most).select("lang", "id", "text").collect()
    return fit([(r.text, r.lang) for r in sorted(sample, key=lambda r: (r.lang, r.id, r.text))])


def predict(text: Column, model) -> Column:
    """A struct ``PREDICTED`` per text; ``model`` is a broadcast LanguageModel."""
    kind = to_arrow_type(StructType.fromDDL(PREDICTED))

    @F.arrow_udf(PREDICTED)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [
                model.value.predict(data[a:b])
                for data, offsets in blocks(batch)
                for a, b in zip(offsets[:-1], offsets[1:])
            ]
            yield pa.array(rows, kind)

    return compute(text)


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into``: ``lang``, ``family`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about MODEL_BYTES
    has_letter = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False))
    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(UNKNOWN).alias("family"), F.lit(0.0).alias("score"))
    return docs.withColumn(into, F.when(has_letter, predict(F.col(text_column), shared)).otherwise(nothing))

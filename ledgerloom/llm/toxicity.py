"""Toxic spans by a linear-chain conditional random field (CRF).

Two tags, clean and toxic, over the words of a text. A word's emission is the sum of the weights
of its hashed form and hashed beginnings, which carry over to inflected forms never seen;
transition weights make toxic words draw in their neighbours. Forward-backward gives each
word's marginal; marginals over one half make up the offending spans, and their maximum
and sum, calibrated on labelled documents, make up the score of the document.

Labels come by document, so the labelled tokens are made from them: in a toxic document a token is
toxic if its form or beginning is found in far more toxic than clean documents of the training
sample (likelihood ratio over ``MIN_G2``). The sample is bounded by ``SAMPLE``,
``MAX_CHARS`` and never holds rows of fold 0. Scoring reads only the text.

With two tags the recursions are about one number a word, its log-odds. All words are
updated at once, then only those whose neighbour moved, until nothing moves.

Defined results: null, empty and word-less texts have the score of a text without toxic words and no
spans; a word that repeats the one before counts once, its span ends behind the last copy. Without labelled rows of both kinds every text gets the share of toxic rows (0
without any). Repeated rows are scored alike; a very long text is scored whole by the task that has it; an empty table gives
an empty one; a column named like ``into`` is replaced, other columns stay, whatever their names.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .arrays import ALPHANUMERIC, LOWER, blocks, span_hashes, spread, word_bounds
from .names import fresh
from .sampling import fold, labelled_sample

#: Rows of the training sample by label, and the longest text in it.
SAMPLE = {0: 2500, 1: 1000}
MAX_CHARS = 8000
#: For a form or beginning to mark tokens as toxic: documents, likelihood ratio, ratio of rates.
MIN_DOCS, MIN_G2, MIN_RATIO = 5, 25.0, 20.0
PREFIX_BYTES = (4, 5, 6, 8)
TABLE_BITS = 18
EPOCHS = 50
RATE = 1.0
DECAY = 1e-4
SETTLED = 1e-6
LIMIT = 30.0

SCORED = "score double, spans array<struct<start: int, end: int, score: double>>"


@dataclass
class Crf:
    """Log weights, relative to the tag clean and the step from clean to clean."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << TABLE_BITS, np.float32))
    bias: float = -3.0
    enter: float = 0.0
    leave: float = 0.0
    stay: float = 0.0
    #: Of the document's logit: constant, by the largest marginal's log-odds, by the log sum of marginals.
    document: tuple[float, float, float] = (-LIMIT, 0.0, 0.0)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, start and end of each word, its row, and the end of its last repeat. A word
    that repeats the one before is left out: it says nothing new and would add up along the chain."""
    lowered = LOWER[data]
    starts, ends = word_bounds(lowered, offsets, ALPHANUMERIC)
    row = np.searchsorted(offsets, starts, "right") - 1
    hashes = span_hashes(lowered, starts, ends)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(starts))[: int(new.sum())] - 1
    return lowered, starts[new], ends[new], row[new], ends[last]


def token_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Table places of each word's form and beginnings: (kinds, words)."""
    shift = np.uint64(64 - TABLE_BITS)
    out = np.empty((1 + len(PREFIX_BYTES), len(starts)), dtype=np.int32)
    for kind, size in enumerate((None, *PREFIX_BYTES)):
        stop = ends if size is None else np.minimum(starts + size, ends)
        salted = span_hashes(data, starts, stop) + np.uint64(kind * 0x51_7C_C1_B7 + 1)
        out[kind] = spread(salted) >> shift
    return out


def settle(values: np.ndarray, step, reach: int, bound: np.ndarray) -> np.ndarray:
    """The recursion ``values[t] = step(t, values[t - reach])`` for all t that are not at a bound."""
    active = np.flatnonzero(~bound)
    while len(active):
        new = step(active, values[active - reach])
        moved = active[np.abs(new - values[active]) > SETTLED]
        values[active] = new
        after = moved + reach
        after = after[(after >= 0) & (after < len(values))]
        active = after[~bound[after]]
    return values


def odds(x: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(x, -LIMIT, LIMIT))


def forward_backward(emission: np.ndarray, first: np.ndarray, last: np.ndarray, m: Crf) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of toxic against clean by what stands up to each word, and by what follows."""
    enter, leave, stay = np.exp([m.enter, m.leave, m.stay])

    def onward(t, before):
        u = odds(before)
        return emission[t] + np.log((enter + stay * u) / (1 + leave * u))

    def back(t, after):
        u = odds(emission[t + 1] + after)
        return np.log((leave + stay * u) / (1 + enter * u))

    ahead = settle(emission + m.enter, onward, 1, first)
    behind = settle(np.zeros_like(emission), back, -1, last)
    return ahead, behind


def marginals(emission, first, last, m: Crf) -> np.ndarray:
    """Log-odds of each word being toxic."""
    ahead, behind = forward_backward(emission, first, last, m)
    return np.clip(ahead + behind, -LIMIT, LIMIT)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -LIMIT, LIMIT)))


def row_edges(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    change = np.flatnonzero(np.diff(row)) + 1
    first = np.zeros(len(row), dtype=bool)
    last = np.zeros(len(row), dtype=bool)
    if len(row):
        first[0] = last[-1] = True
    first[change] = True
    last[change - 1] = True
    return first, last


def evidence(logits: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row: 1, the largest log-odds, the log of 1 plus the sum of the marginals over one
    half. The many small ones are left out: their sum grows with the text alone."""
    most = np.full(n_rows, -LIMIT)
    np.maximum.at(most, row, logits)
    total = np.bincount(row, np.where(logits >= 0, sigmoid(logits), 0), n_rows)
    return np.stack([np.ones(n_rows), most / 10, np.log1p(total)], axis=1)


def toxic_places(features: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which table places mark a token as toxic, by document frequency."""
    size = 1 << TABLE_BITS
    marks = np.zeros(size, dtype=bool)
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    for places in features:
        pairs = np.unique(row.astype(np.int64) * size + places)
        in_toxic = toxic[pairs // size]
        k1 = np.bincount(pairs[in_toxic] % size, minlength=size).astype(float)
        k0 = np.bincount(pairs[~in_toxic] % size, minlength=size).astype(float)
        share = (k1 + k0) / (n1 + n0)
        with np.errstate(divide="ignore", invalid="ignore"):
            g2 = 2 * (np.where(k1 > 0, k1 * np.log(k1 / (n1 * share)), 0) + np.where(k0 > 0, k0 * np.log(k0 / (n0 * share)), 0))
        ratio = (k1 / max(n1, 1)) / ((k0 + 0.5) / max(n0, 1))
        marks |= (k1 >= MIN_DOCS) & (g2 >= MIN_G2) & (ratio >= MIN_RATIO)
    return marks


def fit_crf(features, labels, first, last) -> Crf:
    """Maximum likelihood by AdaGrad over all tokens at once."""
    m, size = Crf(), 1 << TABLE_BITS
    squares, small = np.full(size, 1e-6), np.full(4, 1e-6)
    y = labels.astype(float)
    inner = np.flatnonzero(~first)
    pairs = [(y[inner] * (1 - y[inner - 1])).sum() + y[first].sum(), ((1 - y[inner]) * y[inner - 1]).sum(), (y[inner] * y[inner - 1]).sum()]
    n = max(1.0, y.sum())
    for _ in range(EPOCHS):
        emission = m.bias + sum(m.weights[p] for p in features).astype(float)
        ahead, behind = forward_backward(emission, first, last, m)
        p = sigmoid(ahead + behind)
        miss = y - p
        slope = sum(np.bincount(places, miss, size) for places in features) / n - DECAY * m.weights
        squares += slope**2
        here, before = emission[inner] + behind[inner], ahead[inner - 1]
        w = np.stack([odds(m.enter + here), odds(before + m.leave), odds(before + m.stay + here)])
        expected = (w / (1 + w.sum(axis=0))).sum(axis=1)
        expected[0] += p[first].sum()
        steps = np.array([miss.sum(), *(np.array(pairs) - expected)]) / n - DECAY * np.array([m.bias, m.enter, m.leave, m.stay])
        small += steps**2
        m.weights = (m.weights + RATE * slope / np.sqrt(squares)).astype(np.float32)
        m.bias, m.enter, m.leave, m.stay = np.array([m.bias, m.enter, m.leave, m.stay]) + RATE * steps / np.sqrt(small)
    return m


def fit_document(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton's method. A measure that would count against
    toxicity is left out."""
    b = np.zeros(3)
    for used in ([0, 1, 2], [0, 2], [0, 1]):
        b, part = np.zeros(3), x[:, used]
        ridge = np.diag([1e-6, *[1e-2] * (len(used) - 1)])
        for _ in range(30):
            p = sigmoid(x @ b)
            slope = part.T @ (weight * (toxic - p)) - ridge @ b[used]
            bend = (part * (weight * p * (1 - p))[:, None]).T @ part + ridge
            step = np.clip(np.linalg.solve(bend, slope), -3, 3)
            b[used] += step
            if np.abs(step).max() < 1e-6:
                break
        if b[1:].min() >= 0:
            break
    return tuple(b)


def copies(lowered: np.ndarray, starts, ends, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Rows that look like a near copy of an earlier one: of three smallest hashes of their
    five-word runs one is the same. Copies would count one document's rare words many times."""
    out = np.zeros(n_rows, dtype=bool)
    at = np.arange(max(0, len(starts) - 4))
    at = at[row[at] == row[at + 4]]
    if not len(at):
        return out
    runs = span_hashes(spread(span_hashes(lowered, starts, ends)), at, at + 5)
    there, begins = np.unique(row[at], return_index=True)
    for salt in (1, 2, 3):
        least = np.minimum.reduceat(spread(runs + np.uint64(salt * 0x2545F4914F6CDD1D)), begins)
        _, originals = np.unique(least, return_index=True)
        out[np.delete(there, originals)] = True
    return out


def fit(sample: list[tuple[str, int]], shares: dict[int, float]) -> Crf:
    """A CRF from labelled texts; ``shares`` are the labels' shares among all labelled rows."""
    toxic = np.array([y == 1 for _, y in sample], dtype=bool)
    if not toxic.any() or toxic.all():
        share = min(max(shares.get(1, 0.0), 1e-12), 1 - 1e-12)
        return Crf(document=(float(np.log(share / (1 - share))), 0.0, 0.0))
    # the sample is bounded, so it is one block
    texts = pa.array([t for t, _ in sample], pa.large_string())
    ((data, offsets),) = blocks(texts, limit=1 << 62)
    data, starts, ends, row, _ = tokens(data, offsets)
    own = ~copies(data, starts, ends, row, len(sample))
    row_kept = own[row]
    features = token_features(data, starts, ends)[:, row_kept]
    row, toxic = (np.cumsum(own) - 1)[row[row_kept]], toxic[own]
    marks = toxic_places(features, row, toxic)
    labels = toxic[row] & np.logical_or.reduce([marks[p] for p in features])
    # a toxic document without a marked token teaches the chain nothing
    taught = ~toxic
    taught[row[labels]] = True
    use = taught[row]
    first, last = row_edges(row[use])
    m = fit_crf(features[:, use], labels[use], first, last)
    emission = m.bias + sum(m.weights[p] for p in features).astype(float)
    x = evidence(marginals(emission, *row_edges(row), m), row, len(toxic))
    weight = np.where(toxic, shares[1] / max(1, toxic.sum()), shares[0] / max(1, (~toxic).sum())) * len(toxic)
    m.document = fit_document(x, toxic.astype(float), weight)
    return m


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE, max_chars: int = MAX_CHARS) -> Crf:
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in labels.where(fold() > 0).where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    total = max(1, sum(counts.values()))
    return fit(labelled_sample(docs, labels, "toxic", sample, max_chars), {k: v / total for k, v in counts.items()})


def score_block(data: np.ndarray, offsets: np.ndarray, m: Crf) -> Iterator[dict]:
    n_rows = len(offsets) - 1
    lowered, starts, ends, row, repeated_to = tokens(data, offsets)
    emission = np.full(len(starts), m.bias)
    for places in token_features(lowered, starts, ends):
        emission += m.weights[places]
    logits = marginals(emission, *row_edges(row), m)
    scores = sigmoid(evidence(logits, row, n_rows) @ np.array(m.document))
    spans: dict[int, list[dict]] = {}
    toxic = np.flatnonzero(logits >= 0)
    if len(toxic):
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        breaks = np.flatnonzero((np.diff(toxic) > 1) | (np.diff(row[toxic]) > 0)) + 1
        for run in np.split(toxic, breaks):
            r = int(row[run[0]])
            origin = chars[offsets[r]]
            spans.setdefault(r, []).append(
                {
                    "start": int(chars[starts[run[0]]] - origin),
                    "end": int(chars[repeated_to[run[-1]]] - origin),
                    "score": float(sigmoid(logits[run].max())),
                }
            )
    for r in range(n_rows):
        yield {"score": float(scores[r]), "spans": spans.get(r, [])}


def score_toxicity(docs: DataFrame, model: Crf, text_column: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``into``: the document's ``score`` and the offending
    ``spans``, in code points, the end excluded."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is set by TABLE_BITS
    kind = to_arrow_type(StructType.fromDDL(SCORED))

    @F.arrow_udf(SCORED)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [r for data, offsets in blocks(batch) for r in score_block(data, offsets, shared.value)]
            yield pa.array(rows, kind)

    return docs.withColumn(into, compute(F.col(text_column)))


def drop_toxic(docs: DataFrame, model: Crf, least: float = 0.5, text_column: str = "text") -> DataFrame:
    """``docs`` without those that score ``least`` or more."""
    scored = fresh(docs, "_toxicity")
    return score_toxicity(docs, model, text_column, into=scored).where(F.col(f"{scored}.score") < least).drop(scored)

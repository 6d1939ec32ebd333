"""Text quality by a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins. Boosting goes round the features in turn and
fits a shallow tree to the gradient on one feature's bins, a small step that is added
to that feature's table; then the same for the pairs of features that promise most, on
tables of two bins. After training only the tables are left: a score is the sum of one
cell of each, then a logistic curve."""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.llm.common import bounded_sample, segment_sums, sigmoid

#: The kinds of bytes that are counted.
KINDS = {
    "symbols": b"#*$%&|<>",
    "capitals": bytes(range(65, 91)),
    "digits": b"0123456789",
    "marks": b"!?",
    "stops": b".,;:'\"()-",
    "lines": b"\n",
    "other": bytes(range(128, 256)),
}
FEATURES = (*KINDS, "size", "word_size", "distinct", "top", "repeat", "line_repeat", "line_size", "sentence")


def features(texts: list[str]) -> np.ndarray:
    """One row of features per text."""
    bodies = [text.encode() for text in texts]
    lengths = [len(body) for body in bodies]
    flat = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    rows = np.zeros((len(texts), len(FEATURES)))
    total = np.maximum(lengths, 1)
    for column, members in enumerate(KINDS.values()):
        counted = np.zeros(256, dtype=np.uint8)
        counted[list(members)] = 1
        rows[:, column] = segment_sums(counted[flat], lengths) / total
    for row, body in enumerate(bodies):
        words = body.split()
        n = len(words)
        lines = [line for line in body.split(b"\n") if line.strip()]
        repeats = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
        counts = Counter(words)
        rows[row, len(KINDS) :] = (
            np.log1p(n),
            sum(map(len, words)) / max(n, 1),
            len(counts) / max(n, 1),
            max(counts.values(), default=0) / max(n, 1),
            repeats / max(n, 1),
            1 - len(set(lines)) / max(len(lines), 1),
            np.log1p(n / max(len(lines), 1)),
            body.count(b". ") / max(n, 1),
        )
    return rows


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample and of training."""

    per_label: int = 3000  #: sampled texts of each label
    max_chars: int = 20_000  #: longest text that is sampled
    bins: int = 24
    rounds: int = 160
    pair_rounds: int = 40
    pairs: int = 6
    pair_bins: int = 8
    rate: float = 0.1
    ridge: float = 5.0


@dataclass
class AdditiveModel:
    """Bin edges per feature, a table per feature, and tables of pairs."""

    edges: list[np.ndarray]
    tables: np.ndarray
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray
    start: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for column, (edges, cells) in enumerate(zip(self.edges, self.tables)):
            total += cells[np.searchsorted(edges, rows[:, column], side="right")]
        for (a, b), cells in zip(self.pairs, self.pair_tables):
            i = np.searchsorted(self.pair_edges[a], rows[:, a], side="right")
            j = np.searchsorted(self.pair_edges[b], rows[:, b], side="right")
            total += cells[i, j]
        return sigmoid(total)


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, weight: np.ndarray, ridge: float, depth: int = 2) -> np.ndarray:
    """A value per bin from a tree of this depth on the bins."""
    values = np.zeros(len(gradient))

    def grow(lo: int, hi: int, left: int) -> None:
        g, h = gradient[lo:hi], weight[lo:hi]
        whole = g.sum() / (h.sum() + ridge)
        if left and hi - lo > 1:
            cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
            gain = cg**2 / (ch + ridge) + (g.sum() - cg) ** 2 / (h.sum() - ch + ridge)
            cut = int(np.argmax(gain))
            if gain[cut] > g.sum() ** 2 / (h.sum() + ridge) + 1e-9:
                grow(lo, lo + cut + 1, left - 1)
                grow(lo + cut + 1, hi, left - 1)
                return
        values[lo:hi] = whole

    grow(0, len(gradient), depth)
    return values


def _quadrants(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """The best cut of a table in two by two, its values and its gain."""
    cg, ch = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    if min(gradient.shape) < 2:
        return np.zeros_like(gradient), 0.0
    corner = [(cg[:-1, :-1], ch[:-1, :-1])]
    corner.append((cg[:-1, -1:] - cg[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1]))
    corner.append((cg[-1:, :-1] - cg[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1]))
    rest_g = cg[-1, -1] - cg[:-1, -1:] - cg[-1:, :-1] + cg[:-1, :-1]
    rest_h = ch[-1, -1] - ch[:-1, -1:] - ch[-1:, :-1] + ch[:-1, :-1]
    corner.append((rest_g, rest_h))
    gain = sum(g**2 / (h + ridge) for g, h in corner)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = np.zeros_like(gradient)
    parts = [(slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None))]
    parts += [(slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))]
    for place, (g, h) in zip(parts, corner):
        values[place] = g[i, j] / (h[i, j] + ridge)
    return values, float(gain[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + ridge))


def train(rows: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> AdditiveModel:
    """Tables from feature rows and labels 0 or 1; without rows every score is 0.5."""
    columns = len(FEATURES)
    if not len(rows):
        none = [np.zeros(0)] * columns
        return AdditiveModel(none, np.zeros((columns, 1)), none, [], np.zeros((0, 1, 1)), 0.0)
    edges = [_edges(rows[:, c], settings.bins) for c in range(columns)]
    pair_edges = [_edges(rows[:, c], settings.pair_bins) for c in range(columns)]
    binned = np.stack([np.searchsorted(edges[c], rows[:, c], side="right") for c in range(columns)])
    coarse = np.stack([np.searchsorted(pair_edges[c], rows[:, c], side="right") for c in range(columns)])
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = float(np.log(share / (1 - share)))
    tables = np.zeros((columns, settings.bins))
    total = np.full(len(rows), start)
    for _ in range(settings.rounds):
        for c in range(columns):
            chance = sigmoid(total)
            g = np.bincount(binned[c], labels - chance, settings.bins)
            h = np.bincount(binned[c], chance * (1 - chance), settings.bins)
            step = settings.rate * _tree(g, h, settings.ridge)
            tables[c] += step
            total += step[binned[c]]

    side = settings.pair_bins
    cells = {(a, b): coarse[a] * side + coarse[b] for a, b in combinations(range(columns), 2)}

    def cut(pair: tuple[int, int]) -> tuple[np.ndarray, float]:
        chance = sigmoid(total)
        g = np.bincount(cells[pair], labels - chance, side * side).reshape(side, side)
        h = np.bincount(cells[pair], chance * (1 - chance), side * side).reshape(side, side)
        return _quadrants(g, h, settings.ridge)

    pairs = sorted(cells, key=lambda pair: -cut(pair)[1])[: settings.pairs]
    pair_tables = np.zeros((len(pairs), side, side))
    for _ in range(settings.pair_rounds):
        for number, pair in enumerate(pairs):
            step = settings.rate * cut(pair)[0]
            pair_tables[number] += step
            total += step.ravel()[cells[pair]]
    return AdditiveModel(edges, tables, pair_edges, pairs, pair_tables, start)


def learn_quality(
    docs: DataFrame, labels: DataFrame | None = None, settings: Settings = Settings()
) -> AdditiveModel:
    """A model from (doc_id, text, quality) rows, or from (doc_id, text) rows and
    ``labels`` (doc_id, quality): at most ``per_label`` texts of up to
    ``max_chars`` characters for each label go to the driver. Rows without text or
    label teach nothing."""
    known = "quality IN (0, 1)"
    rows = docs.where("text IS NOT NULL")
    rows = rows.where(known).select("doc_id", "text", "quality") if labels is None else rows.select("doc_id", "text")
    labels = None if labels is None else labels.where(known)
    sample = bounded_sample(rows, "quality", settings.per_label, settings.max_chars, labels)
    marks = np.array([row["quality"] for row in sample], dtype=float)
    return train(features([row["text"] for row in sample]), marks, settings)


def scored(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """(doc_id, score) per row of ``docs``, from whole texts.

    A null text is scored as the empty one. Repeated rows come back repeated, an empty
    table gives no rows; other columns than doc_id and text are not read."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                found = model.scores(features([text or "" for text in part["text"].to_pylist()]))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found)], ["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches, schema)

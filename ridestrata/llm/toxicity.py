"""Toxicity by gradient-boosted trees over dense features.

The features of a text are densities: of a fixed lexicon and of stems that training
texts tie to the label, of hits near a second person, of obfuscated spellings, capitals
and marks. One automaton finds all words and stems in a pass. Shallow trees on their bins are boosted on a bounded
sample; isotonic regression on texts that each tree set has not seen turns their sums
into chances."""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.llm.common import bounded_sample, segment_sums, sigmoid

#: Common insults, and words of the second person.
INSULTS = """
    idiot idiots idiotic stupid moron morons trash scum loser losers clown pathetic worthless disgusting
    dumb fool jerk garbage ugly vermin filth filthy liar hate shut crap damn dumm blöd dumme dummkopf
    abschaum arschloch imbécile débile stupide connard idiote estúpido tonto imbécil basura
""".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton vous votre usted ustedes tú vosotros".split()
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""}

WORDS = re.compile(r"[^\W_]+")
DISGUISED = re.compile(r"(?<![^\W_])[^\W\d_]++(?:[0134570@$!*]++[^\W\d_]++)+")
PLAIN = str.maketrans(DISGUISES)

COUNTED = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!?", b"*#$%&@", b"0123456789")
FEATURES = (
    "lexicon", "lexicon_share", "strong", "strong_share", "weak", "weak_share", "near_second", "second_share",
    "disguised_hits", "disguised_share", "capitals", "exclaims", "symbols", "digits", "size",
)
LEXICON, STRONG, WEAK, SECOND = range(4)


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample and of training."""

    per_label: int = 2500  #: sampled texts of each label
    max_chars: int = 20_000  #: longest text that is sampled
    stems: int = 80  #: learned stems
    shortest: int = 3  #: characters of a stem
    longest: int = 9
    odds: float = 8.0  #: how much likelier a learned stem is in toxic texts
    strong: float = 50.0  #: from these odds on a stem counts as strong
    share: float = 0.015  #: of the toxic texts that hold it, at least
    bins: int = 32
    trees: int = 80
    depth: int = 3
    rate: float = 0.15
    ridge: float = 2.0
    folds: int = 4


def stems_of(text: str, settings: Settings) -> frozenset[str]:
    """The beginnings of a text's words."""
    stems: set[str] = set()
    for word in set(WORDS.findall(text.lower())):
        stems.update(word[:n] for n in range(settings.shortest, min(len(word), settings.longest) + 1))
    return frozenset(stems)


def learned_stems(stems: list[frozenset[str]], labels: np.ndarray, settings: Settings) -> dict[str, int]:
    """Beginnings of words that many toxic texts hold and few others, as strong or
    weak; texts with equal stems count once. A stem that begins with one already taken
    is left out."""
    seen = (Counter(), Counter())
    sizes = [0, 0]
    for own, label in dict(zip(stems, labels.astype(int).tolist())).items():
        sizes[label] += 1
        seen[label].update(own)
    if not min(sizes):
        return {}
    found = []
    for stem, n in seen[1].items():
        share, other = n / sizes[1], (seen[0][stem] + 0.5) / sizes[0]
        if n >= 3 and share >= settings.share and share / other >= settings.odds:
            found.append((-n * np.log(share / other), -len(stem), stem, share / other))
    taken: dict[str, int] = {}
    for _, _, stem, odds in sorted(found):
        if len(taken) < settings.stems and not any(stem.startswith(other) for other in taken):
            taken[stem] = STRONG if odds >= settings.strong else WEAK
    return taken


class Finder:
    """Where the words of the lexicon, second persons and learned stems occur."""

    def __init__(self, stems: dict[str, int]):
        self.stems = stems
        self._build()

    def _build(self) -> None:
        entries: dict[str, list[tuple[int, bool]]] = {}
        for words, kind in ((INSULTS, LEXICON), (SECOND_PERSON, SECOND)):
            for word in words:
                entries.setdefault(word, []).append((kind, True))
        for stem, kind in self.stems.items():
            entries.setdefault(stem, []).append((kind, False))
        self.automaton = ahocorasick.Automaton()
        for word, kinds in entries.items():
            self.automaton.add_word(word, (len(word), kinds))
        self.automaton.make_automaton()

    def __getstate__(self):
        return {"stems": self.stems}

    def __setstate__(self, state):
        self.stems = state["stems"]
        self._build()

    def hits(self, lower: str) -> list[tuple[int, int]]:
        """(kind, place) of each hit that begins a word; those of whole words end one."""
        found, size = [], len(lower)
        for last, (length, kinds) in self.automaton.iter(lower):
            first = last - length + 1
            if first and lower[first - 1].isalnum():
                continue
            ends = last + 1 == size or not lower[last + 1].isalnum()
            found += [(kind, first) for kind, whole in kinds if ends or not whole]
        return found


NEAR = 24  #: characters between a hit and a second person beside it


def features(texts: list[str], finder: Finder) -> np.ndarray:
    """One row of features per text."""
    rows = np.zeros((len(texts), len(FEATURES)))
    bodies = [text.encode() for text in texts]
    lengths = [len(body) for body in bodies]
    flat = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    for column, members in enumerate(COUNTED):
        counted = np.zeros(256, dtype=np.uint8)
        counted[list(members)] = 1
        rows[:, 10 + column] = segment_sums(counted[flat], lengths) / np.maximum(lengths, 1)
    for row, text in enumerate(texts):
        lower = text.lower()
        words = len(text.split())
        n = max(words, 1)
        hits = finder.hits(lower)
        counts = Counter(kind for kind, _ in hits)
        second = np.array([place for kind, place in hits if kind == SECOND])
        near = 0
        if len(second):
            toxic = np.array([place for kind, place in hits if kind in (LEXICON, STRONG)])
            if len(toxic):
                after = np.searchsorted(second, toxic)
                ahead = np.abs(second[np.minimum(after, len(second) - 1)] - toxic)
                behind = np.abs(second[np.maximum(after - 1, 0)] - toxic)
                near = int((np.minimum(ahead, behind) <= NEAR).sum())
        disguised = DISGUISED.findall(lower)
        meant = sum(1 for word in disguised if finder.hits(word.translate(PLAIN)))
        found = [counts[kind] for kind in (LEXICON, STRONG, WEAK)]
        shares = [value for count in found for value in (count, count / n)]
        rows[row, :10] = (*shares, near, counts[SECOND] / n, meant, len(disguised) / n)
        rows[row, 14] = np.log1p(words)
    return rows


@dataclass
class Trees:
    """Boosted trees as arrays: the feature and the edge of each inner node, and the
    leaf values, tree after tree; children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray
    edge: np.ndarray
    leaf: np.ndarray
    start: float

    def sums(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        for feature, edge, leaf in zip(self.feature, self.edge, self.leaf):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (rows[every, feature[node]] > edge[node])
            total += leaf[node - len(feature)]
        return total


def boost(rows: np.ndarray, labels: np.ndarray, settings: Settings) -> Trees:
    """Trees fitted one after the other to the gradient of the log loss."""
    inner, leaves = 2**settings.depth - 1, 2**settings.depth
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = float(np.log(share / (1 - share)))
    # Edges lie between values that occur, so few distinct values keep all their cuts.
    edges = []
    for column in rows.T:
        values = np.unique(column)
        cuts = (values[1:] + values[:-1]) / 2
        edges.append(cuts if len(cuts) < settings.bins else np.unique(np.quantile(column, np.linspace(0, 1, settings.bins + 1)[1:-1])))
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, rows.T)], axis=1)
    total = np.full(len(rows), start)
    kept = ([], [], [])
    for _ in range(settings.trees):
        chance = sigmoid(total)
        gradient, weight = labels - chance, chance * (1 - chance)
        feature, edge = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), dtype=np.int64)
        for place in range(inner):
            here = np.flatnonzero(node == place)
            best, cut = _split(binned[here], gradient[here], weight[here], settings)
            if best is not None:
                feature[place], edge[place] = best, edges[best][cut]
            node[here] = 2 * place + 1 + (rows[here, feature[place]] > edge[place])
        at = node - inner
        leaf = np.bincount(at, gradient, leaves) / (np.bincount(at, weight, leaves) + settings.ridge)
        leaf *= settings.rate
        total += leaf[at]
        for store, item in zip(kept, (feature, edge, leaf)):
            store.append(item)
    return Trees(*(np.array(item) for item in kept), start)


def _split(binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray, settings: Settings):
    """The feature and cut with the largest gain, or None."""
    best, place, gain = None, 0, 1e-6
    if len(binned) < 2:
        return best, place
    g_all, h_all = gradient.sum(), weight.sum()
    base = g_all**2 / (h_all + settings.ridge)
    for column in range(binned.shape[1]):
        bins = binned[:, column]
        size = int(bins.max()) + 1
        if size < 2:
            continue
        g = np.cumsum(np.bincount(bins, gradient, size))[:-1]
        h = np.cumsum(np.bincount(bins, weight, size))[:-1]
        found = g**2 / (h + settings.ridge) + (g_all - g) ** 2 / (h_all - h + settings.ridge) - base
        cut = int(np.argmax(found))
        if found[cut] > gain:
            best, place, gain = column, cut, found[cut]
    return best, place


def isotonic(sums: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the non-decreasing curve nearest to the labels: where each starts and
    its value, each pulled a little to the overall share. A small block is pulled further
    than its neighbours; it falls no lower than those before it. Scores join the steps by
    straight lines."""
    order = np.argsort(sums, kind="stable")
    blocks: list[list[float]] = []  # start, sum, count
    for x, y in zip(sums[order], labels[order]):
        if blocks and blocks[-1][0] == x:
            blocks[-1][1] += y
            blocks[-1][2] += 1
        else:
            blocks.append([x, y, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, y_last, n_last = blocks.pop()
            blocks[-1][1] += y_last
            blocks[-1][2] += n_last
    share = labels.mean()
    values = np.array([(b[1] + share) / (b[2] + 1) for b in blocks])
    return np.array([b[0] for b in blocks]), np.maximum.accumulate(values)


@dataclass
class ToxicityModel:
    finder: Finder
    trees: Trees | None
    starts: np.ndarray
    values: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(texts))
        sums = self.trees.sums(features(texts, self.finder))
        step = np.searchsorted(self.starts, sums, side="right") - 1
        # Between two steps the curve is drawn straight, so that scores keep their order.
        curve = np.interp(sums, self.starts, self.values)
        return np.clip(np.where(step < 0, self.values[0], curve), 0.0, 1.0)


def train(texts: list[str], labels: np.ndarray, settings: Settings = Settings()) -> ToxicityModel:
    """A model from texts and labels 0 or 1; without both kinds every score is 0."""
    if not len(texts) or labels.min() == labels.max():
        return ToxicityModel(Finder({}), None, np.zeros(1), np.zeros(1))
    stems = [stems_of(text, settings) for text in texts]
    finder = Finder(learned_stems(stems, labels, settings))
    # Stems and trees of a fold come from the other folds; equal texts share a fold.
    place = {text: number for number, text in enumerate(dict.fromkeys(texts))}
    fold = np.array([place[text] for text in texts]) % settings.folds
    held = np.zeros(len(texts))
    for number in range(settings.folds):
        inside = fold == number
        rest = [text for text, skip in zip(texts, inside) if not skip]
        if not inside.any() or not rest:
            continue
        outside = [found for found, skip in zip(stems, inside) if not skip]
        own = Finder(learned_stems(outside, labels[~inside], settings))
        trees = boost(features(rest, own), labels[~inside], settings)
        held[inside] = trees.sums(features([t for t, here in zip(texts, inside) if here], own))
    starts, values = isotonic(held, labels)
    return ToxicityModel(finder, boost(features(texts, finder), labels, settings), starts, values)


def learn_toxicity(
    docs: DataFrame, labels: DataFrame | None = None, settings: Settings = Settings()
) -> ToxicityModel:
    """A model from (doc_id, text, toxic) rows, or from (doc_id, text) rows and
    ``labels`` (doc_id, toxic): at most ``per_label`` texts of up to
    ``max_chars`` characters for each label go to the driver. Rows without text or
    label teach nothing."""
    known = "toxic IN (0, 1)"
    rows = docs.where("text IS NOT NULL")
    rows = rows.where(known).select("doc_id", "text", "toxic") if labels is None else rows.select("doc_id", "text")
    labels = None if labels is None else labels.where(known)
    sample = bounded_sample(rows, "toxic", settings.per_label, settings.max_chars, labels)
    return train([row["text"] for row in sample], np.array([float(row["toxic"]) for row in sample]), settings)


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) per row of ``docs``, from whole texts.

    A null text is scored as the empty one. Repeated rows come back repeated, an empty
    table gives no rows; other columns than doc_id and text are not read."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                found = model.scores([text or "" for text in part["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found)], ["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches, schema)

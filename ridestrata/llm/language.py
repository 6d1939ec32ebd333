"""Language identification by averaged hashed subword embeddings.

A word's subwords are its n-grams of two to four bytes, the ends of the word marked by
a space, each hashed into a table of embeddings. A text is the average embedding of all
its subwords, and a linear layer with softmax gives the languages. Embeddings and layer
are trained together by stochastic gradient descent on a bounded sample. As embedding
and layer are both linear, each bucket's contribution to each language is computed
once; a text then needs one look-up per subword. A temperature fitted on texts kept aside calibrates the
scores, and texts whose calibrated score is below a threshold are rejected."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridestrata.llm.common import bounded_sample, segment_sums, softmax

UNKNOWN = "und"
#: Bytes of lower-cased text: ASCII letters and all of other scripts stay, the rest are spaces.
LETTERS = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))

LANGUAGE = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample and of training."""

    per_language: int = 300  #: sampled texts of each language
    max_chars: int = 20_000  #: longest text that is sampled
    buckets: int = 1 << 15
    width: int = 12
    epochs: int = 5
    rate: float = 0.5
    aside: int = 5  #: one sampled text in so many calibrates
    reject_below: float = 0.5
    seed: int = 13


def subwords(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of all texts, text after text, and how many each has."""
    bodies = [text.lower().encode().translate(LETTERS) for text in texts]
    flat = np.frombuffer(b" " + b"    ".join(bodies) + b"     ", dtype=np.uint8)
    lengths = np.array([len(body) + 4 for body in bodies], dtype=np.int64)
    space, grams = flat == 32, flat.astype(np.uint32)
    n = len(flat) - 4
    found, valid = [], []
    for size in (2, 3, 4):
        grams = grams[: len(flat) - size + 1] | flat[size - 1 :].astype(np.uint32) << np.uint32(8 * (size - 1))
        mixed = (grams[:n] ^ np.uint32(size * 0x61C88647 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
        mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x85EBCA6B)
        found.append((mixed >> np.uint32(8)) % np.uint32(buckets))
        inner = np.zeros(n, dtype=bool)
        for place in range(1, size - 1):
            inner |= space[place : place + n]
        valid.append(~inner if size > 2 else ~(space[:n] & space[1 : 1 + n]))
    ids, ok = np.stack(found, axis=1), np.stack(valid, axis=1)
    # A text's subwords start at the space before it and end within the gap behind it.
    lengths = lengths[: len(texts)]
    total = int(lengths.sum())
    counts = segment_sums(ok[:total].sum(axis=1), lengths).astype(np.int64)
    return ids[:total][ok[:total]], counts


class LanguageModel:
    """``shares`` has each bucket's logits, ``offset`` the layer's, in the order of
    ``languages``."""

    def __init__(self, languages, shares, offset, temperature, settings: Settings):
        self.languages, self.shares, self.offset = languages, shares, offset
        self.temperature, self.settings = temperature, settings

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits per text and whether it has a letter."""
        found, counts = subwords(texts, self.settings.buckets)
        sums = segment_sums(self.shares[found], counts)
        letters = np.array([any(map(str.isalpha, text)) for text in texts], dtype=bool)
        return sums / np.maximum(counts, 1)[:, None] + self.offset, letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated score and rejection of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        logits, letters = self.logits(texts)
        chances = softmax(logits / self.temperature)
        best = chances.argmax(axis=1)
        score = np.where(letters, chances[np.arange(len(texts)), best], 0.0)
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
        return names, np.clip(score, 0.0, 1.0), ~letters | (score < self.settings.reject_below)


def _bags(texts: list[str], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text and their shares of all its subwords."""
    bags = []
    for text in texts:
        buckets, counts = np.unique(subwords([text], settings.buckets)[0], return_counts=True)
        bags.append((buckets, counts / max(counts.sum(), 1)))
    return bags


def train(texts: list[str], labels: list[str], settings: Settings = Settings()) -> LanguageModel:
    """A model from texts and their languages; without any it rejects everything."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((settings.buckets, 0)), np.zeros(0), 1.0, settings)
    rng = np.random.default_rng(settings.seed)
    # Short stretches of the texts teach the model to do with few words.
    short = []
    for text in texts:
        words = text.split()
        at = int(rng.integers(0, max(1, len(words))))
        short.append(" ".join(words[at : at + 6]))
    bags = _bags(texts + short, settings)
    target = np.array([languages.index(label) for label in labels] * 2)
    aside = np.arange(len(target)) % len(texts) % settings.aside == 0
    if aside.all():
        aside[:] = False
    table = rng.normal(0, 0.1, (settings.buckets, settings.width))
    layer, offset = np.zeros((settings.width, len(languages))), np.zeros(len(languages))
    learned = np.flatnonzero(~aside)
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        for i in rng.permutation(learned):
            buckets, shares = bags[i]
            if not len(buckets):
                continue
            hidden = shares @ table[buckets]
            error = softmax(hidden @ layer + offset)
            error[target[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            offset -= rate * 0.1 * error
            # Rows step by their share of the text, scaled to the number of rows.
            table[buckets] -= rate * len(buckets) * 0.2 * shares[:, None] * back
    model = LanguageModel(languages, (table @ layer).astype(np.float32), offset, 1.0, settings)
    held = np.flatnonzero(aside if aside.any() else ~aside)
    logits = np.array([bags[i][1] @ model.shares[bags[i][0]] + offset for i in held])
    model.temperature = _temperature(logits, target[held])
    return model


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature with the least log loss."""
    grid = np.geomspace(0.25, 8.0, 41)
    rows = np.arange(len(target))
    losses = [-np.log(softmax(logits / t)[rows, target] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def learn_languages(labelled: DataFrame, settings: Settings = Settings()) -> LanguageModel:
    """A model from (doc_id, text, lang) rows: at most ``per_language`` texts of up to
    ``max_chars`` characters for each language go to the driver. Rows without text or
    language teach nothing."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sample = bounded_sample(rows, "lang", settings.per_language, settings.max_chars)
    return train([row["text"] for row in sample], [row["lang"] for row in sample], settings)


def language_of(text: Column, model: LanguageModel) -> Column:
    """(lang_pred, score, rejected) of a text column."""

    @F.pandas_udf(LANGUAGE)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield frame(texts.tolist())

    def frame(texts: list) -> pd.DataFrame:
        parts = []
        for start in range(0, len(texts), 128):
            names, score, rejected = model.predict([text or "" for text in texts[start : start + 128]])
            parts.append(pd.DataFrame({"lang_pred": names, "score": score, "rejected": rejected}))
        return pd.concat(parts) if parts else pd.DataFrame(columns=LANGUAGE.names)

    return predict(text.cast("string"))


def identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row of ``docs``, from whole texts.

    ``und`` with score 0, rejected, where a text is null or has no letter. Repeated
    rows come back repeated, an empty table gives no rows; other columns than doc_id
    and text are not read."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                names, score, rejected = model.predict([text or "" for text in part["text"].to_pylist()])
                columns = [part["doc_id"], pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *LANGUAGE.names])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), *LANGUAGE])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches, schema)

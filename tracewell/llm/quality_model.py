"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every known word has a sparse random index vector, made from its hash; its word vector is its own index vector and the
sum of those of the words beside it in the sample.  A document's words are pooled to their mean vector, and a network of
two layers (numpy, Adam) gives the odds that the document's label is 1.  A temperature that is fitted on a part of the
sample that the network has not seen makes the odds probabilities.

Words are runs of letters, numbers and runs of other marks.  A word that is not known stands under its shape (case and
length), so text of never-seen words is judged by what it looks like; a part between white space that equals the one
before is the word `<again>` besides.

The sample that is learned from is bounded: `rows_per_label` labelled rows of each label, at most `chars_per_row`
characters of each.  Scoring reads whole texts, where they are.

Defined cases: a null text, or one without anything but white space, has score 0.  With labels of one kind only, or none,
every score is the share of label 1 (0.5 without labels).  Repeated rows are scored each by itself; other columns are
ignored; an empty table gives no rows; labels that are null or neither 0 nor 1 are not learned from.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import common
from tracewell.llm.language_id import held_out
from tracewell.llm.registry import query
from tracewell.llm.tokens import Generations

WORD = re.compile(r"[^\W\d_]+|\d+|[\W_]+")
AGAIN = "<again>"
DIMENSIONS, SPARSE, NEIGHBOURS = 64, 6, 2
SLICE = 2 << 20
NEEDED = 0.3


@dataclass(frozen=True)
class Model:
    words: dict[str, int] = field(default_factory=dict)
    vectors: np.ndarray | None = None  # a row per word
    layers: tuple = ()  # mean, spread, w1, b1, w2, b2
    temperature: float = 1.0
    shift: float = 0.0  # log odds of the labels less those of the sample
    share: float = 0.5
    key: int = 0


def shape(word: str) -> str:
    """What stands for a word that is not known."""
    if word[0].isdigit():
        return "<number>"
    if not word[0].isalpha():
        return "<mark>" if len(word) == 1 else "<marks>"
    size = "s" if len(word) < 4 else "m" if len(word) < 12 else "l"
    case = "lower" if word.islower() else "upper" if word.isupper() else "title" if word.istitle() else "mixed"
    return f"<{case}-{size}>"


def stream(text: str) -> list[str]:
    out, last = [], None
    for part in text.split():
        if part == last:
            out.append(AGAIN)
        out += WORD.findall(part)
        last = part
    return out


def index_vector(word: str) -> np.ndarray:
    rng = np.random.default_rng(zlib.crc32(word.encode()))
    vector = np.zeros(DIMENSIONS, "f4")
    vector[rng.choice(DIMENSIONS, SPARSE, replace=False)] = rng.choice([-1.0, 1.0], SPARSE)
    return vector


def word_vectors(texts: list[str], known: int = 4000, often: int = 8) -> tuple[dict[str, int], np.ndarray]:
    streams = [stream(t) for t in texts]
    counts = Counter(chain.from_iterable(streams))
    frequent = [w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if n >= often][:known]
    shapes = sorted({shape(w) for w in ("1", ".", "..")} | {f"<{c}-{s}>" for c in ("lower", "upper", "title", "mixed") for s in "sml"})
    words = {w: i for i, w in enumerate(dict.fromkeys([*frequent, *shapes, AGAIN]))}
    index = np.stack([index_vector(w) for w in words])
    # Neighbours never reach into another text: ids are padded between texts by a word without a vector.
    none = len(words)
    ids = np.fromiter(chain.from_iterable(chain((words.get(w, words.get(shape(w), none)) for w in s), [none] * NEIGHBOURS) for s in streams), "i8")
    beside = np.zeros_like(index)
    for step in range(1, NEIGHBOURS + 1):
        for left, right in ((ids[:-step], ids[step:]), (ids[step:], ids[:-step])):
            both = (left != none) & (right != none)
            pairs, n = np.unique(left[both] * none + right[both], return_counts=True)
            for i in range(0, len(pairs), 50_000):
                p = pairs[i : i + 50_000]
                np.add.at(beside, p // none, index[p % none] * n[i : i + 50_000, None])
    size = np.linalg.norm(beside, axis=1, keepdims=True)
    vectors = index / np.sqrt(SPARSE) + np.divide(beside, size, out=np.zeros_like(beside), where=size > 0)
    return words, vectors.astype("f4")


class _Scorer:
    """Pools and scores texts; remembers the words of parts between white space."""

    def __init__(self, model: Model):
        self.model, self.parts = model, Generations(250_000)
        self.again = model.words.get(AGAIN)

    def _ids(self, part: str) -> tuple[int, ...]:
        words = self.model.words
        return tuple(words[w] if w in words else words[shape(w)] for w in WORD.findall(part))

    def pooled(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The mean word vector of each text, and its number of words."""
        sums, counts = np.zeros((len(texts), DIMENSIONS)), np.zeros(len(texts))
        vectors = self.model.vectors
        split = [t.split() for t in texts]
        for part in self.parts.missing(set(chain.from_iterable(split))):
            self.parts.young[part] = self._ids(part)
        of = self.parts.young.__getitem__
        for i, parts in enumerate(split):
            if not parts:
                continue
            ids = np.fromiter(chain.from_iterable(map(of, parts)), "i4")
            again = sum(map(eq, parts, parts[1:]))
            times = np.bincount(ids, minlength=len(vectors))
            times[self.again] += again
            met = np.flatnonzero(times)
            sums[i] = times[met] @ vectors[met]
            counts[i] = times.sum()
        return sums / np.maximum(counts, 1)[:, None], counts

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.model.layers:
            return np.full(len(texts), self.model.share)
        pooled, counts = self.pooled(texts)
        odds = forward(self.model.layers, pooled)[1] / self.model.temperature + self.model.shift
        return np.where(counts > 0, 1 / (1 + np.exp(-np.clip(odds, -60, 60))), 0.0)


def forward(layers: tuple, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean, spread, w1, b1, w2, b2 = layers
    hidden = np.tanh((x - mean) / spread @ w1 + b1)
    return hidden, hidden @ w2 + b2


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 80, rate: float = 0.01, decay: float = 1e-3, seed: int = 7) -> tuple:
    """Layers of a network with one hidden layer, by Adam on batches of 64."""
    rng = np.random.default_rng(seed)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0]
    m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    z = (x - mean) / spread
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // 64)):
            a, target = z[rows], y[rows]
            h = np.tanh(a @ w[0] + w[1])
            error = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -60, 60))) - target) / len(rows)
            back = np.outer(error, w[2]) * (1 - h * h)
            grads = [a.T @ back + decay * w[0], back.sum(axis=0), h.T @ error + decay * w[2], error.sum()]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return (mean, spread, *w)


def temperature_of(odds: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss."""

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, np.where(y == 1, -odds, odds) / t)))

    return min(np.geomspace(0.5, 10, 60), key=loss) if len(odds) else 1.0


def learn(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows_per_label: int = 1500,
    chars_per_row: int = 6000,
) -> Model:
    """A model of a bounded sample of the labels, chosen by the hash of the key, equally many of each label.

    The labels are drawn before they meet the documents, so the drawn ones are few and are broadcast.
    """
    marks = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.approx_count_distinct("k").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Model(share=counts.get(1, 0) / total if total else 0.5)
    limit = F.create_map(*(x for y, n in counts.items() for x in (F.lit(y), F.lit(min(1.0, rows_per_label / n)))))
    drawn = marks.filter(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < limit[F.col("y")] * (1 << 20)).distinct()
    texts = documents.filter(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    met = texts.join(F.broadcast(drawn), "k")
    once = met.groupBy("y", F.xxhash64("t").alias("h")).agg(F.first(F.substring("t", 1, chars_per_row)).alias("t"))  # copies count once
    sample = sorted((r["h"], r["y"], r["t"]) for r in once.limit(4 * rows_per_label).collect())
    texts, y = [r[2] for r in sample], np.array([r[1] for r in sample], "f8")
    if len(set(y)) < 2:
        return Model(share=counts[1] / total)
    words, vectors = word_vectors(texts)
    x, _ = _Scorer(Model(words, vectors)).pooled(texts)
    unseen = np.arange(len(y)) % 5 == 0
    held = train(x[~unseen], y[~unseen])
    temperature = temperature_of(forward(held, x[unseen])[1], y[unseen])
    ones = min(max(y.mean(), 1e-3), 1 - 1e-3)
    shift = np.log(counts[1] / counts[0]) - np.log(ones / (1 - ones))
    layers = train(x, y)
    key = zlib.crc32(repr((sorted(words), [np.round(p, 6).tolist() for p in layers])).encode())
    return Model(words, vectors, layers, float(temperature), float(shift), counts[1] / total, key)


def _scorer(model: Model) -> _Scorer:
    """One per worker process and model."""
    return common.kept(("quality", model.key), lambda: _Scorer(model))


def score_quality(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of `docs` and the score, which replaces a column of its name."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.one_thread()
        scorer = _scorer(model)
        for series in batches:
            found = []
            for batch in common.pieces_of(pa.record_batch([pa.array(series, pa.string())], ["t"]), "t", SLICE):
                found.append(scorer.scores([t or "" for t in batch.column("t").to_pylist()]))
            common.release_memory()
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return docs.withColumn(into, of(F.col(text)))


def learned(documents: DataFrame, labels: DataFrame) -> Model:
    """From labelled documents that are not held out (remainder 0 of 5)."""
    return learn(documents, labels.filter(~held_out(F.col("doc_id"), 5, 0)))


@query("op3_quality_model")
def op3_quality_model(spark, folder):
    documents = common.read(spark, folder, "documents")
    scored = score_quality(documents.select("doc_id", "text"), learned(documents, common.read(spark, folder, "labels")))
    predicted = F.when(F.col("score") >= NEEDED, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", predicted)

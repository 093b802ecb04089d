"""Toxicity by class-conditional Kneser-Ney models.

Tokens are runs of letters, digits and non-ASCII bytes, A-Z lower-cased. For a
class c the model is absolute discounting with shared backoff:

    p(w | c) = max(n_c(w) - D, 0) / N_c + g_c * p_shared(w)

``n_c(w)`` is the number of training documents of the class that hold w (a
word repeated a thousand times in one text is one piece of evidence), D grows
with the count (1, 1.8, 2.5: rare expressions fall back), ``g_c`` is the mass
so taken, and ``p_shared`` is Kneser-Ney's continuation probability: the
number of different left neighbours of w over *all* documents, labelled or
not. The vocabulary is closed: the tokens of two training documents or more,
under their full 64-bit hash, and one symbol for all others, as words and as
neighbours. So each class's probabilities add up to one, the neighbours are
counted exactly (distinct pairs, grouped by Spark), and no table has a fixed
size: the vocabulary follows the label sample, the pairs the corpus.

A document's score compares its log-likelihoods under the two models,
normalised by its number of distinct tokens: the mean log ratio, and the
normalised sum of squared ratios above ``excess`` (a few strong expressions
in a long text). A logistic curve over these turns them into a probability;
it is fitted on training documents scored without their own counts. (With the
word before as a history of the class models, too, held-out precision and
recall were lower: most of its counts are of single documents.)

Labels are a bounded sample: the ``most_labelled`` labelled rows of lowest
id hash, held-out rows excluded. What comes to the driver and is broadcast
is a row for each word of the vocabulary.

Edge cases: null or empty text has no tokens and gets the curve's score for a ratio of zero;
a null ``doc_id`` is not held out and never labelled; a doc_id labelled twice
takes the larger label; null labels are ignored; without both classes in
training every score is the share of toxic labels (0 if none); repeated rows
are rows like any other; an empty table gives an empty result; result columns
replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root
from .kernel import Words, slices

TOKEN_SPACE = np.ones(256, bool)
TOKEN_SPACE[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = False
TOKEN_SPACE[128:] = False
DISCOUNTS = np.array([0.0, 1.0, 1.8, 2.5])
RESULT = ["held_out", "score", "predicted"]


def held_out(doc_id) -> F.Column:
    """The fold kept out of training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_labels(labels: DataFrame, most: int = 200_000) -> DataFrame:
    """(label_id, toxic) of the training fold, ``most`` rows by id hash."""
    rows = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return rows.where(~held_out(F.col("label_id"))).orderBy(F.xxhash64("label_id"), "label_id").limit(most)


def _distinct(doc: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, token) pairs."""
    order = np.lexsort((token, doc))
    doc, token = doc[order], token[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
    return doc[new], token[new]


def _number(vocabulary: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Each token's place in the sorted vocabulary from 1 on; 0 for any other."""
    if not len(vocabulary):
        return np.zeros(len(token), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, token), len(vocabulary) - 1)
    return np.where(vocabulary[at] == token, at + 1, 0)


_WORDS = "token long, toxic long, ordinary long"


def _by_class(w: Words, token: np.ndarray, label: np.ndarray) -> list[pa.Array]:
    """Distinct tokens of a batch, and how many documents of each class hold them."""
    doc, token = _distinct(w.doc, token)
    found, at = np.unique(token, return_inverse=True)
    return [pa.array(found.view(np.int64))] + [
        pa.array(np.bincount(at, label[doc] == c, minlength=len(found)).astype(np.int64)) for c in (1, 0)]


def vocabulary(known: DataFrame) -> DataFrame:
    """(token, toxic, ordinary) of the tokens that two documents or more of (text, toxic) hold."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            w = Words(part.column("text"), space=TOKEN_SPACE)
            yield pa.RecordBatch.from_arrays(_by_class(w, w.hash, part.column("toxic").to_numpy()), names=["token", "toxic", "ordinary"])

    return known.select("text", "toxic").mapInArrow(scan, _WORDS).groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).where("toxic + ordinary > 1")


def unknown_words(known: DataFrame, words) -> DataFrame:
    """(toxic, ordinary): documents of each class that hold a token outside the vocabulary (``words``, a broadcast of it)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(2, np.int64)
        for part in slices(batches, "text", 4 << 20):
            w = Words(part.column("text"), space=TOKEN_SPACE)
            holds = np.unique(w.doc[_number(words.value, w.hash) == 0])
            label = part.column("toxic").to_numpy()[holds]
            count += [(label == 1).sum(), (label == 0).sum()]
        yield pa.RecordBatch.from_arrays([pa.array(count[:1]), pa.array(count[1:])], names=["toxic", "ordinary"])

    return known.select("text", "toxic").mapInArrow(scan, "toxic long, ordinary long").agg(F.sum("toxic"), F.sum("ordinary"))


#: Pairs a task keeps before it sends them on.
_HELD = 4 << 20


def continuations(docs: DataFrame, words, size: int) -> DataFrame:
    """(word, n): different left neighbours of each numbered word over all documents.

    Words and neighbours are numbers of the vocabulary, 0 for all others; a
    document's first token has its beginning as neighbour. A task sends each
    pair once (or a few times, if it has very many), and pairs are spread by
    their hash, so a frequent word is no hot key.
    """
    wide = size + 2

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in slices(batches, "text", 4 << 20):
            w = Words(part.column("text"), space=TOKEN_SPACE)
            number = _number(words.value, w.hash)
            left = np.empty_like(number)
            left[1:] = number[:-1]
            left[w.first[:-1][w.count > 0]] = size + 1
            held.append(np.unique(left * wide + number))
            if sum(map(len, held)) > _HELD:
                held = [np.unique(np.concatenate(held))]
                if len(held[0]) > _HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held.pop())], names=["pair"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], names=["pair"])

    pairs = docs.select("text").mapInArrow(scan, "pair long").distinct()
    return pairs.groupBy(F.pmod("pair", F.lit(wide)).alias("word")).agg(F.count(F.lit(1)).alias("n"))


def _discounted(n: np.ndarray) -> np.ndarray:
    return np.maximum(n - DISCOUNTS[np.minimum(n, 3)], 0)


@dataclass
class Counts:
    """Class counts and shared continuation probabilities of the words 0 (all others), 1, 2, ..."""

    words: np.ndarray                    # sorted hashes of the words from 1 on
    toxic: np.ndarray
    ordinary: np.ndarray
    shared: np.ndarray

    def __post_init__(self):
        own = (self.toxic, self.ordinary)
        self.total = tuple(max(1, int(n.sum())) for n in own)
        self.mass = tuple(1 - float(_discounted(n).sum()) / t for n, t in zip(own, self.total))

    def probability(self, word: np.ndarray, toxic: bool, own=0) -> np.ndarray:
        """p(w | c), without one's own counts."""
        n, total, mass = (x[0 if toxic else 1] for x in ((self.toxic, self.ordinary), self.total, self.mass))
        return _discounted(np.maximum(n[word] - own, 0)) / total + mass * self.shared[word]

    def ratio(self, word: np.ndarray, own_toxic=0, own_ordinary=0) -> np.ndarray:
        """Log-likelihood ratio of each word, without one's own counts.

        A word that no other training document holds says nothing: there, the
        ratio would be that of the classes' sizes.
        """
        seen = (self.toxic[word] > own_toxic) | (self.ordinary[word] > own_ordinary)
        return np.where(seen, np.log(self.probability(word, True, own_toxic)) - np.log(self.probability(word, False, own_ordinary)), 0.0)

    def ratios(self) -> np.ndarray:
        return self.ratio(np.arange(len(self.toxic)))


def count(docs: DataFrame, known: DataFrame) -> Counts:
    """From all documents (text) and the label sample's (text, toxic)."""
    context = docs.sparkSession.sparkContext
    got = vocabulary(known).toArrow()                      # bounded by the label sample
    token = got["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    words = token[order]
    held = context.broadcast(words)
    rest = [x or 0 for x in unknown_words(known, held).first()]
    left = np.zeros(len(words) + 1)
    for r in continuations(docs, held, len(words)).toArrow().to_batches():
        left[r["word"].to_numpy()] = r["n"].to_numpy()
    held.destroy()
    toxic, ordinary = (np.append(x, got[c].to_numpy()[order]).astype(np.int64) for x, c in zip(rest, ("toxic", "ordinary")))
    # half a neighbour for every word, so that each has a share
    return Counts(words, toxic, ordinary, (left + 0.5) / (left + 0.5).sum())


def features(doc: np.ndarray, ratio: np.ndarray, docs: int, excess: float) -> np.ndarray:
    """Length-normalised comparisons of each document's log-likelihoods."""
    n = np.bincount(doc, minlength=docs)
    some = np.maximum(n, 1)
    over = np.bincount(doc, np.maximum(ratio - excess, 0) ** 2, minlength=docs)
    return np.stack([np.bincount(doc, ratio, minlength=docs) / some, np.sqrt(over / some),
                     np.log1p(over / np.sqrt(some))], axis=1)


@dataclass
class Curve:
    """Logistic curve over standardised features, held to the range it was fitted on."""

    low: np.ndarray
    high: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (np.clip(x, self.low, self.high) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + z @ self.weights[1:], -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Curve:
    """Ridge logistic regression by Newton's method."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Curve(x.min(axis=0), x.max(axis=0), mean, scale, w)


@dataclass
class Model:
    excess: float
    words: np.ndarray | None             # the vocabulary; None: every score is ``base``
    ratios: np.ndarray | None            # of each word
    curve: Curve | None
    base: float

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.words is None:
            return np.full(len(column), self.base)
        w = Words(column, space=TOKEN_SPACE)
        doc, word = _distinct(w.doc, _number(self.words, w.hash))
        return self.curve(features(doc, self.ratios[word], w.n_docs, self.excess))


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = 200_000, excess: float = 1.5) -> Model:
    """Counts over all documents, class counts and curve from the label sample."""
    checkpoint_root(docs.sparkSession)
    sample = F.broadcast(training_labels(labels, most_labelled).checkpoint())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = rows.join(sample, F.col("doc_id") == F.col("label_id")).select("text", "toxic")
    tally = dict(sample.groupBy("toxic").count().collect())
    base = tally.get(1, 0) / max(1, sum(tally.values()))
    if len(tally) < 2:
        return Model(excess, None, None, None, base)
    counts = count(rows, known)
    held = docs.sparkSession.sparkContext.broadcast(counts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            w = Words(part.column("text"), space=TOKEN_SPACE)
            doc, word = _distinct(w.doc, _number(held.value.words, w.hash))
            label = part.column("toxic").to_numpy()
            own = label[doc] == 1
            x = features(doc, held.value.ratio(word, own.astype(np.int64), (~own).astype(np.int64)), w.n_docs, excess)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(3)] + [pa.array(label)], names=["a", "b", "c", "y"])

    table = known.mapInArrow(scan, "a double, b double, c double, y int").toArrow()
    held.destroy()
    if not table.num_rows:                                 # labels of other documents only
        return Model(excess, None, None, None, base)
    x = np.stack([table[c].to_numpy() for c in "abc"], axis=1)
    curve = logistic(x, (table["y"].to_numpy() == 1).astype(float))
    return Model(excess, counts.words, counts.ratios(), curve, base)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The input rows with held_out, score (0 to 1) and predicted (0 or 1)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(*RESULT)
    schema = T.StructType(docs.schema.fields + [T.StructField("score", T.DoubleType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            yield part.append_column("score", pa.array(held.value.scores(part.column("text"))))

    return docs.mapInArrow(scan, schema).withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))

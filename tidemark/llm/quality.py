"""Quality classifier by co-training of two views of a document.

One classifier sees the words, the other what a page record tells without reading
it: language, source, length and layout shares.  Both are naive Bayes over hashed
features of fixed number, scored as mean log-odds and calibrated to probabilities on
labelled rows held back.  In each round both score all documents; what one view is
sure of becomes training data of the other.  At the end the calibrated log-odds of
the views are added with weights fitted on the labels held back.

At most ``labelled_rows`` labels are used, those whose ids hash lowest; they and the
models are small and go to every task.  Everything else covers all documents: a
round is one pass that adds up feature counts per task, summed by Spark, and scoring
is a column: texts go to Python once and do not come back.  No text is shuffled.
Training and scoring lower the session's setting for the bytes of rows that go to
Python at once; it stays lowered.

Without labels of both classes every document gets one half and is kept.  Null text
counts as empty, null metadata as a value of its own; texts are taken whole, whatever
their length.  Of several labels of a document the lowest counts; labels of unknown
documents count for nothing.  Rows that repeat are scored one by one; of a held-back
label's rows the one with the lowest scores calibrates.  ``keep`` names
columns to carry over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.session import bound_batches

WORD_FEATURES, META_FEATURES = 1 << 16, 1 << 12
SMOOTHING = 1.0
REMEMBERED = 100_000
# Bytes of text read at once: their words and features take nearly thirty times as much.
SLICE = 1_000_000
HELD_BACK = 3  # one label in so many calibrates, the others train
REPEATED = zlib.crc32(b"word=repeated") % WORD_FEATURES
MARKS = "#$%&*!|.,;:?()[]{}<>\"'~^_=+-/\\@"
SHAPES = zlib.crc32(b"shape=othera"), zlib.crc32(b"shape=uppera")  # of words without marks


def _word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its letters, its shape (case and the marks around it), whether it is
    upper case, and whether it is letters up to full stops and commas."""
    bare = [w.strip(MARKS) for w in words]
    upper = [w.isupper() for w in words]
    letters = [zlib.crc32(b.lower().encode()) for b in bare]
    shapes = [(SHAPES[u and len(w) > 1] if b is w else _shape(w, b)) for w, b, u in zip(words, bare, upper, strict=True)]
    plain = [w.rstrip(".,").isalpha() for w in words]
    return (np.array(letters, np.int64) % WORD_FEATURES, np.array(shapes, np.int64) % WORD_FEATURES,
            np.array(upper, bool), np.array(plain, bool))


def _shape(word: str, letters: str) -> int:
    case = "none" if not letters else "upper" if letters.isupper() and len(letters) > 1 else "other"
    marks = word.replace(letters, "a", 1) if letters else word
    return zlib.crc32(f"shape={case}{marks}".encode())


class Words(dict):
    """Numbers words in the order in which they come, with their features."""

    def __init__(self) -> None:
        super().__init__()
        self.features = _word_features([])

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place

    def learn(self) -> None:
        """Features of the words numbered since."""
        count = len(self) - len(self.features[0])
        if count:
            new = _word_features(list(islice(reversed(self), count))[::-1])
            self.features = tuple(map(np.concatenate, zip(self.features, new, strict=True)))

    def forget(self, most: int) -> None:
        """Keep the first ``most`` words, which have the frequent ones among them."""
        if len(self) > most:
            while len(self) > most:
                self.popitem()
            self.features = tuple(f[:most].copy() for f in self.features)


def _share(part: float, whole: float) -> int:
    return int(10 * part / whole) if whole else -1


class Views:
    """Features of both views of a slice of documents, as flat arrays with owners."""

    def __init__(self) -> None:
        self._words = Words()

    def parts(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple]]:
        """The slices of a batch of any size, each with its features."""
        for part in slices(batch, "text", SLICE):
            yield part, self.of(part)

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        split = [t.split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        owner = np.repeat(np.arange(len(split)), counts)
        rows = np.fromiter(map(self._words.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        again = np.flatnonzero((rows[1:] == rows[:-1]) & (owner[1:] == owner[:-1])) + 1 if len(rows) else rows
        self._words.learn()
        letters, shapes, is_upper, is_plain = self._words.features
        features = np.concatenate([letters[rows], shapes[rows], np.full(2 * len(again), REPEATED)])
        owners = np.concatenate([owner, owner, owner[again], owner[again]])
        uppers, plains = (np.bincount(owner[kind[rows]], minlength=len(split)).tolist() for kind in (is_upper, is_plain))
        meta = []
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for text, words, lang, source, upper, plain in zip(texts, split, langs, sources, uppers, plains, strict=True):
            named = (("lang", lang), ("source", source), ("length", len(text).bit_length()),
                     ("lines", (text.count("\n") + 1).bit_length()), ("upper", _share(upper, len(words))),
                     ("distinct", _share(len(set(words)), len(words))),
                     ("plain", _share(plain, len(words))),
                     ("word", _share(len(text), 10 * len(words))))
            meta += [zlib.crc32(f"{k}={v}".encode()) % META_FEATURES for k, v in named]
        self._words.forget(REMEMBERED)
        meta_owner = np.repeat(np.arange(len(texts)), 8)
        return features, owners, np.array(meta, np.int64), meta_owner


class Model:
    """Log-odds of features, and the line that makes a mean of them a logit."""

    def __init__(self, counts: np.ndarray) -> None:
        totals = counts.sum(1, keepdims=True)
        rates = np.log((counts + SMOOTHING) / (totals + SMOOTHING * counts.shape[1]))
        self.odds = (rates[1] - rates[0]).astype(np.float64)
        self.slope, self.offset = 0.0, 0.0

    def raw(self, features: np.ndarray, owners: np.ndarray, count: int) -> np.ndarray:
        sums = np.bincount(owners, self.odds[features], count)
        return sums / np.maximum(1, np.bincount(owners, minlength=count))

    def logit(self, raw: np.ndarray) -> np.ndarray:
        return self.slope * raw + self.offset

    def calibrate(self, raw: np.ndarray, labels: np.ndarray) -> None:
        self.slope, self.offset = logistic(raw[:, None], labels)


def logistic(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights and offset of a logistic regression on a few numbers, by Newton's
    method, lightly damped; zeros if the labels are all alike."""
    if len(set(labels.tolist())) < 2:
        return np.zeros(x.shape[1] + 1)
    scale = np.append(np.where(x.std(0) > 0, x.std(0), 1.0), 1.0)
    x = np.column_stack([x, np.ones(len(x))]) / scale
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + 1e-2 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return weights / scale


class Classifier:
    def __init__(self, words: Model, meta: Model) -> None:
        self.words, self.meta = words, meta
        self.weights = np.zeros(3)  # of the views' logits, and an offset

    def combined(self, by_words: np.ndarray, by_meta: np.ndarray) -> np.ndarray:
        return self.weights[0] * by_words + self.weights[1] * by_meta + self.weights[2]

    def logits(self, views: tuple, count: int) -> tuple[np.ndarray, np.ndarray]:
        features, owners, meta, meta_owners = views
        return (self.words.logit(self.words.raw(features, owners, count)),
                self.meta.logit(self.meta.raw(meta, meta_owners, count)))


def _source(docs: DataFrame, id_column: str, text_column: str, lang_column: str, source_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
        F.col(lang_column).cast("string").alias("lang"), F.col(source_column).cast("string").alias("source"))


COUNTS = "view int, label int, feature int, n long"


def _counts(docs: DataFrame, labels: dict[int, int], classifier: Classifier | None, sure: float) -> np.ndarray:
    """Feature counts by view and label: of labelled documents, and for each view of
    those the other view is sure of.  Summed per task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Views()
        sums = [np.zeros((2, WORD_FEATURES), np.int64), np.zeros((2, META_FEATURES), np.int64)]
        for batch in batches:
            for part, views in reader.parts(batch):
                known = np.array([labels.get(d, -1) for d in part.column("doc_id").to_pylist()])
                taught = [known.copy(), known.copy()]
                if classifier is not None:
                    by_words, by_meta = classifier.logits(views, len(known))
                    for own, other in ((taught[0], by_meta), (taught[1], by_words)):
                        free = own < 0
                        own[free & (other >= sure)] = 1
                        own[free & (other <= -sure)] = 0
                for total, own, (features, owners) in zip(sums, taught, (views[:2], views[2:]), strict=True):
                    for label in (0, 1):
                        total[label] += np.bincount(features[own[owners] == label], minlength=total.shape[1])
        for view, total in enumerate(sums):
            label, feature = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(label), view, np.int32)), pa.array(label.astype(np.int32)),
                 pa.array(feature.astype(np.int32)), pa.array(total[label, feature])],
                ["view", "label", "feature", "n"])

    summed = docs.mapInArrow(run, COUNTS).groupBy("view", "label", "feature").agg(F.sum("n").alias("n")).toArrow()
    out = [np.zeros((2, WORD_FEATURES)), np.zeros((2, META_FEATURES))]
    view, label, feature, n = (summed.column(c).to_numpy() for c in ("view", "label", "feature", "n"))
    for v in (0, 1):
        out[v][label[view == v], feature[view == v]] = n[view == v]
    return out


def _calibrated(docs: DataFrame, counts: list, labels: dict[int, int]) -> Classifier:
    classifier = Classifier(Model(counts[0]), Model(counts[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Views()
        for batch in batches:
            for part, (features, owners, meta, meta_owners) in reader.parts(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(classifier.words.raw(features, owners, len(part))),
                     pa.array(classifier.meta.raw(meta, meta_owners, len(part)))], ["doc_id", "words", "meta"])

    raw = (docs.mapInArrow(run, "doc_id long, words double, meta double")
           .groupBy("doc_id").agg(F.min(F.struct("words", "meta")).alias("least")).select("doc_id", "least.*").toArrow())
    truth = np.array([labels[d] for d in raw.column("doc_id").to_pylist()], np.float64)
    models, means = (classifier.words, classifier.meta), (raw.column(c).to_numpy() for c in ("words", "meta"))
    logits = []
    for model, mean in zip(models, means, strict=True):
        model.calibrate(mean, truth)
        logits.append(np.clip(model.logit(mean), -10, 10))
    classifier.weights = logistic(np.column_stack(logits), truth)
    return classifier


def train(docs: DataFrame, labels: DataFrame, rounds: int = 2, labelled_rows: int = 20_000,
          sure: float = 3.0, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
          source_column: str = "source", label_column: str = "quality") -> Classifier:
    """Classifier after ``rounds`` exchanges of pseudo-labels.  ``labelled_rows`` bounds
    the labels used; ``sure`` is the logit from which a view teaches the other."""
    spark = bound_batches(docs.sparkSession)
    source = _source(docs, id_column, text_column, lang_column, source_column)
    sample = (labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
              .where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows).toArrow())
    ids, values = sample.column("doc_id").to_pylist(), sample.column("label").to_pylist()
    teaching = {d: v for i, (d, v) in enumerate(zip(ids, values, strict=True)) if i % HELD_BACK}
    held = {d: v for i, (d, v) in enumerate(zip(ids, values, strict=True)) if not i % HELD_BACK}

    def only(chosen: dict[int, int], how: str = "left_semi") -> DataFrame:
        # As an Arrow table: rows of Python objects start further workers on the executors.
        frame = spark.createDataFrame(pa.table({"doc_id": pa.array(list(chosen), pa.int64())}))
        return source.join(F.broadcast(frame), "doc_id", how)

    counts = _counts(only(teaching), teaching, None, sure)
    classifier = _calibrated(only(held), counts, held)
    for _ in range(rounds if len(set(values)) == 2 else 0):
        # Held-back documents teach nothing: what a view says of them may not return.
        counts = _counts(only(held, "left_anti"), teaching, classifier, sure)
        classifier = _calibrated(only(held), counts, held)
    return classifier


def score(docs: DataFrame, classifier: Classifier, id_column: str = "doc_id", text_column: str = "text",
          lang_column: str = "lang", source_column: str = "source", keep: tuple[str, ...] = (),
          threshold: float = 0.5) -> DataFrame:
    """Rows (doc_id, words_view, meta_view, quality, is_good, then ``keep``): the calibrated
    probabilities of good quality by each view and by both; good from ``threshold`` up."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("struct<words_view: double, meta_view: double, quality: double>")
    def judged(arrays: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        reader = Views()
        for text, lang, source in arrays:
            parts = []
            batch = pa.RecordBatch.from_arrays([text, lang, source], ["text", "lang", "source"])
            for part, views in reader.parts(batch):
                words, meta = classifier.logits(views, len(part))
                both = classifier.combined(*(np.clip(v, -10, 10) for v in (words, meta)))
                parts.append(np.stack([1 / (1 + np.exp(-np.clip(x, -700, 700))) for x in (words, meta, both)]))
            columns = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0))
            yield pa.StructArray.from_arrays(list(map(pa.array, columns)), ["words_view", "meta_view", "quality"])

    # Not deterministic for Spark only: else a filter on the result would judge every text twice.
    verdict = judged.asNondeterministic()(
        F.col(text_column), F.col(lang_column).cast("string"), F.col(source_column).cast("string"))
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), verdict.alias("verdict"), *(F.col(c).alias(f"kept_{c}") for c in keep)
    ).select("doc_id", "verdict.*", F.expr(f"verdict.quality >= {threshold}").alias("is_good"),
             *(F.col(f"kept_{c}").alias(c) for c in keep))

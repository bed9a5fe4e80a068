"""Quality classification by co-training two views of a document.

The text view knows the characters and words of the content; the page view knows the
metadata alone: language, source and stated size. Each is a logistic regression. In
every round each view labels the unlabelled documents that it is surest of, as far as its
labels prove right on held-out ones, and the other view learns from them. The held-out
documents then calibrate both views, and a last regression over the calibrated log-odds
combines them.

Everything is fitted by passes over all documents, in Spark. A pass sums what a step needs
within each task and then over the tasks: moments, counts of scores, or gradient and
curvature of Newton's method. Only such sums reach the driver; their number
depends on the number of features alone. Tasks round their sums to whole multiples of
1 / _UNIT, so that the total does not depend on the order in which tasks end.

The labels a view was given are never stored: a round's models and thresholds tell which
documents it labelled, so each pass works them out anew from the history of rounds.
"""

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import column, packed, ship_library, stored, unpacked

ROUNDS = 3
# A round gives a view labels for this share of the unlabelled documents at most.
SHARE = 0.1
# A view may give a label where its share of errors on held-out documents, by a one-sided 95%
# bound, is at most this, and at most this part of what always giving the label would err.
WRONG, WRONG_OF_BLIND = 0.1, 1 / 3
_DEVIATIONS = 1.64
THRESHOLD = 0.5
# Of so many labelled documents one is held back for calibration.
HELD = 3
PENALTY = 1.0
FIRST_STEPS, ROUND_STEPS = 8, 3

_CHARACTERS, _WORD_BUCKETS = 128, 128
_LANGUAGES, _SOURCES, _SIZES = 8, 32, 24
TEXT_WIDTH = _CHARACTERS + _WORD_BUCKETS + 4
PAGE_WIDTH = _LANGUAGES + _SOURCES + _SIZES + 4
_MAX_CACHED = 30_000
# Documents whose features are held at a time.
_ROWS = 500
_UNIT = float(1 << 20)
_LIMIT = 30.0
# Scores are counted by steps of log-odds.
_BINS, _COARSE = 4096, 128

SCORES = "quality_scores"


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % _WORD_BUCKETS
        if len(word) < 50:
            if len(self) >= _MAX_CACHED:
                self.clear()
            self[word] = bucket
        return bucket


_bucket_of = _Buckets()


def text_features(text: str) -> np.ndarray:
    """Shares of characters and of hashed words, and how much the words repeat."""
    encoded = text.encode("utf-8", "replace")
    codes = np.frombuffer(encoded, np.uint8)
    # All bytes beyond ASCII count as one.
    characters = np.bincount(codes, minlength=256)
    characters[0] += characters[128:].sum()
    words = encoded.split()
    count = max(1, len(words))
    buckets = np.fromiter(map(_bucket_of.__getitem__, words), np.int64, len(words))
    shares = np.bincount(buckets, minlength=_WORD_BUCKETS) / count
    repeats = np.count_nonzero(buckets[1:] == buckets[:-1]) / count
    extra = [repeats, len(set(words)) / count, np.log1p(count), np.log1p(len(encoded) / count)]
    return np.concatenate(
        [np.sqrt(characters[:128] / max(1, len(encoded))), np.sqrt(shares), extra]
    )


def page_features(lang: str | None, source: str | None, n_chars: float) -> np.ndarray:
    """Language, source (both hashed) and stated size, as a number and by steps."""
    found = np.zeros(PAGE_WIDTH)
    if lang is not None:
        found[zlib.crc32(lang.encode()) % _LANGUAGES] = 1
    if source is not None:
        found[_LANGUAGES + zlib.crc32(source.encode()) % _SOURCES] = 1
    size = 0.0 if np.isnan(n_chars) else np.log2(1 + min(max(0.0, n_chars), 1e15))
    found[_LANGUAGES + _SOURCES + min(int(size), _SIZES - 1)] = 1
    found[-4:] = [lang is None, source is None, np.isnan(n_chars), size]
    return found


@dataclass
class Logistic:
    """Logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(
            (x - self.mean) / self.scale @ self.weights + self.bias, -_LIMIT, _LIMIT
        )


def _probability(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-log_odds))


@dataclass
class CoTrained:
    text: Logistic
    page: Logistic
    text_calibration: Logistic
    page_calibration: Logistic
    combined: Logistic

    def score(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by the text, the page, and both."""
        a = self.text_calibration.log_odds(self.text.log_odds(text)[:, None])
        b = self.page_calibration.log_odds(self.page.log_odds(page)[:, None])
        both = self.combined.log_odds(np.column_stack([a, b]))
        return tuple(_probability(x) for x in (a, b, both))


# Batches


@dataclass
class Batch:
    """Features of some documents; label is -1 where unknown, held marks those for calibration."""

    views: dict[str, np.ndarray]
    label: np.ndarray
    held: np.ndarray


@dataclass
class Round:
    """The models that gave labels, and by teacher from which log-odds on (good) and down to (bad)."""

    models: dict[str, Logistic]
    good: dict[str, float]
    bad: dict[str, float]


_PUPIL = {"text": "page", "page": "text"}


def given_labels(batch: Batch, rounds: list[Round], pupil: str) -> np.ndarray:
    """The label that the other view gave each document first; -1 where none, or it is labelled."""
    teacher = _PUPIL[pupil]
    given = np.full(len(batch.label), -1)
    for made in rounds:
        odds = made.models[teacher].log_odds(batch.views[teacher])
        free = (given < 0) & (batch.label < 0)
        given[free & (odds >= made.good[teacher])] = 1
        given[free & (odds <= made.bad[teacher])] = 0
    return given


def _targets(batch: Batch, rounds: list[Round], view: str) -> np.ndarray:
    """What a view learns: known labels that are not held back, and those it was given."""
    known = np.where(batch.held, -1, batch.label)
    return np.where(batch.label >= 0, known, given_labels(batch, rounds, view))


# What passes sum


def moments(batch: Batch) -> Iterator[tuple[str, np.ndarray]]:
    """Number, sum and sum of squares of each view; counts of labels to learn from."""
    for view, x in batch.views.items():
        yield f"{view} sum", x.sum(0)
        yield f"{view} squares", (x * x).sum(0)
    learn = batch.label[~batch.held]
    yield "count", np.array([len(batch.label), (learn == 0).sum(), (learn == 1).sum(), (batch.label < 0).sum()])


def newton_sums(batch: Batch, rounds: list[Round], models: dict[str, Logistic]) -> Iterator[tuple[str, np.ndarray]]:
    """Gradient and (upper half of the) curvature of both views at the models."""
    for view, model in models.items():
        target = _targets(batch, rounds, view)
        learn = target >= 0
        x = batch.views[view][learn]
        z = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
        p = _probability(model.log_odds(x))
        yield f"{view} gradient", z.T @ (p - target[learn])
        curvature = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z
        yield f"{view} curvature", curvature[np.triu_indices(len(curvature))]


def _bin(odds: np.ndarray, bins: int) -> np.ndarray:
    return np.minimum(((odds + _LIMIT) * (bins / (2 * _LIMIT))).astype(np.int64), bins - 1)


def _edges(bins: int) -> np.ndarray:
    return np.linspace(-_LIMIT, _LIMIT, bins + 1)


def free_scores(batch: Batch, rounds: list[Round], models: dict[str, Logistic]) -> Iterator[tuple[str, np.ndarray]]:
    """By teacher, how many documents that its pupil has no label for score in each step,
    and how many held-out ones of each label."""
    for teacher, model in models.items():
        held = batch.held & (batch.label >= 0)
        steps = _bin(model.log_odds(batch.views[teacher][held]), _BINS)
        yield f"{teacher} held", np.bincount(steps + _BINS * batch.label[held], minlength=2 * _BINS)
        free = (batch.label < 0) & (given_labels(batch, rounds, _PUPIL[teacher]) < 0)
        odds = model.log_odds(batch.views[teacher][free])
        yield f"{teacher} free", np.bincount(_bin(odds, _BINS), minlength=_BINS)


def held_scores(batch: Batch, models: dict[str, Logistic]) -> Iterator[tuple[str, np.ndarray]]:
    """How many held-out documents of each label score in each pair of steps."""
    held = batch.held & (batch.label >= 0)
    cell = np.zeros(held.sum(), np.int64)
    for view, model in models.items():
        cell = cell * _COARSE + _bin(model.log_odds(batch.views[view][held]), _COARSE)
    cell += batch.label[held] * _COARSE**2
    yield "held", np.bincount(cell, minlength=2 * _COARSE**2)


Pass = Callable[[Callable[[Batch], Iterator[tuple[str, np.ndarray]]]], dict[str, np.ndarray]]


# Fitting


def _step(model: Logistic, gradient: np.ndarray, upper: np.ndarray) -> Logistic:
    """One damped Newton step, given the sums at the model."""
    width = len(gradient)
    curvature = np.zeros((width, width))
    curvature[np.triu_indices(width)] = upper
    curvature = np.triu(curvature) + np.triu(curvature, 1).T
    ridge = np.append(np.full(width - 1, PENALTY), 1e-6)
    w = np.append(model.weights, model.bias)
    step = np.linalg.solve(curvature + np.diag(ridge), gradient + ridge * w)
    w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    return Logistic(model.mean, model.scale, w[:-1], float(w[-1]))


def fit_weighted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 12) -> Logistic:
    """Fit on few distinct rows with weights; with one class the log-odds of having seen that alone."""
    total, positive = float(weight.sum()), float((weight * y).sum())
    mean = weight @ x / total if total else np.zeros(x.shape[1])
    scale = np.sqrt(weight @ (x - mean) ** 2 / total) if total else np.ones(x.shape[1])
    scale = np.where(scale < 1e-9, 1.0, scale)
    prior = float(np.log((positive + 1) / (total - positive + 1)))
    model = Logistic(mean, scale, np.zeros(x.shape[1]), prior)
    if positive in (0, total):
        return model
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    for _ in range(steps):
        p = _probability(model.log_odds(x))
        curvature = (z * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ z
        model = _step(model, z.T @ (weight * (p - y)), curvature[np.triu_indices(len(curvature))])
    return model


def _surest(free: np.ndarray, right: np.ndarray, wrong: np.ndarray, quota: int) -> int:
    """How many steps, the surest first, to label: those that held-out documents support, up to the quota.

    The first step with any document counts even if it alone holds more.
    """
    n, total = np.cumsum(right + wrong), np.cumsum(free)
    share = np.cumsum(right) / np.maximum(n, 1)
    z = _DEVIATIONS**2 / np.maximum(n, 1)
    spread = np.sqrt(z * share * (1 - share) + z * z / 4)
    allowed = min(WRONG, WRONG_OF_BLIND * wrong.sum() / max(1, n[-1]))
    supported = np.flatnonzero((n > 0) & ((share + z / 2 - spread) / (1 + z) >= 1 - allowed))
    if not len(supported) or not total[-1]:
        return 0
    first = int(np.flatnonzero(total)[0]) + 1
    within = int(np.searchsorted(total, quota, side="right"))
    return min(int(supported[-1]) + 1, max(first, within))


def _labelling(counts: dict[str, np.ndarray], models: dict[str, Logistic], unlabelled: int, share: float) -> Round:
    """Thresholds by teacher: the surest documents, both classes in the proportion of the labels."""
    edges = _edges(_BINS)
    made = Round(models, {}, {})
    for teacher in models:
        free = counts[f"{teacher} free"]
        bad, good = counts[f"{teacher} held"].reshape(2, _BINS)
        quota = SHARE * unlabelled
        steps = _surest(free[::-1], good[::-1], bad[::-1], int(np.ceil(quota * share)))
        made.good[teacher] = edges[_BINS - steps] if steps else np.inf
        steps = _surest(free, bad, good, int(np.ceil(quota * (1 - share))))
        # A step's upper edge belongs to the next.
        made.bad[teacher] = np.nextafter(edges[steps], -np.inf) if steps else -np.inf
    return made


def co_train(summed: Pass, rounds: int = ROUNDS) -> CoTrained:
    """Fit by passes over the documents; summed gives the sums of a function's arrays."""
    first = summed(moments)
    count, bad, good, unlabelled = first["count"]
    models = {}
    for view, width in (("text", TEXT_WIDTH), ("page", PAGE_WIDTH)):
        mean = first[f"{view} sum"] / max(1.0, count)
        variance = first[f"{view} squares"] / max(1.0, count) - mean**2
        scale = np.where(variance < 1e-9, 1.0, np.sqrt(np.maximum(variance, 1e-9)))
        prior = float(np.log((good + 1) / (bad + 1)))
        models[view] = Logistic(mean, scale, np.zeros(width), prior)

    history: list[Round] = []

    def improved(models: dict[str, Logistic], steps: int) -> dict[str, Logistic]:
        for _ in range(steps):
            sums = summed(lambda batch, at=models: newton_sums(batch, history, at))
            models = {
                view: _step(model, sums[f"{view} gradient"], sums[f"{view} curvature"])
                for view, model in models.items()
            }
        return models

    if good and bad:
        models = improved(models, FIRST_STEPS)
        for _ in range(rounds if unlabelled else 0):
            counts = summed(lambda batch, at=models: free_scores(batch, history, at))
            history.append(_labelling(counts, models, int(unlabelled), good / (good + bad)))
            models = improved(models, ROUND_STEPS)

    held = summed(lambda batch: held_scores(batch, models))["held"]
    cells = np.flatnonzero(held)
    middle = (_edges(_COARSE)[1:] + _edges(_COARSE)[:-1]) / 2
    a = middle[cells // _COARSE % _COARSE][:, None]
    b = middle[cells % _COARSE][:, None]
    y, weight = (cells // _COARSE**2).astype(float), held[cells].astype(float)
    by_text, by_page = fit_weighted(a, y, weight), fit_weighted(b, y, weight)
    both = np.column_stack([by_text.log_odds(a), by_page.log_odds(b)])
    return CoTrained(models["text"], models["page"], by_text, by_page, fit_weighted(both, y, weight))


# On Spark


def _views(batch: pd.DataFrame) -> dict[str, np.ndarray]:
    """Features of a batch, in the precision in which they are stored."""
    texts = [value or "" for value in batch["text"]]
    sizes = pd.to_numeric(batch["n_chars"]).astype(float)
    text = np.array([text_features(value) for value in texts]).reshape(len(texts), TEXT_WIDTH)
    rows = zip(batch["lang"], batch["source"], sizes)
    page = np.array([page_features(*row) for row in rows]).reshape(len(texts), PAGE_WIDTH)
    return {"text": text.astype(np.float16), "page": page.astype(np.float16)}


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[Batch]:
    for frame in frames:
        for start in range(0, len(frame), _ROWS):
            part = frame[start : start + _ROWS]
            views = {
                view: np.frombuffer(b"".join(part[view]), np.float16).reshape(len(part), width).astype(float)
                for view, width in (("text", TEXT_WIDTH), ("page", PAGE_WIDTH))
            }
            yield Batch(views, part["label"].to_numpy(np.int64), part["held"].to_numpy(bool))


def _summed(features: DataFrame) -> Pass:
    """Passes over stored features: sums per task, then per entry over the tasks."""

    def run(function: Callable[[Batch], Iterator[tuple[str, np.ndarray]]]) -> dict[str, np.ndarray]:
        def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            totals: dict[str, np.ndarray] = {}
            for batch in _batches(frames):
                for name, values in function(batch):
                    totals[name] = totals[name] + values if name in totals else values.astype(float)
            for name, values in totals.items():
                units = np.rint(values * _UNIT).astype(np.int64)
                entries = {"name": name, "entry": np.arange(len(units), dtype=np.int32), "units": units}
                yield pd.DataFrame(entries)

        sums = features.mapInPandas(task, "name string, entry int, units long")
        # One row per entry of the arrays, whatever the number of documents.
        found = sums.groupBy("name", "entry").agg(F.sum("units").alias("units")).toPandas()
        return {
            name: part.sort_values("entry")["units"].to_numpy() / _UNIT
            for name, part in found.groupby("name")
        }

    def or_nothing(function):
        nothing = Batch(
            {"text": np.zeros((0, TEXT_WIDTH)), "page": np.zeros((0, PAGE_WIDTH))},
            np.zeros(0, np.int64),
            np.zeros(0, bool),
        )
        return {**{name: values.astype(float) for name, values in function(nothing)}, **run(function)}

    return or_nothing


_INPUTS = (("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "double"))


def _inputs(docs: DataFrame):
    """What the views read, null where docs lack the column."""
    return [
        (column(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in _INPUTS
    ]


def featured(docs: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """Stored: per row of docs its doc_id, features, label (-1 unknown) and whether it is held back.

    A document labelled several times takes the majority (a tie is good); null labels are
    ignored.
    """
    ship_library(docs.sparkSession)

    @F.pandas_udf("text binary, page binary")
    def features(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        batch = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        found: dict[str, list[bytes]] = {"text": [], "page": []}
        for start in range(0, len(batch), _ROWS):
            for view, x in _views(batch[start : start + _ROWS]).items():
                found[view] += [row.tobytes() for row in x]
        return pd.DataFrame(found)

    known = (
        labels.where(column(doc_id).isNotNull() & column(label).isNotNull())
        .groupBy(column(doc_id).alias("id"))
        .agg((F.avg(column(label)) >= 0.5).cast("int").alias("label"))
    )
    rows = docs.select(column(doc_id).alias("doc_id"), features(*_inputs(docs)).alias("found"))
    held = F.col("label").isNotNull() & (F.pmod(F.xxhash64("id", F.lit("held")), F.lit(HELD)) == 0)
    return stored(
        rows.join(known, F.col("doc_id") == F.col("id"), "left").select(
            "doc_id", "found.text", "found.page", F.coalesce("label", F.lit(-1)).alias("label"), held.alias("held")
        )
    )


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> CoTrained:
    """Fit on all documents. Without labels of both classes every document gets the odds of
    what was seen, so an empty table of labels rejects nothing."""
    return co_train(_summed(featured(docs, labels, doc_id, label)))


def _scored(frame: pd.DataFrame, model: CoTrained, views) -> pd.DataFrame:
    names = ("p_text", "p_page", "score")
    found = [pd.DataFrame({name: [] for name in names}, dtype=float)]
    for start in range(0, len(frame), _ROWS):
        x = views(frame[start : start + _ROWS])
        scores = model.score(x["text"].astype(float), x["page"].astype(float))
        found.append(pd.DataFrame(dict(zip(names, scores))))
    return pd.concat(found, ignore_index=True)


def score_quality(docs: DataFrame, model: CoTrained) -> DataFrame:
    """docs with p_text, p_page and score in one struct column `quality_scores`."""
    ship_library(docs.sparkSession)

    @F.pandas_udf("p_text double, p_page double, score double")
    def scores(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        batch = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        return _scored(batch, model, _views)

    return docs.select(*(column(c) for c in docs.columns), scores(*_inputs(docs)).alias(SCORES))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    label: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: doc_id, p_text, p_page, score, keep.

    Null, empty and very long texts are scored like any other; null metadata has features of
    its own. Rows without a doc_id have no label. Repeated rows are scored each; an
    empty table gives an empty result.
    """
    features = featured(docs, labels, doc_id, label)
    model = co_train(_summed(features))

    @F.pandas_udf("p_text double, p_page double, score double")
    def scores(text: pd.Series, page: pd.Series) -> pd.DataFrame:
        def views(part: pd.DataFrame) -> dict[str, np.ndarray]:
            return {
                name: np.frombuffer(b"".join(part[name]), np.float16).reshape(len(part), -1)
                for name in ("text", "page")
            }

        return _scored(pd.DataFrame({"text": text, "page": page}), model, views)

    scored = features.select("doc_id", scores("text", "page").alias(SCORES))
    return scored.select(
        "doc_id", f"{SCORES}.*", (F.col(f"{SCORES}.score") >= threshold).alias("keep")
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    label: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of docs that are not rejected, with all their columns; cases as in classify."""
    model = fit_quality(docs, labels, doc_id, label)
    read = [c for c, _ in _INPUTS if c in docs.columns]
    others = [c for c in docs.columns if c not in read]
    # The text travels once; only what is not read is packed.
    rows = docs.select(packed(others).alias("row"), *map(column, read))
    good = score_quality(rows, model).where(F.col(f"{SCORES}.score") >= threshold)
    restored = dict(zip(others, unpacked(others, "row")))
    return good.select(*(restored.get(c, column(c)) for c in docs.columns))

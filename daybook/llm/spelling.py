"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

A word's vector counts its letters. One letter replaced moves a vector by an L1
distance of at most two, one inserted or deleted by one. So for each pair of lengths a
range search finds all candidates: its own length within two, the next length
within one. A tree's node knows the box of its vectors; queries that are too far from
the box leave it out as a whole. What the search finds is verified letter by letter.

Words of a length are dealt to tasks by the upper part of its tree, which is fitted on a
sample of about SAMPLE words of all lengths; every word is in exactly one of its cells, and asks
every cell whose region its range reaches. Lower nodes are built within the
tasks. A wrong sample makes cells uneven, never a result wrong.

Tasks report counts and best variants by word, not pairs.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import bounded_sample, column, ship_library, stored

MIN_LENGTH, MIN_COUNT = 6, 5
# Of so many spellings in a document one loses a letter.
DAMAGE = 199
# A form is at least so many times as frequent as its variant.
DOMINANCE = 5

SAMPLE = 20_000
# Words a cell should hold, and a tree's leaf.
CELL, LEAF = 8192, 24
# a-z, and all other letters by their codes: merging letters never makes a distance larger.
DIMENSIONS = 32
_PAIRS_AT_A_TIME = 1 << 20
_CACHED = 100_000

_RUN = re.compile(rb"[a-z\xc0-\xff]+")
_SLOT = np.full(256, -1, np.int64)
_SLOT[97:123] = np.arange(26)
_SLOT[0xC0:] = 26 + np.arange(64) % (DIMENSIONS - 26)


def spellings(text: str, prefix: int) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, occurrences) for the runs of letters of a text, some of them damaged.

    prefix is the crc32 of what comes before a run in the hash that decides on damage. Words
    that turn out too short are left out.
    """
    # Letters of a run are all in Latin-1, and lower() of bytes changes A-Z alone.
    runs = Counter(_RUN.findall(text.encode("latin-1", "replace").lower()))
    for run, n in runs.items():
        length = len(run)
        if length < MIN_LENGTH:
            continue
        spelled = run if run.isascii() else run.decode("latin-1").encode()
        h = zlib.crc32(spelled, prefix)
        if h % DAMAGE == 0:
            if length == MIN_LENGTH:
                continue
            cut = h % length
            run = run[:cut] + run[cut + 1 :]
        yield run, n


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored: (word, n) for words of at least MIN_LENGTH letters that occur MIN_COUNT times."""
    ship_library(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()

        def emit() -> pd.DataFrame:
            words = [word.decode("latin-1") for word in counts]
            return pd.DataFrame({"word": words, "n": np.fromiter(counts.values(), np.int64, len(counts))})

        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                if text is None:
                    continue
                prefix = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in spellings(text, prefix):
                    counts[word] += n
                if len(counts) > _CACHED:
                    yield emit()
                    counts.clear()
        if counts:
            yield emit()

    rows = docs.select(column(doc_id).cast("string").alias("id"), column(text).alias("text"))
    found = rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(found.where(F.col("n") >= MIN_COUNT))


# Vectors and trees


def encoded(words: list[str]) -> np.ndarray:
    """Letters of words of one length, a row each."""
    joined = "".join(words).encode("latin-1")
    return np.frombuffer(joined, np.uint8).reshape(len(words), -1)


def letter_counts(words: list[str]) -> np.ndarray:
    """The vectors of words of one length."""
    letters = _SLOT[encoded(words)]
    rows = np.arange(len(words))[:, None] * DIMENSIONS
    counts = np.bincount((letters + rows).ravel(), minlength=len(words) * DIMENSIONS)
    return counts.reshape(len(words), DIMENSIONS).astype(np.int32)


def _beyond(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance of each query from a box."""
    return np.maximum(low - queries, 0).sum(1) + np.maximum(queries - high, 0).sum(1)


def _split(points: np.ndarray) -> tuple[int, int] | None:
    """A dimension, and the value up to which points go to the left; None if all are alike."""
    for dimension in np.argsort(-points.std(0), kind="stable"):
        values = points[:, dimension]
        if values.min() == values.max():
            return None
        value = int(np.partition(values, len(values) // 2)[len(values) // 2])
        return int(dimension), value if value < values.max() else value - 1
    return None


def search(points: np.ndarray, queries: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of queries, places of points) of all that lie within reach of each other."""
    todo = [(np.arange(len(points)), np.arange(len(queries)))]
    while todo:
        own, asking = todo.pop()
        inside = points[own]
        near = _beyond(queries[asking], inside.min(0), inside.max(0)) <= reach
        asking = asking[near]
        if not len(asking):
            continue
        cut = _split(inside) if len(own) > LEAF else None
        if cut is not None:
            left = inside[:, cut[0]] <= cut[1]
            todo += [(own[left], asking), (own[~left], asking)]
            continue
        step = max(1, _PAIRS_AT_A_TIME // (len(own) * DIMENSIONS))
        for start in range(0, len(asking), step):
            some = asking[start : start + step]
            distance = np.abs(queries[some][:, None, :] - inside[None]).sum(2)
            a, b = np.nonzero(distance <= reach)
            if len(a):
                yield some[a], own[b]


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of one length (rows of letters) differ in exactly one place."""
    return (a != b).sum(1) == 1


def inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether a letter taken from the longer word gives the shorter one."""
    length = short.shape[1]
    same_front = np.cumprod(short == long[:, :length], axis=1).sum(1)
    same_back = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return same_front + same_back >= length


def _verified(pairs, first: np.ndarray, second: np.ndarray, check) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of places whose words pass the check, some at a time."""
    step = max(1, _PAIRS_AT_A_TIME // max(1, second.shape[1]))
    for a, b in pairs:
        for start in range(0, len(a), step):
            x, y = a[start : start + step], b[start : start + step]
            right = check(first[x], second[y])
            if right.any():
                yield x[right], y[right]


class _Best:
    """By word, the number of its near words and the best of them."""

    def __init__(self, words: np.ndarray, n: np.ndarray):
        self.words, self.n = words, n
        # Places from the best on: most frequent, then first in code-point order.
        self.order = np.lexsort((words, -n))
        self.rank = np.empty(len(words), np.int64)
        self.rank[self.order] = np.arange(len(words))

    def of(self, pairs: list[tuple[np.ndarray, np.ndarray]], count: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of count others: how many of these words it is near to, the place of the best."""
        near, best = np.zeros(count, np.int64), np.full(count, len(self.words))
        for other, own in pairs:
            near += np.bincount(other, minlength=count)
            np.minimum.at(best, other, self.rank[own])
        return near, self.order[np.minimum(best, len(self.words) - 1)]


_NEAR = "word string, n_near long, form string, form_n long"


def _near_in_cell(cell: pd.DataFrame) -> pd.DataFrame:
    """Near words between a cell's points and the words that ask it; a row by word."""
    found = [pd.DataFrame({"word": [], "n_near": [], "form": [], "form_n": []})]
    points = cell[cell["kind"] == 0].reset_index(drop=True)
    if len(points):
        words, n = points["word"].to_numpy(object), points["n"].to_numpy(np.int64)
        vectors, letters, best = letter_counts(list(words)), encoded(list(words)), _Best(words, n)

        def add(of: pd.DataFrame, pairs: list, among: _Best) -> None:
            near, place = among.of(pairs, len(of))
            some = np.flatnonzero(near)
            found.append(
                pd.DataFrame(
                    {
                        "word": of["word"].to_numpy(object)[some],
                        "n_near": near[some],
                        "form": among.words[place[some]],
                        "form_n": among.n[place[some]],
                    }
                )
            )

        same = cell[cell["kind"] == 1].reset_index(drop=True)
        if len(same):
            asked = list(same["word"])
            pairs = search(vectors, letter_counts(asked), 2)
            add(same, list(_verified(pairs, encoded(asked), letters, replaced)), best)
        shorter = cell[cell["kind"] == 2].reset_index(drop=True)
        if len(shorter):
            asked = list(shorter["word"])
            pairs = search(vectors, letter_counts(asked), 1)
            pairs = list(_verified(pairs, encoded(asked), letters, inserted))
            add(shorter, pairs, best)
            back = [(own, other) for other, own in pairs]
            add(points, back, _Best(shorter["word"].to_numpy(object), shorter["n"].to_numpy(np.int64)))
    kinds = {"word": object, "n_near": "int64", "form": object, "form_n": "int64"}
    return pd.concat(found, ignore_index=True).astype(kinds)


# The upper tree


class UpperTree:
    """Splits of the space of vectors into cells; every vector is in one, a range reaches several."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.cells = 0
        self.root = self._grow(sample, depth)

    def _grow(self, points: np.ndarray, depth: int):
        cut = _split(points) if depth and len(points) > 1 else None
        if cut is None:
            self.cells += 1
            return self.cells - 1
        left = points[:, cut[0]] <= cut[1]
        return (*cut, self._grow(points[left], depth - 1), self._grow(points[~left], depth - 1))

    def reached(self, vectors: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of vector, cell) for every cell that its range reaches."""
        found = []
        everywhere = np.full((2, DIMENSIONS), -1)
        everywhere[1] = np.iinfo(np.int32).max
        todo = [(self.root, np.arange(len(vectors)), everywhere)]
        while todo:
            node, own, box = todo.pop()
            own = own[_beyond(vectors[own], box[0], box[1]) <= reach]
            if not len(own):
                continue
            if isinstance(node, int):
                found.append((own, np.full(len(own), node)))
                continue
            dimension, value, left, right = node
            low, high = box.copy(), box.copy()
            low[1, dimension], high[0, dimension] = value, value + 1
            todo += [(left, own, low), (right, own, high)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _upper_trees(words: DataFrame, sample: int, cell: int) -> dict[int, UpperTree]:
    """A tree for each length of more words than a cell takes, fitted on its words in a sample."""
    sizes = words.groupBy(F.length("word").alias("length")).count().where(F.col("count") > cell)
    large = {row["length"]: row["count"] for row in sizes.collect()}  # a row for `cell` words at least
    if not large:
        return {}
    some = bounded_sample(words.where(F.length("word").isin(list(large))).select("word"), sample)
    found = pd.Series([row.word for row in some.collect()], dtype=object)
    return {
        length: UpperTree(letter_counts(list(part)), int(np.ceil(np.log2(large[length] / cell))))
        for length, part in found.groupby(found.str.len())
    }


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """(word, n_near, form, form_n): the number of near words, and the most frequent of them (ties: the first
    in code-point order) with its n, for each of the stored words (word, n) that has any."""
    ship_library(words.sparkSession)
    trees = _upper_trees(words, sample, cell)
    whole = UpperTree(np.zeros((0, DIMENSIONS), np.int32), 0)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby(batch["word"].str.len()):
                step = max(1, _PAIRS_AT_A_TIME // length)
                for start in range(0, len(part), step):
                    some = part[start : start + step]
                    vectors = letter_counts(list(some["word"]))
                    # A word's own cell; the cells of its length; those of the next.
                    for kind, (of, reach) in enumerate(((length, 0), (length, 2), (length + 1, 1))):
                        place, cell_of = trees.get(of, whole).reached(vectors, reach)
                        yield pd.DataFrame(
                            {
                                "length": np.full(len(place), of),
                                "cell": cell_of,
                                "kind": np.full(len(place), kind),
                                "word": some["word"].to_numpy(object)[place],
                                "n": some["n"].to_numpy(np.int64)[place],
                            }
                        )

    dealt = words.select("word", "n").mapInPandas(deal, "length int, cell int, kind int, word string, n long")
    partial = dealt.groupBy("length", "cell").applyInPandas(_near_in_cell, _NEAR)
    # The most frequent, then the first.
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return (
        partial.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for stored (word, form): the last form that forms lead to.

    Each round doubles the steps a word has gone; n grows fivefold with every step, so
    rounds are few.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        following = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(reached.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        reached = moved.select("word", "root")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, some of them damaged
    (see spellings), of at least MIN_LENGTH letters and MIN_COUNT occurrences. Near words
    differ by one letter inserted, deleted or replaced. form is the most frequent near word (ties: the
    first in code-point order) if it is at least DOMINANCE times as frequent; root is where forms
    lead, the word itself without a form. Whole texts are read; a null text has no words; a
    null doc_id is an empty one; repeated rows count each; an empty table gives no
    words; other columns are ignored.
    """
    words = count_words(docs, doc_id, text)
    near = near_words(words)
    dominant = F.col("form_n") >= DOMINANCE * F.col("n")
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(dominant, F.col("form")).alias("form"),
            F.when(dominant, F.col("form_n")).alias("form_n"),
        )
    )
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

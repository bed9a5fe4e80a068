"""Ranked lexical search: exact inner products through sparse ball trees.

A document is a sparse vector of the impacts of its terms, each times the term's weight; an
item is the vector with a one at each of its terms, so their inner product is the
score. Only terms of items matter, so vectors hold nothing else.

Documents are dealt to buckets: first to the nearest centroid of a ball tree over a sample,
then, as a cell may be large, by a hash. Each bucket is a ball tree of its own, built in
a task. A node knows its centroid and, for groups of terms that occur together, the radius
around it within the group; no score below the node can exceed the centroid's score
plus, by group, the radius times the root of the number of the item's terms there.
An item visits nodes from the highest bound on and stops where the bound falls under its
50th score so far. Bounds are rounded up. Leaves are scored exactly, in integers.

The search starts from the 50th score that each item reaches in the sample, whose
documents are part of the corpus, so this can't lose any result. Sample and centroids
only decide how fast the search is.
"""

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from daybook.llm.common import bounded_sample, column, ship_library, stored

TOP = 50
# Documents that centroids are fitted on, and that give first bounds.
SAMPLE = 2048
CELLS, GROUPS = 32, 8
# Entries of vectors in a bucket, documents in a leaf.
BUCKET_ENTRIES = 1 << 19
LEAF = 64
# Pairs of an item and its term that are searched at a time.
BLOCK_TERMS = 500_000
# Added to squared radii, relative to the squares they come from, and to bounds: more than
# sums of so many doubles can err.
_SLACK = 1e-9

# Bytes of words stay, A-Z in lower case; all others part words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, with repeats: runs of digits, letters and characters beyond ASCII."""
    return text.encode().translate(_WORD_BYTES).split()


def weight(n_docs: int, holding: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * holding + 1))).astype(np.int64)


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Rows:
    """Sparse rows: entries start[i] to start[i + 1] are those of row i."""

    start: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> "Rows":
        sizes = self.start[rows + 1] - self.start[rows]
        start = np.concatenate(([0], np.cumsum(sizes)))
        entries = np.arange(start[-1]) + np.repeat(self.start[rows] - start[:-1], sizes)
        return Rows(start, self.term[entries], self.value[entries])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of one value for each entry, by row; doubles are never added across rows."""
        if values.dtype.kind == "f":
            return np.bincount(self.of_row(), values, minlength=len(self))
        total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
        return total[self.start[1:]] - total[self.start[:-1]]

    def of_row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.start))


def _rows(terms: list[np.ndarray], values: list[np.ndarray]) -> Rows:
    sizes = [len(x) for x in terms]
    empty = [np.zeros(0, np.int64)]
    return Rows(
        np.concatenate(([0], np.cumsum(sizes))).astype(np.int64),
        np.concatenate([*terms, *empty]).astype(np.int64),
        np.concatenate([*values, *empty]).astype(np.int64),
    )


@dataclass
class Corpus:
    """What scores need from all documents."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    def contributions(self, vectors: Rows, n: np.ndarray) -> Rows:
        """Rows of what each term adds to a score, from rows of occurrences."""
        per_entry = np.repeat(n, np.diff(vectors.start))
        worth = impact(vectors.value, per_entry, self.n_docs, self.n_terms)
        return Rows(vectors.start, vectors.term, self.weights[vectors.term] * worth)


# Ball trees


def _split(x: Rows, dense: np.ndarray, centroid: np.ndarray) -> np.ndarray | None:
    """Which rows are nearer to one of two far ones; None if all are alike."""

    def distances(point: np.ndarray) -> np.ndarray:
        squares = x.sums(x.value.astype(float) ** 2)
        return np.maximum(squares - 2 * x.sums(x.value * point[x.term]) + point @ point, 0)

    def row(i: int) -> np.ndarray:
        dense[:] = 0
        own = slice(x.start[i], x.start[i + 1])
        dense[x.term[own]] = x.value[own]
        return dense

    first = int(np.argmax(distances(centroid)))
    from_first = distances(row(first))
    second = int(np.argmax(from_first))
    if from_first[second] <= _SLACK * max(1.0, from_first.max(), centroid @ centroid):
        return None
    side = distances(row(second)) - from_first
    near = side > np.median(side)
    if not near.any() or near.all():
        near = side > side.min()
    return near if near.any() and not near.all() else None


def _centroid(x: Rows, width: int) -> np.ndarray:
    return np.bincount(x.term, x.value, minlength=width) / max(1, len(x))


def sample_cells(x: Rows, width: int, cells: int) -> list[np.ndarray]:
    """Rows of each cell: the largest is split until there are enough."""
    parts, dense = [np.arange(len(x))], np.zeros(width)
    while len(parts) < cells:
        parts.sort(key=len)
        part = parts.pop()
        own = x.take(part)
        near = _split(own, dense, _centroid(own, width)) if len(part) > 1 else None
        if near is None:
            parts.append(part)
            break
        parts += [part[near], part[~near]]
    return parts


class BallTree:
    """A tree over contribution rows, with the bound of each node for each item."""

    def __init__(self, x: Rows, items: Rows, group: np.ndarray, leaf: int = LEAF):
        width = len(group)
        self.x, self.leaf_rows, self.children = x, {}, {}
        # Roots of how many of an item's terms are in each group, and in all.
        in_group = np.zeros((len(items), GROUPS))
        np.add.at(in_group, (items.of_row(), group[items.term]), 1)
        roots, root = np.sqrt(in_group), np.sqrt(in_group.sum(1))
        bounds, dense = [], np.zeros(width)
        todo = [(np.arange(len(x)), -1)]
        while todo:
            rows, parent = todo.pop()
            node = len(bounds)
            if parent >= 0:
                self.children.setdefault(parent, []).append(node)
            own = x.take(rows)
            centroid = _centroid(own, width)
            # Squares of distances from the centroid, by group: (x - c)^2 = x^2 - 2xc + c^2.
            per_group = np.bincount(group, centroid**2, minlength=GROUPS)
            value = own.value.astype(float)
            cell = own.of_row() * GROUPS + group[own.term]
            size = len(own) * GROUPS
            squares = np.bincount(cell, value**2, minlength=size).reshape(-1, GROUPS)
            crossed = np.bincount(cell, value * centroid[own.term], minlength=size).reshape(-1, GROUPS)
            apart = np.maximum(squares - 2 * crossed + per_group, 0) + _SLACK * (squares + per_group)
            radii, radius = np.sqrt(apart.max(0)), np.sqrt(apart.sum(1).max())
            middle = items.sums(centroid[items.term])
            bounds.append((middle + np.minimum(roots @ radii, root * radius)) * (1 + _SLACK) + 1)
            near = _split(own, dense, centroid) if len(rows) > leaf else None
            if near is None:
                self.leaf_rows[node] = rows
            else:
                todo += [(rows[near], node), (rows[~near], node)]
        self.bounds = np.array(bounds)
        self.leaves_scored = 0

    def best(self, item: int, terms: np.ndarray, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of at least `least`, with all of the best `top` and their ties among them."""
        wanted = np.zeros(len(self.x.term) and int(self.x.term.max()) + 1, np.int64)
        wanted[terms[terms < len(wanted)]] = 1
        found_rows, found_scores, kept = [], [], np.zeros(0, np.int64)
        queue = [(-self.bounds[0, item], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least:
                break
            if node in self.children:
                for child in self.children[node]:
                    heapq.heappush(queue, (-self.bounds[child, item], child))
                continue
            rows = self.leaf_rows[node]
            own = self.x.take(rows)
            scores = own.sums(wanted[own.term] * own.value)
            self.leaves_scored += 1
            good = scores >= least
            found_rows.append(rows[good])
            found_scores.append(scores[good])
            kept = np.concatenate((kept, scores[good]))
            if len(kept) > top:
                kept = np.partition(kept, len(kept) - top)[len(kept) - top :]
            if len(kept) == top:
                least = max(least, int(kept.min()))
        rows = np.concatenate([np.zeros(0, np.int64), *found_rows])
        scores = np.concatenate([np.zeros(0, np.int64), *found_scores])
        good = scores >= least
        return rows[good], scores[good]


# On Spark


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """Stored: doc_id, n, and terms and tfs of the vocabulary's terms, for documents with a term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = known.value
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch[start : start + 500]
                n, terms, tfs = [], [], []
                for value in part["text"]:
                    words = terms_of(value or "")
                    found = Counter(filter(number.__contains__, words))
                    n.append(len(words))
                    terms.append([number[word] for word in found])
                    tfs.append(list(found.values()))
                rows = {"doc_id": part["doc_id"].to_numpy(object), "n": n, "terms": terms, "tfs": tfs}
                yield pd.DataFrame(rows).loc[lambda x: x["n"] > 0]

    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInPandas(count, f"doc_id {kind}, n long, terms array<int>, tfs array<long>"))


def _sparse(frame: pd.DataFrame) -> tuple[Rows, np.ndarray]:
    return _rows(list(frame["terms"]), list(frame["tfs"])), frame["n"].to_numpy(np.int64)


def _search_block(docs, items: pd.DataFrame, doc_id: str, text: str, top: int, sample: int) -> DataFrame:
    """(item, doc_id, score) of each item's best documents; items has item and terms (bytes)."""
    spark = docs.sparkSession
    vocabulary = {term: i for i, term in enumerate(sorted({t for terms in items["terms"] for t in terms}))}
    width = len(vocabulary)
    asked = [np.array(sorted(vocabulary[t] for t in terms), np.int64) for terms in items["terms"]]
    vectors = _vectors(docs, vocabulary, doc_id, text)
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(width, np.int64)
    # One row per term of the block.
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holding[row["term"]] = row["count"]
    corpus = Corpus(n_docs, max(1, n_terms), weight(n_docs, holding))

    some = vectors.where(F.size("terms") > 0)
    picked = bounded_sample(some.select("n", "terms", "tfs"), sample).toPandas()
    x = corpus.contributions(*_sparse(picked))
    cells = sample_cells(x, width, CELLS)
    centroids = np.array([_centroid(x.take(rows), width) for rows in cells])
    # Terms belong to the group of cells where they weigh most.
    coarse = sample_cells(x, width, GROUPS)
    mass = np.array([_centroid(x.take(rows), width) for rows in coarse])
    group = np.where(mass.max(0) > 0, mass.argmax(0), np.arange(width) % len(coarse)) if width else np.zeros(0, int)
    questions = _rows(asked, asked)
    least = np.ones(len(asked), np.int64)
    for item, terms in enumerate(asked):
        wanted = np.zeros(width, np.int64)
        wanted[terms] = 1
        scores = x.sums(wanted[x.term] * x.value)
        if len(scores) >= top:
            least[item] = max(1, np.partition(scores, len(scores) - top)[len(scores) - top])
    shared = spark.sparkContext.broadcast((corpus, centroids, group, questions, least, items["item"].to_numpy()))

    @F.pandas_udf("int")
    def nearest(n: pd.Series, terms: pd.Series, tfs: pd.Series) -> pd.Series:
        corpus, centroids = shared.value[:2]
        frame = pd.DataFrame({"n": n, "terms": terms, "tfs": tfs})
        found = [np.zeros(0, np.int64)]
        own = (centroids**2).sum(1)
        for start in range(0, len(frame), 200):
            x = corpus.contributions(*_sparse(frame[start : start + 200]))
            near = np.stack([x.sums(x.value * centroid[x.term]) for centroid in centroids], axis=1)
            found.append(np.argmin(own - 2 * near, axis=1))
        return pd.Series(np.concatenate(found), dtype="int32")

    dealt = stored(some.withColumn("cell", nearest("n", "terms", "tfs")))
    sizes = dealt.groupBy("cell").agg(F.ceil(F.sum(F.size("terms")) / BUCKET_ENTRIES).cast("int").alias("parts"))
    parts = {row["cell"]: row["parts"] for row in sizes.collect()}  # a row per cell
    salts = F.create_map(*(F.lit(v) for pair in parts.items() for v in pair)) if parts else F.create_map(F.lit(0), F.lit(1))
    salt = F.pmod(F.xxhash64("doc_id", "n", F.monotonically_increasing_id()), salts[F.col("cell")])
    kind = dealt.schema["doc_id"].dataType.simpleString()

    def search(bucket: pd.DataFrame) -> pd.DataFrame:
        corpus, _, group, questions, least, numbers = shared.value
        x = corpus.contributions(*_sparse(bucket))
        tree = BallTree(x, questions, group)
        ids = bucket["doc_id"].to_numpy(object)
        found = []
        for item in range(len(questions)):
            terms = questions.term[questions.start[item] : questions.start[item + 1]]
            rows, scores = tree.best(item, terms, int(least[item]), top)
            found.append(pd.DataFrame({"item": np.full(len(rows), numbers[item]), "doc_id": ids[rows], "score": scores}))
        return pd.concat(found, ignore_index=True).astype({"item": "int64", "doc_id": object, "score": "int64"})

    buckets = dealt.withColumn("salt", salt).groupBy("cell", "salt")
    found = buckets.applyInPandas(search, f"item long, doc_id {kind}, score long")
    # Ranks 1 to `top` are cut within each task first, then over all.
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


def ranked_search(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    sample: int = SAMPLE,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per item its highest-scoring documents with a score above 0: item_id, rank, doc_id, score.

    Equal scores rank by ascending doc_id, null last. Rows that repeat an item or a document are
    items and documents of their own. Null and empty texts have no terms: such items have no
    rows, such documents are never found and don't count. Texts are read whole. Empty
    tables give no rows; other columns are ignored.

    Items are searched in blocks of about block_terms terms, which bounds what tasks are sent.
    """
    spark = docs.sparkSession
    ship_library(spark)

    @F.pandas_udf("array<binary>")
    def distinct_terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(terms_of(value or ""))) for value in texts])

    items = stored(
        benchmark.select(column(item_id).alias("item_id"), distinct_terms(column(item_text)).alias("terms"))
        .where(F.size("terms") > 0)
        .withColumn("item", F.monotonically_increasing_id())
    )
    total = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_terms))
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "terms").toPandas()
        if len(own):
            ranked = _search_block(docs, own, doc_id, text, top, sample)
            found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        kinds = {**dict(benchmark.dtypes), **{f"doc {k}": v for k, v in docs.dtypes}}
        return spark.createDataFrame([], f"item_id {kinds[item_id]}, rank int, doc_id {kinds['doc ' + doc_id]}, score long")
    return found.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

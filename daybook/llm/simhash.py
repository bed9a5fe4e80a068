"""Near duplicates by SimHash, searched through indexes in Gray order.

Fingerprints are indexed once for every pair of six bit blocks: two fingerprints
with at most four differing bits agree in at least two of the blocks. Such a pair's
bits are the mask of the index's upper nodes; all fingerprints below a node share
that pattern, so a search opens only the one node with its own pattern, and all others
are pruned without a look. Within a node the fingerprints are sorted by Gray rank,
which puts those that differ in few bits side by side, and form a tree whose nodes are
again described by the bits that all below share; the differences in those bits
accumulate on the way down, and a node with too many is passed over as a whole.

A node of very many fingerprints is cut into parts, and each pair of parts is searched by
a task of its own. Equal fingerprints count once throughout. A node reports links that
connect what belongs together, not every pair.
"""

import xxhash
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import column, packed, ship_library, stored, unpacked
from daybook.llm.components import connected

SHINGLE_WORDS = 4
MAX_DIFFERENCES = 4
SEED = 42
BITS = 64

# Two more blocks than differences: some two blocks always agree.
_BLOCKS = MAX_DIFFERENCES + 2
# Fingerprints of a node that are searched together; larger nodes are cut into parts.
PART_SIZE = 4096
# Children of a node of an index's tree.
_CHILDREN = 16
_EACH = np.arange(_CHILDREN)


# Hashes of a text held at a time.
_HASHES = 65536


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """The hashes of the text's shingles, in order, some at a time.

    A-Z are lower-cased; words are parted by ASCII white space; fewer words than a
    shingle takes are one shingle; no words give none.
    """
    parts = text.encode().lower().split()
    if not parts:
        return
    joined = b" ".join(parts)
    ends = np.cumsum([len(part) + 1 for part in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    starts, ends = starts[: len(parts) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    for first in range(0, len(starts), _HASHES):
        some = slice(first, first + _HASHES)
        pairs = zip(starts[some].tolist(), ends[some].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=">u8")


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """Bits set in more than half of the hashes of the text's shingles; 0 without words."""
    counts, total = np.zeros(BITS, np.int64), 0
    for some in shingle_hashes(text, words):
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        total += len(some)
    bits = np.packbits(2 * counts > total)
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: doc_id and fingerprint, a long with the same 64 bits."""
    ship_library(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(value or "") for value in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return docs.select(column(doc_id).alias("doc_id"), of(column(text)).alias("fingerprint"))


# Index


def masks(blocks: int = _BLOCKS, agreeing: int = 2) -> list[int]:
    """The bits of every choice of two blocks of the 64 bits."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    of = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(of, agreeing)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each bit pattern in the reflected Gray sequence."""
    rank = values.copy()
    shift = 1
    while shift < BITS:
        rank ^= rank >> np.uint64(shift)
        shift *= 2
    return rank


class GrayIndex:
    """A tree over fingerprints in Gray order; each of its nodes knows the bits that all below it share."""

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        # From the root down: (pattern, mask) of every node, the children of one side by side.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        every = some = self.values
        while not self.levels or len(every) > 1:
            starts = np.arange(0, len(every), _CHILDREN)
            every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
            mask = ~(every ^ some)
            self.levels.insert(0, (every & mask, mask))

    def near(self, value: np.uint64) -> np.ndarray:
        """Places of fingerprints with at most MAX_DIFFERENCES differing bits.

        A node's mask holds that of the node above, so differences accumulate on the way
        down, and a node with too many is left with all below it.
        """
        nodes = np.zeros(1, np.int64)
        sizes = [len(pattern) for pattern, _ in self.levels[1:]] + [len(self.values)]
        for (pattern, mask), below in zip(self.levels, sizes):
            nodes = nodes[np.bitwise_count((value ^ pattern[nodes]) & mask[nodes]) <= MAX_DIFFERENCES]
            if not len(nodes):
                return nodes
            nodes = (nodes[:, None] * _CHILDREN + _EACH).ravel()
            nodes = nodes[nodes < below]
        return nodes[np.bitwise_count(self.values[nodes] ^ value) <= MAX_DIFFERENCES]

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that join all fingerprints which near ones connect."""
        group = np.arange(len(self.values))
        for place, value in enumerate(self.values):
            near = self.near(value)
            near = near[group[near] != group[place]]
            while len(near):
                other = near[0]
                yield int(self.values[place]), int(self.values[other])
                group[group == group[other]] = group[place]
                near = near[group[near] != group[place]]


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links within each cell of rows that are sorted by cell.

    A cell may go on in the next batch; cells are bounded by the size of parts.
    """
    rest = np.empty((0, 4), np.int64)
    names = ["mask", "pattern", "part", "value"]

    def emit(rows: np.ndarray) -> Iterator[pd.DataFrame]:
        if len(rows) < 2:
            return
        changes = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        starts = np.concatenate(([0], changes))
        sizes = np.diff(np.concatenate((starts, [len(rows)])))
        values = np.ascontiguousarray(rows[:, 3]).view(np.uint64)
        found = []
        for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            found += GrayIndex(values[start : start + size]).links()
        if found:
            pairs = np.array(found, dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    for batch in batches:
        rows = np.concatenate([rest, batch[names].to_numpy(np.int64)])
        last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1)) if len(rows) else []
        cut = last[-1] + 1 if len(last) else 0
        yield from emit(rows[:cut])
        rest = rows[cut:]
    yield from emit(rest)


def near_links(distinct: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """(a, b): links that connect all fingerprints which near ones connect.

    distinct has one row per fingerprint.
    """
    ship_library(distinct.sparkSession)
    value = F.col("fingerprint")
    upper = F.array(
        *(
            F.struct(F.lit(i).alias("mask"), value.bitwiseAND(F.lit(_signed(m))).alias("pattern"))
            for i, m in enumerate(masks())
        )
    )
    entries = distinct.select(F.inline(upper), value.alias("value"))
    sizes = entries.groupBy("mask", "pattern").agg(F.count("*").alias("n"))
    # Nodes of one fingerprint have nothing to search.
    nodes = stored(
        sizes.where("n > 1").select(
            "mask", "pattern", F.ceil(F.col("n") / part_size).cast("int").alias("parts")
        )
    )
    shared = entries.join(nodes, ["mask", "pattern"])
    # Each part meets each other part, and itself, in a cell of their own.
    own = F.pmod(F.xxhash64("value"), F.col("parts")).cast("int")
    cells = shared.withColumn("own", own).select(
        "mask",
        "pattern",
        "value",
        F.explode(
            F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.col("parts") - 1),
                    lambda other: F.least("own", other).cast("long") * F.col("parts")
                    + F.greatest("own", other),
                )
            )
        ).alias("part"),
    )
    return (
        cells.repartition("mask", "pattern", "part")
        .sortWithinPartitions("mask", "pattern", "part")
        .select("mask", "pattern", "part", "value")
        .mapInPandas(_search, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part_size: int = PART_SIZE
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id.

    Whole texts are read; null counts as empty, and all empty texts have fingerprint
    0. Fingerprints with at most MAX_DIFFERENCES differing bits are linked;
    component_id is the smallest doc_id that links lead to, the row's own included (null
    only if all are). Repeated rows each get a row. An empty table gives an empty
    result; other columns are ignored.
    """
    marked = stored(fingerprints(docs, doc_id, text))
    distinct = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    smallest = connected(near_links(distinct, part_size))
    root = F.coalesce(F.col("b"), F.col("fingerprint"))
    rooted = distinct.join(smallest, F.col("fingerprint") == F.col("a"), "left").select(
        "fingerprint", "first", root.alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    components = stored(
        rooted.drop("first").join(firsts, "root").select("fingerprint", "component_id")
    )
    return marked.join(components, "fingerprint").select(
        "doc_id", _hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def _hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Of each component the row with the smallest doc_id, with all its columns.

    Rows without a doc_id can't be told apart and all stay; so do rows that repeat the
    doc_id that stays.
    """
    found = near_duplicates(docs, doc_id, text)
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("dropped"))
    rows = docs.select(packed(docs.columns).alias("row"), column(doc_id).alias("id"))
    kept = rows.join(dropped, F.col("id") == F.col("dropped"), "left_anti")
    return kept.select(*unpacked(docs.columns, "row"))

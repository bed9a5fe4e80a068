"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from daybook.llm import lexical
from tests.llm.test_documents import ROWS, empty, frame

ITEMS = "item_id long, text string"


def brute_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def expected(rows, items, top=50):
    docs = [(r[0], brute_terms(r[1])) for r in rows]
    docs = [(i, Counter(words), len(words)) for i, words in docs if words]
    count, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, counts, n in docs:
            m = 50 + 50 * n * count // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
                for t in set(brute_terms(text))
                if t in counts
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        found += [(item_id, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(found, key=str)


def sample_rows(seed=2, docs=400):
    rng = random.Random(seed)
    topics = [[f"{t}{i}" for i in range(60)] for t in ("red", "blue", "grün", "noir")]
    rows = []
    for i in range(docs):
        words = rng.choices(topics[i % 4], k=rng.choice([3, 20, 150])) + rng.choices(["the", "of"], k=5)
        rows.append((i, rng.choice([" ", ", ", "-\n"]).join(words), "en", "s", 1))
    return rows + [(5000 + i, "The red1 red2 copy of blue7", "en", "s", 1) for i in range(90)] + rows[:3] + ROWS


def sample_items(rows, seed=3):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.sample(brute_terms(rng.choice(rows[:400])[1]), 3))) for i in range(12)]
    return items + [(1, "RED1 red2 unheard"), (None, "lorem blue7"), (90, None), (91, ""), (92, "unheard of"), (93, "?!"), (1, "RED1 red2 unheard")]


@pytest.mark.parametrize("options", [{}, {"block_terms": 9, "sample": 30}, {"top": 3}])
def test_search_equals_brute_force(spark, options, monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET_ENTRIES", 2000)
    rows = sample_rows()
    items = sample_items(rows)
    benchmark = spark.createDataFrame(items, ITEMS).withColumn("doc_id", lexical.F.lit(7))
    found = lexical.ranked_search(frame(spark, rows), benchmark, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows, items, options.get("top", 50))


def test_empty_tables(spark):
    benchmark = spark.createDataFrame(sample_items(sample_rows()), ITEMS)
    assert lexical.ranked_search(empty(spark), benchmark).collect() == []
    assert lexical.ranked_search(frame(spark), benchmark.where("false")).collect() == []
    assert lexical.ranked_search(frame(spark), benchmark.where("item_id = 93")).collect() == []


def random_tree(rng, docs=2000, width=400):
    """Documents of one of eight groups of terms, and items of three terms of a group."""
    terms = [np.sort(rng.choice(50, rng.integers(1, 20), replace=False)) + 50 * (i % 8) for i in range(docs)]
    x = lexical._rows(terms, [rng.integers(1, 10**9, len(t)) for t in terms])
    asked = [np.sort(rng.choice(50, 3, replace=False)) + 50 * (i % 8) for i in range(16)]
    return x, lexical._rows(asked, asked), np.arange(width) // 50


def test_no_score_exceeds_its_bound_and_subtrees_are_pruned():
    x, items, group = random_tree(np.random.default_rng(4))
    tree = lexical.BallTree(x, items, group, leaf=16)
    below = {}

    def rows_of(node):
        if node not in below:
            below[node] = tree.leaf_rows[node] if node in tree.leaf_rows else np.concatenate([rows_of(c) for c in tree.children[node]])
        return below[node]

    assert sorted(rows_of(0)) == list(range(len(x)))
    for item in range(len(items)):
        wanted = np.zeros(len(group), np.int64)
        terms = items.term[items.start[item] : items.start[item + 1]]
        wanted[terms] = 1
        scores = x.sums(wanted[x.term] * x.value)
        for node in range(len(tree.bounds)):
            assert scores[rows_of(node)].max() <= tree.bounds[node, item]
        rows, found = tree.best(item, terms, 1, 10)
        assert sorted(found)[-10:] == sorted(scores)[-10:]
    # Leaves of other groups are left out as a whole.
    assert tree.leaves_scored < 0.5 * len(tree.leaf_rows) * len(items)


def test_copies_are_one_leaf_and_all_are_found():
    x = lexical._rows([np.array([1, 3])] * 500, [np.array([5, 7])] * 500)
    items = lexical._rows([np.array([3])], [np.array([3])])
    tree = lexical.BallTree(x, items, np.zeros(4, np.int64))
    assert len(tree.leaf_rows) == 1
    rows, scores = tree.best(0, np.array([3]), 1, 50)
    assert len(rows) == 500 and set(scores) == {7}

"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from daybook.llm import spelling
from daybook.llm.queries import QUERIES
from tests.llm.test_documents import ROWS, frame, rows_of, empty


def brute_words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def are_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_by_deletion(words):
    """Pairs that share a word with one letter taken out; fast enough for a test table."""
    keys = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            keys.setdefault(key, []).append(w)
    found = {w: set() for w in words}
    for some in keys.values():
        for a in some:
            found[a].update(b for b in some if b != a and are_near(a, b))
    return found


def expected(rows):
    words = brute_words(rows)
    near, form = near_by_deletion(words), {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def variants(rng, word):
    i, letter = rng.randrange(len(word)), rng.choice("abcdeéèÿ÷")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]])


def sample_rows(seed=5, docs=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randrange(6, 12))) for _ in range(60)]
    words += [variants(rng, rng.choice(words)) for _ in range(300)]
    words += ["a" * 3000, "a" * 2999 + "b", "a" * 3001, "ABCDEF", "fedcba", "defabc"]
    rows = []
    for i in range(docs):
        text = " ".join(w if rng.random() < 0.9 else w.upper() for w in rng.choices(words, k=300))
        rows.append((i if i % 9 else None, text + rng.choice([" ", "日本", "_", "×"]), "en", "s", 1))
    return rows + [(1000, " ".join(f"chained{'x' * k} " * 6 ** (k + 1) for k in range(5)), "en", "s", 1)] + rows[:2] + ROWS


def test_variants_equal_brute_force(spark):
    rows = sample_rows()
    found = spelling.spelling_variants(frame(spark, rows)).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(tuple(r) for r in found.collect()) == expected(rows)
    chain = {r[0]: r[2] for r in expected(rows) if r[0].startswith("chained")}
    assert {len(w) for w in chain} >= {7, 8, 9, 10, 11} and chain["chained"] == "chainedxxxx"


def test_small_cells_find_the_same(spark):
    words = brute_words(sample_rows(6))
    df = spelling.stored(spark.createDataFrame(list(words.items()), "word string, n long"))
    found = {r.word: r.n_near for r in spelling.near_words(df, sample=50, cell=8).collect()}
    assert found == {w: len(x) for w, x in near_by_deletion(words).items() if x}
    assert sum(found.values()) > 500


def test_search_prunes_boxes_and_misses_nothing():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 3, (600, spelling.DIMENSIONS)).astype(np.int32) * (np.arange(spelling.DIMENSIONS) < 7)
    for reach in (0, 1, 2):
        found = {(a, b) for x, y in spelling.search(points, points[:100], reach) for a, b in zip(x.tolist(), y.tolist())}
        distance = np.abs(points[:100, None] - points[None]).sum(2)
        assert found == set(zip(*(x.tolist() for x in np.nonzero(distance <= reach))))
    alike = np.ones((200, spelling.DIMENSIONS), np.int32)
    assert sum(len(x) for x, _ in spelling.search(alike, alike[:3], 2)) == 600


@pytest.mark.parametrize("a, b", [("abcdef", "abcdeg"), ("abcdef", "bacdef"), ("abcdef", "abcdef"), ("abcdef", "abcxdef"), ("aaaaaa", "aaaaaaa"), ("abcdef", "bcdefga"), ("abcdef", "zabcdef"), ("abcdef", "abcdefz")])
def test_letter_order(a, b):
    x, y = spelling.encoded([a]), spelling.encoded([b])
    assert (spelling.replaced(x, y) if len(a) == len(b) else spelling.inserted(x, y)).tolist() == [are_near(a, b)]


def test_query_equals_brute_force_on_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op12_spelling"](spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(tuple(r) for r in found.collect()) == expected(rows)


def test_no_words(spark):
    assert rows_of(spelling.spelling_variants(empty(spark))) == []
    assert rows_of(spelling.spelling_variants(frame(spark, [(1, None, None, None, None), (2, "short", "en", "s", 5)]))) == []

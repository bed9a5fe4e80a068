"""Operators on documents, against brute force on awkward rows."""

import collections
import hashlib
import random
import re
import struct
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from daybook.llm import bpe, components, decontamination, exact_dedup, pii, quality, sharding, simhash
from daybook.llm.queries import QUERIES, VOCABULARY, token_digests

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, or that differ from theirs in case only.
CLASHING = [
    "id", "digest", "salt", "row", "place", "others", "key", "word", "words", "term", "content",
    "position", "ids", "spans", "fingerprint", "component_id", "a", "b", "size", "piece", "shard",
    "slot", "kept", "keep_id", "dropped", "doc", "quality_scores", "label", "c0", "we.ird `name",
]

LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, "One two three four five.", "en", "s", 24),
    (2, "One two three four five.", "en", "s", 24),
    (2, "One two three four five.", "en", "s", 24),
    (3, None, None, None, None),
    (4, "", "en", "s", 0),
    (5, "   \n", "en", None, 4),
    (6, LONG, "en", "s", len(LONG)),
    (7, LONG + "end", None, "s", 3),
    (None, "no id here", "en", "s", 10),
    (None, "One two three four five.", "en", "s", 24),
    (8, "ÄÖÜ straße <|endoftext|> it's 12 👍🏽 日本 mail a.b@c.example.org or 10.20.30.40!", "de", "t", 7),
    (9, "x", "en", "t", 1),
]


def frame(spark, rows=ROWS, clashing=True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in CLASHING if clashing else []:
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Exact deduplication


def exact_expected(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    expected = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        expected.append((doc_id, keep, len(ids), doc_id == keep, sha(text or "")))
    return ordered(expected)


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_groups(spark, clashing):
    assert rows_of(exact_dedup.exact_groups(frame(spark, clashing=clashing))) == exact_expected(ROWS)


def test_texts_that_share_a_digest_are_told_apart(spark):
    """With the length as digest nearly every digest is ambiguous."""
    by_length = lambda text: F.length(text).cast("string").cast("binary")
    found = exact_dedup.exact_groups(frame(spark), salts=2, digest=by_length)
    assert rows_of(found) == exact_expected(ROWS)


def test_one_row_of_each_text_stays_as_it_was(spark):
    df = frame(spark)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    rows = kept.select("doc_id", "text", "lang", "id", "`we.ird ``name`").collect()
    best = {}
    for doc_id, text, lang, *_ in ROWS:
        if text not in best or (doc_id or -1) >= best[text or ""][0]:
            best[text or ""] = (doc_id or -1, doc_id, text, lang)
    assert ordered(tuple(r)[:3] for r in rows) == ordered(b[1:] for b in best.values())
    assert {r.id for r in rows} == {"own id"}


# SimHash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(count, near):
    parent = list(range(count))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(count):
        for j in range(i):
            if near(i, j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(x) for x in range(count)]


def simhash_expected(rows):
    prints = [brute_fingerprint(text or "") for _, text, *_ in rows]
    roots = components_of(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    expected = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [r[0] for r, root in zip(rows, roots) if root == roots[i] and r[0] is not None]
        expected.append((doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    return ordered(expected)


def test_simhash_components(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    rows = list(ROWS)
    for group in range(6):
        base = [rng.choice(words) for _ in range(120)]
        for copy in range(8):
            changed = list(base)
            changed[rng.randrange(120)] = "changed"
            rows.append((100 + 10 * group + copy, " ".join(changed), "en", "s", 1))
    found = simhash.near_duplicates(frame(spark, rows))
    expected = simhash_expected(rows)
    assert rows_of(found) == expected
    assert len({row[2] for row in expected}) < len(rows) - 20


@pytest.mark.parametrize("part_size", [7, 4096])
def test_near_links_connect_what_brute_force_connects(spark, part_size):
    """Chains of close fingerprints; small parts force the search of pairs of parts."""
    rng = np.random.default_rng(3)
    values = []
    for start in rng.integers(0, 2**63, 8, dtype=np.uint64):
        value = start
        for _ in range(60):
            near = value
            for bit in rng.integers(0, 64, rng.integers(1, 6)):
                near ^= np.uint64(1) << np.uint64(bit)
            values.append(near)
            value = near if rng.random() < 0.3 else value
    values = np.unique(np.array(values, dtype=np.uint64))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    pairs = simhash.near_links(df, part_size).toPandas().to_numpy().astype(np.int64).view(np.uint64)
    assert (np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= 4).all()
    linked = {frozenset(p) for p in pairs.tolist()}
    listed = values.tolist()
    exact = components_of(len(listed), lambda i, j: (listed[i] ^ listed[j]).bit_count() <= 4)
    assert components_of(len(listed), lambda i, j: frozenset((listed[i], listed[j])) in linked) == exact


def test_components_of_a_chain_a_star_and_a_circle(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = components.connected(spark.createDataFrame(links, "a long, b long"))
    expected = [(i, 0) for i in range(1, 41)] + [(i, 100) for i in range(101, 140)]
    assert sorted(tuple(r) for r in found.collect()) == expected + [(201, 200), (202, 200)]


def test_gray_rank_orders_the_reflected_sequence():
    sequence = np.array([i ^ (i >> 1) for i in range(64)], dtype=np.uint64)
    assert simhash.gray_rank(sequence).tolist() == list(range(64))


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 300, 5000])
def test_gray_index_finds_all_near_and_prunes_groups(size):
    rng = np.random.default_rng(size)
    values = rng.integers(0, 2**63, size, dtype=np.uint64)
    values = np.unique(np.concatenate([values, values ^ (np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64))]))
    index = simhash.GrayIndex(values)
    assert sorted(index.values.tolist()) == sorted(values.tolist())
    for value in values[:: max(1, size // 50)]:
        found = set(index.values[index.near(value)].tolist())
        assert found == set(values[np.bitwise_count(values ^ value) <= 4].tolist())
    for (_, upper), (_, lower) in zip(index.levels, index.levels[1:]):
        assert (upper[np.arange(len(lower)) // 16] & ~lower == 0).all()


def test_one_document_of_each_component_stays(spark):
    df = frame(spark, [r for r in ROWS if r[0] not in (None, 2)])
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
    expected = {row[2] for row in simhash_expected([r for r in ROWS if r[0] not in (None, 2)])}
    assert ids == sorted(expected)


# Tokens


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def test_bpe_equals_the_library(spark, library):
    found = bpe.encode_and_decode(frame(spark), public_tokenizers.path(VOCABULARY))
    actual = rows_of(found.select("doc_id", *token_digests()))
    expected = []
    for doc_id, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = sha(library.decode(ids, skip_special_tokens=False))
        expected.append((doc_id, len(ids), packed, decoded))
    assert actual == ordered(expected)


def test_automaton_equals_merging_on_random_words(library):
    codec = bpe.WordCodec(open(public_tokenizers.path(VOCABULARY)).read())
    rng = random.Random(1)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "aab", "thein", "éèàΣσςİßǅﬁ́", "日本한글👍🏽‍", "'stdlve", "!?$&"]
    for _ in range(4000):
        text = "".join(rng.choice(rng.choice(alphabets) + " ") for _ in range(rng.randrange(40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert codec.encode("a" * 3000).tolist() == library.encode("a" * 3000).ids


def test_improper_merges_are_refused():
    vocab = {"a": 0, "b": 1, "ab": 2, "abab": 3}
    with pytest.raises(ValueError, match="merges"):
        bpe.MergeAutomaton(vocab, [("ab", "ab"), ("a", "b")], "</w>")


# Personal data


def brute_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for kind, pattern in patterns.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            if kind == "ip" and any(int(part) > 255 for part in match.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.passes_luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *match.span()))
    return found


def test_plain_identifiers_equal_brute_force():
    rng = random.Random(2)
    pieces = ["4537960215852590", "+1 (476) 555-5473", "1.2.3.4", "999.1.1.1", "a@b.c", " ", "-", "1", "@", ".", "é", "x"]
    for _ in range(5000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert [s[:3] for s in pii.find_spans(text) if s[3]] == brute_spans(text), text


@pytest.mark.parametrize(
    ("text", "kind", "source", "value"),
    [
        ("to john.smith (at) example (dot) com ok", "email", "john.smith (at) example (dot) com", "john.smith@example.com"),
        ("ask john at example dot com", "email", "john at example dot com", "john@example.com"),
        ("jоhn@example.com", "email", "jоhn@example.com", "john@example.com"),
        ("４５３７９６０２１５８５２５９０", "card", "４５３７９６０２１５８５２５９０", "4537960215852590"),
        ("é plus one five five five 123 4567", "phone", "plus one five five five 123 4567", "+1555 123 4567"),
        ("at one nine two dot one six eight dot one dot one.", "ip", "one nine two dot one six eight dot one dot one", "192.168.1.1"),
        ("a@b​.com", "email", "a@b​.com", "a@b.com"),
        ("so john.doe at example.com wrote", "email", "john.doe at example.com", "john.doe@example.com"),
        ("agent7 at mail.example.org", "email", "agent7 at mail.example.org", "agent7@mail.example.org"),
        ("please contact mary at example.com", "email", "mary at example.com", "mary@example.com"),
    ],
)
def test_disguised_identifiers_map_back_to_their_source(text, kind, source, value):
    hidden = [s for s in pii.find_spans(text) if not s[3]]
    assert [(s[0], text[s[1] : s[2]], s[4]) for s in hidden] == [(kind, source, value)]


@pytest.mark.parametrize("text", ["meet at example.com", "we met at example.com. Contact us", "version 2.0 is at home", "the dot com boom", "one two", "plus one", "ﬁne²"])
def test_ordinary_writing_is_left_alone(text):
    assert pii.find_spans(text) == []


def test_long_runs_of_digits_and_many_addresses():
    assert pii.find_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006, True, "0" * 5000 + ".1.1.1")]
    assert pii.find_spans("1" * 5000 + ".1.1.1 " + "1." * 5000 + "1") == [
        ("ip", 5007 + 8 * i, 5014 + 8 * i, True, "1.1.1.1") for i in range(1250)
    ]
    text = "see x.y at b.com, a\u200b@b.com, c@d.org; " * 100_000
    begin = time.perf_counter()
    spans = pii.find_spans(text)
    assert time.perf_counter() - begin < 20
    assert len(spans) == 300_000
    assert {text[a:b] for _, a, b, *_ in spans} == {"x.y at b.com", "a\u200b@b.com", "c@d.org"}


def test_spans_of_random_disguises_map_back(spark):
    """Each disguise stands for a known character, so the value can be read off the source."""
    rng = random.Random(9)
    at, dot = ["@", " (at) ", " [AT] ", "{@}"], [".", " (dot) ", " [dot] ", "\u200b."]
    for _ in range(500):
        parts, expected, text = [], [], ""
        for _ in range(rng.randrange(1, 6)):
            name = "".join(rng.choice("abcxyz") for _ in range(rng.randrange(3, 9)))
            hidden = "".join({"a": "а", "c": "с", "x": "х"}.get(c, c) if rng.random() < 0.3 else c for c in name)
            source = hidden + rng.choice(at) + "host" + rng.choice(dot) + "com"
            text += rng.choice(["; ", "\n", " | "])
            expected.append((len(text), len(text) + len(source), f"{name}@host.com"))
            text += source
        found = [(a, b, value) for kind, a, b, _, value in pii.find_spans(text) if kind == "email"]
        assert set(expected) <= set(found), text


def test_pii_query_columns(spark):
    found = pii.find_pii(frame(spark)).select("doc_id", pii.listed(F.col("spans")).alias("s"))
    expected = ordered(
        (r[0], ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(r[1] or ""))) for r in ROWS
    )
    assert rows_of(found) == expected
    assert any("ip:" in row[1] for row in expected)


# Decontamination


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contamination_expected(rows, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add("" if item is None else str(item))
    counts = collections.Counter(word for row in rows for word in words_of(row[1]))
    expected = []
    for doc_id, text, *_ in rows:
        words, hit, found = words_of(text), set(), set()
        near = set()
        for window, names in windows.items():
            rarest = min(window, key=lambda word: (counts[word], window.index(word)))
            for place, word in enumerate(words):
                if word == rarest and set(window) <= set(words[max(0, place - 12) : place + 13]):
                    near |= names
        for window, names in windows.items():
            for start in range(len(words) - len(window) + 1):
                if tuple(words[start : start + len(window)]) == window:
                    hit.update(range(start, start + len(window)))
                    found |= names
        listed = sha(",".join(sorted(found)))
        nearby = sha(",".join(sorted(near)))
        expected.append((doc_id, len(words), len(hit), len(found), listed, bool(hit), len(near), nearby))
    return ordered(expected)


PASSAGE = "The quick brown fox jumps over the lazy dog and the quick cat sleeps in Öl"
ITEMS = [
    (1, PASSAGE), (20, "short item"), (3, None), (4, ""), (5, "?!"), (None, "single"),
    (20, "short item"), (7, "the the the the the the the the the the the"),
]
SUSPECTS = [
    (50, f"Before. {PASSAGE.upper().replace('Ö', 'Ö')} after", "en", "s", 1),
    (51, PASSAGE.replace("lazy", "idle"), "en", "s", 1),
    (52, " ".join(PASSAGE.split()[1:12]), "en", "s", 1),
    (53, "a SHORT-item, single " + "the " * 13, "en", "s", 1),
    (53, "another text of the same doc: short item", "en", "s", 1),
    (54, PASSAGE.replace("Ö", "ö") + " " + PASSAGE + " " + PASSAGE, "en", "s", 1),
    (55, PASSAGE.replace("jumps over", "jumps INSERTED over").replace("cat", "cat ADDED"), "en", "s", 1),
    (56, "item, not so short " + "filler " * 30 + " ".join(PASSAGE.split()[9::-1]), "en", "s", 1),
    (57, "?short " + "x " * 30 + "item!", "en", "s", 1),
]


def found_contamination(df, benchmark):
    found = decontamination.find_contamination(df, benchmark)
    return rows_of(found.drop("content"))


def test_contamination_equals_brute_force(spark):
    rows = ROWS + SUSPECTS + SUSPECTS[:1]
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("words", F.lit(1))
    expected = contamination_expected(rows, ITEMS)
    assert found_contamination(frame(spark, rows), benchmark) == expected
    assert sum(row[5] for row in expected) == 6
    # Inserted words, or another order: near, but not exact.
    assert {row[0] for row in expected if row[6] and not row[5]} >= {55, 56}
    kept = decontamination.drop_contaminated(frame(spark, rows), benchmark)
    assert ordered(tuple(r) for r in kept.select("doc_id", "text").collect()) == ordered(
        (r[0], r[1]) for r, e in zip(rows, [contamination_expected([r], ITEMS)[0] for r in rows]) if not e[5]
    )


def test_words_that_lie_near_each_other_are_found_in_any_order(spark):
    index = decontamination.PositionalIndex(
        frame(spark, [(1, "zeta filler alpha beta", "en", "s", 1), (2, "alpha " + "x " * 30 + "beta zeta", "en", "s", 1)]),
        spark.createDataFrame([(1, "alpha beta zeta")], "item_id long, text string"),
        "doc_id", "text", "item_id", "text", 10,
    )
    assert [r.doc for r in decontamination.find_near(index, 4).collect()] == [1]
    assert decontamination.find_phrases(index).count() == 0


# Shards


def test_shards_are_contiguous_balanced_and_gapless(spark):
    rows = ROWS + [(1000 + i, f"text {i % 40} " * (i % 17), "en", "s", 1) for i in range(600)]
    found = sharding.byte_shards(frame(spark, rows), shards=5).toPandas()
    assert sorted(found["size"]) == sorted(len((r[1] or "").encode()) + 8 for r in rows)
    by_id = {r[0]: r[1] or "" for r in rows if r[0] and r[0] >= 1000}
    for row in found[found.doc_id >= 1000].itertuples():
        assert row.text_crc32 == zlib.crc32(by_id[row.doc_id].encode())
    for _, part in found.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert set(found["law"]) == {"bytes"} and found["grown_shard"].isna().all()
    small = sharding.byte_shards(frame(spark, rows[len(ROWS) :]), shards=5).toPandas()
    sizes = small.groupby("shard")["size"].sum()
    assert len(sizes) == 5 and abs(sizes - sizes.mean()).max() < small["size"].max()


# Quality


def quality_tables(spark, count=240):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(count):
        good = i % 3 > 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
        text = " ".join(words) if good else " ".join(w.upper() + "%%%" for w in words)
        rows.append((1000 + i, text, "en", f"s{i % 4}", len(text)))
        if i % 2:
            labels.append((1000 + i, int(good), 0))
    labels += [(1001, None, 0), (None, 1, 0), (5, 1, 0), (1003, 1, 1)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_documents_it_has_not_seen(spark):
    rows, labels = quality_tables(spark)
    found = quality.classify(frame(spark, rows), labels).toPandas()
    assert len(found) == len(rows)
    for row in found.itertuples():
        if row.doc_id % 2 == 0:
            assert row.keep == ((row.doc_id - 1000) % 3 > 0)


def test_quality_scores_awkward_rows_and_keeps_columns(spark):
    rows, labels = quality_tables(spark)
    df = frame(spark, ROWS + rows)
    found = quality.classify(df, labels).toPandas()
    assert len(found) == len(ROWS) + len(rows) and found.score.between(0, 1).all()
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert kept.count() == found.keep.sum()


def test_quality_without_labels_keeps_everything(spark):
    _, labels = quality_tables(spark)
    found = quality.classify(frame(spark), labels.where("false")).toPandas()
    assert found.keep.all() and len(found) == len(ROWS)
    named = frame(spark, clashing=False).select("doc_id", "text")
    assert quality.keep_good(named, labels.where("false")).columns == ["doc_id", "text"]


def test_held_out_accuracy_on_the_test_tables(spark):
    """Labels that the fit has not seen: only 150 are given to it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.orderBy(F.xxhash64("doc_id", F.lit("split"))).limit(250)
    held = labels.join(seen, "doc_id", "left_anti")
    found = quality.classify(docs, seen).join(held, "doc_id")
    right = found.where(F.col("keep") == (F.col("quality") == 1)).count()
    assert right / found.count() > 0.97


def _passes(rows, labels):
    """The sums of a function's arrays over all rows, in this process."""
    views = quality._views(quality.pd.DataFrame(rows, columns=["id", "text", "lang", "source", "n_chars"]))
    held = np.array([row[0] in labels[1] for row in rows])
    known = np.array([labels[0].get(row[0], -1) for row in rows])
    batch = quality.Batch({name: x.astype(float) for name, x in views.items()}, known, held)
    return (lambda function: {n: np.rint(v * 2.0**20) / 2.0**20 for n, v in function(batch)}), batch


def test_quality_fit_equals_one_in_a_single_process(spark):
    rows, labels = quality_tables(spark, 400)
    docs = frame(spark, rows)
    features = quality.featured(docs, labels, "doc_id", "quality").toPandas()
    known = {r.doc_id: r.label for r in features.itertuples() if r.label >= 0}
    held = {r.doc_id for r in features.itertuples() if r.held}
    assert 20 < len(held) < 120 and held <= known.keys()
    summed, batch = _passes(rows, (known, held))
    expected, found = quality.co_train(summed), quality.fit_quality(docs, labels)
    for part in ("text", "page", "text_calibration", "page_calibration", "combined"):
        for name in ("mean", "scale", "weights", "bias"):
            np.testing.assert_allclose(
                getattr(getattr(found, part), name), getattr(getattr(expected, part), name), rtol=2e-3, atol=2e-3
            )


def test_each_source_gets_labels_from_the_other_view(spark):
    """The text labels documents of a source that no label covers, and the page view learns from them."""
    rows, labels = quality_tables(spark, 600)
    rows = [(*row[:3], "unseen" if row[0] % 10 == 2 else row[3], row[4]) for row in rows]
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and r.doc_id}
    summed, batch = _passes(rows, (known, {i for i in known if zlib.crc32(b"%d" % i) % 3 == 0}))
    history = []

    def watching(function):
        cells = dict(zip(function.__code__.co_freevars, function.__closure__ or ()))
        if "history" in cells:
            history[:] = cells["history"].cell_contents
        return summed(function)

    quality.co_train(watching)
    assert len(history) == quality.ROUNDS
    given = quality.given_labels(batch, history, "page")
    unseen = np.array([row[3] == "unseen" for row in rows])
    assert (given[unseen] >= 0).any() and (given[batch.label >= 0] == -1).all()
    good = np.array([(row[0] - 1000) % 3 > 0 for row in rows])
    assert (given[given >= 0] == good[given >= 0]).all()


# All of them


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables_give_empty_results(spark):
    none = empty(spark)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vocabulary = public_tokenizers.path(VOCABULARY)
    for found in (
        exact_dedup.exact_groups(none),
        exact_dedup.drop_exact_copies(none),
        simhash.near_duplicates(none),
        simhash.drop_near_duplicates(none),
        bpe.encode_and_decode(none, vocabulary),
        pii.find_pii(none),
        decontamination.find_contamination(none, benchmark),
        decontamination.drop_contaminated(none, benchmark),
        sharding.byte_shards(none),
        quality.classify(none, labels),
        quality.keep_good(none, labels),
    ):
        assert found.collect() == []
    assert found_contamination(frame(spark), benchmark.where("false")) == contamination_expected(ROWS, [])


def test_pipeline_equals_its_stages_in_python(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    scored = QUERIES["op4_quality"](spark, SF_DIR).collect()
    rows = [tuple(docs[r.doc_id]) for r in scored if r.keep]
    last = {r[1]: r for r in sorted(rows)}
    rows = sorted(last.values())
    rows = [r for r, e in zip(rows, sorted(simhash_expected(rows))) if r[0] in {x[2] for x in simhash_expected(rows)}]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {e[0] for e in contamination_expected(rows, items) if not e[5]}
    result = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert sorted(result.doc_id) == sorted(r[0] for r in rows if r[0] in clean)
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    for row in result.itertuples():
        expected = library.encode(docs[row.doc_id].text, add_special_tokens=False).ids
        assert list(row.ids) == expected and row.n_tokens == len(expected)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns

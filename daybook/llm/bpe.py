"""BPE encoding by a deterministic tokenization automaton, and decoding.

The automaton reads tokens. Its paths are exactly the token sequences that merging
produces, so each word labels one path. It starts as one state with a loop for every
base symbol, and each merge (u, v) adds a gadget: arcs labelled u get a state of
their own, a copy of the one they led to but without its arc v, and every state with
an arc u also gets an arc uv to where u, v used to lead. All arcs of one label lead
to one state, so a state is known by the label that leads to it.

A copied state is not written out. The compiled table holds what each gadget changed: the arc
taken from its state, the state it was copied from (a failure arc on the left) and the arc
that its label's arcs were made beside (one on the right), each with the merge's rank.
A transition follows failure arcs until a changed one decides.

Any beginning of a word has one path as well. So a word is encoded from left to right:
each position gets the one label whose arc leads there from a position before, and nothing
is ever taken back. Decoding emits the labels of the arcs. The library is used to be
compared with, not to encode.
"""

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daybook.llm.common import column, ship_library

# Words in either of the two generations of a worker's cache.
MAX_CACHED_WORDS = 80_000
MAX_CACHED_ARCS = 100_000
# Texts whose ids are held at a time.
_ROWS = 250
# No word longer than this is cached.
MAX_CACHED_LENGTH = 100


class MergeAutomaton:
    """Transitions between vocabulary entries, compiled from the merges."""

    def __init__(self, vocab: Mapping[str, int], merges: Sequence[Sequence[str]], suffix: str):
        size = max(vocab.values()) + 1
        # By label: the rank of its merge, and the labels merged.
        self.rank = [-1] * size
        self.first, self.last = [0] * size, [0] * size
        # By state and label, as state * size + label: the rank of the gadget that took the arc.
        self.size = size
        self.taken: dict[int, int] = {}
        self.ends = [False] * size
        self.made = [True] * size
        used: set[int] = set()
        for label, token in vocab.items():
            self.ends[token] = label.endswith(suffix)
        for rank, (left, right) in enumerate(merges):
            used.update((vocab[left], vocab[right]))
            if vocab[left + right] in used:
                raise ValueError("merges must build a token before they use it")
            self._add_gadget(vocab[left], vocab[right], vocab[left + right], rank)
        self.ranks = len(merges)

    def _add_gadget(self, u: int, v: int, uv: int, rank: int) -> None:
        if self.rank[uv] >= 0:
            raise ValueError("merges must build each token once")
        self.rank[uv], self.first[uv], self.last[uv] = rank, u, v
        # Where v never follows u, merging is of no use.
        self.made[uv] = self.made[u] and self.made[v] and self.has_arc(u, v, rank)
        self.taken[u * self.size + v] = rank

    def has_arc(self, state: int, label: int, before: int) -> bool:
        """Whether the state of this label had the arc before the gadget of a rank."""
        taken, rank, first, last, size = self.taken, self.rank, self.first, self.last, self.size
        if self.ends[state]:
            return False
        while taken.get(state * size + label, before) >= before:
            made, came = rank[label], rank[state]
            if made > came:
                # In a run of u, the pair is taken from the left: u, uu never follow.
                if first[label] == state and last[label] == state:
                    return False
                label, before = first[label], made
            elif came < 0:
                return True
            elif state == label:
                state, label, before = last[state], first[label], made
            else:
                state, before = last[state], came
        return False


class _Arcs(dict):
    """Arcs that words have met, by state * size + label; starts anew when full."""

    def __init__(self, automaton: MergeAutomaton):
        self.automaton = automaton

    def __missing__(self, arc: int) -> bool:
        if len(self) >= MAX_CACHED_ARCS:
            self.clear()
        state, label = divmod(arc, self.automaton.size)
        found = self[arc] = self.automaton.has_arc(state, label, self.automaton.ranks)
        return found


def _byte_symbols() -> dict[int, str]:
    """Printable stand-ins for bytes: themselves, or those from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(spare)) for b in range(256)}


class WordCodec:
    """Encodes texts to ids and ids to texts, for a vocabulary with word ends."""

    # Fixed by the vocabulary: how a text is split into words.
    WORDS = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
    )

    # The same for texts within Latin-1, where it can be said in plain classes, which is faster.
    _LETTERS, _NUMBERS, _WHITE = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
    LATIN_WORDS = re.compile(
        f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^{_WHITE}{_LETTERS}{_NUMBERS}]+"
    )

    def __init__(self, model: str):
        spec = json.loads(model)
        bpe = spec["model"]
        vocab: dict[str, int] = bpe["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in bpe["merges"]]
        self.suffix: str = bpe["end_of_word_suffix"]
        self.automaton = MergeAutomaton(vocab, merges, self.suffix)
        self.labels = [""] * (max(vocab.values()) + 1)
        for label, token in vocab.items():
            self.labels[token] = label
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for label, token in self.special.items():
            if token >= len(self.labels):
                self.labels += [""] * (token + 1 - len(self.labels))
            self.labels[token] = label
        made = self.automaton.made
        in_words = {k: v for k, v in vocab.items() if k not in self.special and made[v]}
        inner = {k: v for k, v in in_words.items() if not k.endswith(self.suffix)}
        self.final = {k[: -len(self.suffix)]: v for k, v in in_words.items() if k.endswith(self.suffix)}
        self.longest = max(map(len, chain(inner, self.final)))
        self.inner, self.arcs = inner, _Arcs(self.automaton)
        self.symbols = str.maketrans(_byte_symbols())
        marks = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.known = _Words(self)

    def encode_word(self, word: str) -> tuple[int, ...]:
        """The one path through the automaton that this word labels."""
        symbols = word.encode().decode("latin-1").translate(self.symbols)
        size = len(symbols)
        longest, inner, arcs, width = self.longest, self.inner, self.arcs, self.automaton.size
        # The label that leads to each position, and the position it comes from.
        label_to, come_from = [0] * (size + 1), [0] * (size + 1)
        for end in range(1, size):
            label = inner.get(symbols[:end]) if end <= longest else None
            if label is not None:
                label_to[end] = label
                continue
            for start in range(max(1, end - longest), end):
                label = inner.get(symbols[start:end])
                if label is not None and arcs[label_to[start] * width + label]:
                    label_to[end], come_from[end] = label, start
                    break
            else:
                raise ValueError(f"no path for {word[:100]!r}: a symbol is not in the vocabulary")
        for start in range(max(0, size - longest), size):
            label = self.final.get(symbols[start:])
            if label is not None and (not start or arcs[label_to[start] * width + label]):
                label_to[size], come_from[size] = label, start
                break
        else:
            raise ValueError(f"no path for {word[:100]!r}: a symbol is not in the vocabulary")
        path = []
        while size:
            path.append(label_to[size])
            size = come_from[size]
        path.reverse()
        return tuple(path)

    def words(self, text: str) -> list[str]:
        """Normalised words: composed, in lower case character by character."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.WORDS.findall(text)
        return self.LATIN_WORDS.findall(text)

    def encode(self, text: str) -> np.ndarray:
        known = self.known.__getitem__
        ids: Iterable[int] = ()
        parts = self.marks.split(text) if self.marks else [text]
        for part in parts:
            if part in self.special:
                ids = chain(ids, (self.special[part],))
            else:
                ids = chain(ids, chain.from_iterable(map(known, self.words(part))))
        return np.fromiter(ids, np.int32)

    def forget(self) -> None:
        """Drop what was remembered of words and arcs."""
        self.known.clear()
        self.known.older = {}
        self.arcs.clear()

    def decode(self, ids: Iterable[int]) -> str:
        """The labels, word ends included, joined by spaces."""
        return " ".join(map(self.labels.__getitem__, ids))


class _Words(dict):
    """Paths of words. When full it starts anew, but words still in use come along."""

    def __init__(self, codec: WordCodec):
        self.codec = codec
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        path = self.older.get(word)
        if path is None:
            path = self.codec.encode_word(word)
        if len(word) <= MAX_CACHED_LENGTH:
            if len(self) >= MAX_CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = path
        return path


@lru_cache(maxsize=2)
def _codec(model: str) -> WordCodec:
    return WordCodec(model)


class BpeCodec:
    """The codec as column functions. The vocabulary is read here and broadcast.

    The file's size is fixed by the vocabulary, about 2 MB for 49,000 entries.
    """

    def __init__(self, spark: SparkSession, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            model = self.model = spark.sparkContext.broadcast(file.read())
        ship_library(spark)

        @F.pandas_udf("array<int>")
        def encode(texts: pd.Series) -> pd.Series:
            codec = _codec(model.value)
            return pd.Series([codec.encode(text or "") for text in texts], dtype=object)

        @F.pandas_udf("string")
        def decode(lists: pd.Series) -> pd.Series:
            codec = _codec(model.value)
            return pd.Series([codec.decode([] if ids is None else ids.tolist()) for ids in lists])

        self._encode, self._decode = encode, decode

    def encode(self, text: Column) -> Column:
        """Token ids of a text; none for a null or empty one."""
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        """The text that ids stand for; empty for null or no ids."""
        return self._decode(ids)


def encode_and_decode(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, ids, ids_bytes (the same as little-endian 32-bit integers), decoded.

    Whole texts are encoded; null counts as empty. Repeated rows are encoded each.
    Other columns are ignored; an empty table gives an empty result. Both directions run in
    one pass: as functions of columns, ids that are used twice would be made twice.
    """
    model = BpeCodec(docs.sparkSession, vocabulary).model
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("ids_bytes", T.BinaryType()),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                ids = [codec.encode(value or "") for value in part["text"].to_pylist()]
                texts = [codec.decode(some.tolist()) for some in ids]
                packed = [some.astype("<u4").tobytes() for some in ids]
                columns = [
                    part["doc_id"],
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(packed, pa.binary()),
                    pa.array(texts, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
        # Workers stay for later stages, which need their memory.
        codec.forget()

    return rows.mapInArrow(encoded, schema)

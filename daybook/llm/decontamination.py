"""Benchmark decontamination by a distributed positional inverted index.

The index holds a posting (term, document, position) for every occurrence of a
benchmark term in a training document; occurrences of other terms can't be part of
a benchmark phrase, but keep their positions. A phrase is looked up by its terms
in order of rarity: the postings of its rarest term, shifted by the term's offset,
are the possible places of the phrase, and are intersected with the shifted postings
of each further term. Proximity matches start from the same rarest terms: every other
term of the window has to occur within SPAN words, in any order; postings meet in
buckets of positions, so a long document costs no more than many short ones. Only DataFrame
functions are used.

Words are maximal runs of digits, a-z and characters beyond ASCII, after A-Z are
lower-cased. A null text has no words. Documents are told apart by doc_id and
content: rows that repeat both are one document listed twice and get the same
result; a null doc_id is a value like any other. Empty tables on either side give no hits.
Other columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.llm.common import column, lower_ascii, packed, stored, text_of, unpacked

WINDOW = 10
# How far the words of a near match may lie from its rarest word.
SPAN = 12
# How many of a window's rarest terms are intersected before whole documents' lists are.
RAREST = 2

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(f"({_WORD}+)"), F.lit(1))


def benchmark_windows(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """words (a window's) and items (ids, as strings, of those that hold it).

    An item of fewer words than size, but not none, is one window.
    """
    items = benchmark.select(
        F.coalesce(column(item_id).cast("string"), F.lit("")).alias("item"),
        words_of(text_of(text)).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    cut = items.select("item", "words", F.explode(starts).alias("start"))
    return (
        cut.select("item", F.slice("words", F.col("start"), F.lit(size)).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
    )


_DOC = ["doc", "content"]
_PLACE = [*_DOC, "window", "length", "start"]
# What no text has as a word, and the term it stands for.
_NO_WORD, _TOTAL = "\0", -1


class PositionalIndex:
    """Postings of the benchmark's terms in the documents, and the terms of its windows.

    Windows and terms grow with the benchmark alone. They are stored, so that Spark
    knows their size: it broadcasts them while they are small, and else shuffles.
    """

    def __init__(self, docs, benchmark, doc_id, text, item_id, item_text, size, count_words=True):
        self.windows = stored(
            benchmark_windows(benchmark, item_id, item_text, size).withColumn(
                "window", F.monotonically_increasing_id()
            )
        )
        terms = stored(
            self.windows.select(F.explode("words").alias("spelling"))
            .distinct()
            .select(
                "spelling",
                F.lower("spelling").alias("folded"),
                F.monotonically_increasing_id().alias("term"),
            )
        )
        found = stored(self._occurrences(docs, terms, doc_id, text, count_words))
        self.postings = found.where(F.col("term") != _TOTAL)
        # Per row of docs: how many words it has, if they are counted.
        self.sizes = found.where(F.col("term") == _TOTAL).select(
            *_DOC, F.col("position").cast("long").alias("n_words")
        )
        frequency = self.postings.groupBy("term").agg(F.count("*").alias("n"))
        in_order = self.windows.select(
            "window", F.size("words").alias("length"), F.posexplode("words").alias("offset", "spelling")
        )
        # Without an occurrence of every term a window can't occur.
        counted = in_order.join(terms, "spelling").join(frequency, "term", "left")
        of_window = Window.partitionBy("window")
        self.terms = stored(
            counted.withColumn("rarest", F.min(F.coalesce("n", F.lit(0))).over(of_window))
            .where("rarest > 0")
            .select(
                "window",
                "length",
                "offset",
                "term",
                F.row_number().over(of_window.orderBy("n", "offset")).alias("rank"),
            )
        )

    @staticmethod
    def _occurrences(docs, terms, doc_id, text, count_words) -> DataFrame:
        """(term, doc, content, position); the position counts all words of a document.

        Words are matched ignoring all case first, which is fast, then exactly. A posting of the
        term _TOTAL for each row has its number of words as position, so that texts are
        split only once.
        """
        body = text_of(text)
        split = docs.select(
            column(doc_id).alias("doc"),
            F.xxhash64(body).alias("content"),
            F.split(body, _BETWEEN).alias("words"),
        )
        word, spelling = F.col("word"), F.col("spelling")
        same = (word == spelling) | (lower_ascii(word) == spelling)
        if not count_words:
            words = split.select(*_DOC, F.posexplode("words").alias("position", "word"))
            found = words.join(terms, F.lower(word) == F.col("folded")).where(same)
            return found.select("term", *_DOC, "position")
        # Before the first and after the last separator may be nothing.
        edges = [F.when(F.element_at("words", at) == "", 1).otherwise(0) for at in (1, -1)]
        total = F.greatest(F.size("words") - edges[0] - edges[1], F.lit(0))
        marked = split.select(*_DOC, total.alias("total"), F.concat(F.array(F.lit(_NO_WORD)), "words").alias("words"))
        words = marked.select(*_DOC, "total", F.posexplode("words").alias("position", "word"))
        own = terms.sparkSession.range(1).select(
            F.lit(_NO_WORD).alias("spelling"), F.lit(_NO_WORD).alias("folded"), F.lit(_TOTAL).cast("long").alias("term")
        )
        return (
            words.join(terms.unionByName(own), F.lower(word) == F.col("folded"))
            .where(same)
            .select(
                "term", *_DOC, F.when(F.col("term") == _TOTAL, F.col("total")).otherwise(F.col("position")).alias("position")
            )
        )

    def places(self, ranks: Column) -> DataFrame:
        """Where windows would start, by each occurrence of their terms of these ranks."""
        return self.postings.join(self.terms.where(ranks), "term").select(
            *_DOC, "window", "length", "rank", (F.col("position") - F.col("offset")).alias("start")
        )

    def postings_of(self, found: DataFrame) -> DataFrame:
        """The postings of the documents found."""
        some = stored(found.select(*_DOC).distinct())
        return self.postings.alias("p").join(some.alias("s"), _same_doc("p", "s"), "left_semi")


def _same_doc(left: str, right: str) -> Column:
    same = F.col(f"{left}.doc").eqNullSafe(F.col(f"{right}.doc"))
    return same & (F.col(f"{left}.content") == F.col(f"{right}.content"))


def _all_terms(places: DataFrame, first: int, last: Column) -> DataFrame:
    """Places confirmed by a term of every rank from first to last."""
    bits = F.bit_or(F.expr("shiftleft(1L, rank)")).alias("bits")
    ranks = F.bit_count("bits") == last - F.lit(first) + 1
    return places.groupBy(*_PLACE).agg(bits).where(ranks).select(*_PLACE)


def find_phrases(index: PositionalIndex) -> DataFrame:
    """Every exact occurrence of a window: doc, content, window, length, start."""
    few = stored(
        _all_terms(
            index.places(F.col("rank") <= RAREST), 1, F.least(F.lit(RAREST), F.col("length"))
        )
    )
    expected = few.join(index.terms.where(F.col("rank") > RAREST).drop("length"), "window").select(
        *_PLACE, "rank", "term", (F.col("start") + F.col("offset")).alias("position")
    )
    same = _same_doc("e", "p") & F.expr("e.term = p.term AND e.position = p.position")
    confirmed = (
        expected.alias("e").join(index.postings_of(few).alias("p"), same).select("e.*")
    )
    whole = _all_terms(confirmed, RAREST + 1, F.col("length"))
    return whole.unionByName(few.where(F.col("length") <= RAREST))


def find_near(index: PositionalIndex, span: int = SPAN) -> DataFrame:
    """doc, content and window wherever all of a window's words lie, in any order,
    within span words of an occurrence of the rarest of them."""
    bucket = F.floor(F.col("position") / (span + 1))
    # A term that a window repeats has to occur once; ranks number the different terms.
    order = Window.partitionBy("window").orderBy("rank")
    terms = stored(
        index.terms.groupBy("window", "term")
        .agg(F.min("rank").alias("rank"))
        .select("window", "term", F.row_number().over(order).alias("rank"))
    )
    wanted = terms.groupBy("window").agg(F.count("*").alias("wanted"))

    def confirmed(anchors: DataFrame, ranks: Column) -> DataFrame:
        """(doc, content, window, anchor, term) for terms of these ranks that occur near an anchor."""
        some = terms.where(ranks)
        around = F.explode(F.array(*(F.floor(F.col("anchor") / (span + 1)) + i for i in (-1, 0, 1))))
        expected = anchors.join(some.select("window", "term"), "window").withColumn("bucket", around)
        postings = index.postings.join(some.select("term").distinct(), "term", "left_semi")
        near = F.abs(F.col("e.anchor") - F.col("p.position")) <= span
        return (
            expected.alias("e")
            .join(
                postings.withColumn("bucket", bucket).alias("p"),
                _same_doc("e", "p") & F.expr("e.term = p.term AND e.bucket = p.bucket") & near,
            )
            .select("e.doc", "e.content", "e.window", "e.anchor", "e.term")
            .distinct()
        )

    first = index.postings.join(terms.where("rank = 1"), "term").select(
        *_DOC, "window", F.col("position").alias("anchor")
    )
    # Most places fail at the second term already.
    second = stored(confirmed(first, F.col("rank") == 2).drop("term"))
    found = (
        confirmed(second, F.col("rank") > 2)
        .groupBy(*_DOC, "window", "anchor")
        .agg((F.count("*") + 2).alias("found"))
        .join(wanted, "window")
        .where("found = wanted")
    )
    ones = first.join(wanted.where("wanted = 1"), "window")
    twos = second.join(wanted.where("wanted = 2"), "window")
    parts = [part.select(*_DOC, "window") for part in (found, ones, twos)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """Per row of docs: doc, content, n_words, n_hit, n_items, items_sha256, contaminated, n_near, near_sha256.

    n_hit counts the words inside any occurrence of a window of size words,
    n_items the benchmark items with such a window; items_sha256 is the digest of
    their ids, sorted as strings and joined by commas. n_near and near_sha256 say the same of
    items with a window whose words all lie near each other (see find_near), in any
    order; they don't make a document contaminated. content, a hash of the text, tells
    apart rows that share a doc_id. Very long texts are split whole.
    """
    index = PositionalIndex(docs, benchmark, doc_id, text, item_id, item_text, size)
    matches = stored(find_phrases(index))
    spans = F.explode(F.expr("sequence(start, start + length - 1)")).alias("position")
    hits = matches.select(*_DOC, spans).distinct().groupBy(*_DOC).agg(F.count("*").alias("n_hit"))

    def items_of(found: DataFrame, name: str) -> DataFrame:
        return (
            found.select(*_DOC, "window")
            .distinct()
            .join(index.windows.select("window", F.explode("items").alias("item")), "window")
            .groupBy(*_DOC)
            .agg(F.array_sort(F.collect_set("item")).alias(name))
        )

    found = stored(
        hits.alias("h")
        .join(items_of(matches, "items").alias("i"), _same_doc("h", "i"))
        .select("h.doc", "h.content", "n_hit", "items")
    )
    near = stored(items_of(find_near(index), "near"))
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")

    def count(items: str) -> Column:
        return F.size(F.coalesce(items, none)).cast("long")

    def digest(items: str) -> Column:
        return F.sha2(F.concat_ws(",", F.coalesce(items, none)), 256)

    return (
        index.sizes.alias("d")
        .join(found.alias("f"), _same_doc("d", "f"), "left")
        .join(near.alias("n"), _same_doc("d", "n"), "left")
        .select(
            "d.doc",
            "d.content",
            "n_words",
            n_hit.alias("n_hit"),
            count("items").alias("n_items"),
            digest("items").alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
            count("near").alias("n_near"),
            digest("near").alias("near_sha256"),
        )
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of docs that hold no window of the benchmark, with all columns."""
    index = PositionalIndex(docs, benchmark, doc_id, text, "item_id", "text", WINDOW, count_words=False)
    found = stored(find_phrases(index).select(*_DOC).distinct())
    rows = docs.select(
        packed(docs.columns).alias("row"),
        column(doc_id).alias("doc"),
        F.xxhash64(text_of(text)).alias("content"),
    )
    clean = rows.alias("r").join(found.alias("f"), _same_doc("r", "f"), "left_anti")
    return clean.select(*unpacked(docs.columns, "row"))

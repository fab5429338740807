"""Benchmark decontamination over a positional inverted index; DataFrame functions only.

The index holds a posting (row, position, term) for every word of the training documents that
is a word of the test set, and is written once to the shared folder. All that follows reads it: the
terms' numbers of postings, the lists of each test window's rarest terms, shifted by the terms'
offsets and intersected, and for proximity the lists of the other terms. Exact matches are at
last compared word by word with the document.

Documents go by a number of their id and text, so rows without an id, or with one that another
text has too, are searched like all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from prodseries.llm.common import BROADCAST_BYTES, maybe_broadcast, row_key, written

# What separates words once A-Z are lower-cased: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
# Lists that are intersected before the words themselves are compared.
RAREST = 2
# Generous sizes of rows when a broadcast is decided: of the lookup table, a candidate, a document's hits.
LOOKUP_ROW, CANDIDATE_ROW, HIT_ROW = 100, 64, 200
# Postings that a task holds before it writes them.
POSTINGS_GROUP = 8 << 20


def words_of(text: Column) -> Column:
    """Words of a text with A-Z (and no other letter) lower-cased; null has none.

    Splitting is some eight times as fast as extracting the matches.
    """
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(folded, SEPARATORS), "")


def test_windows(items: DataFrame, id_col: str, text_col: str, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(windows: win, words) with each distinct window once, and (win, item_id).

    An item of fewer words than the width is one window; one without words (null, empty) has
    none. Repeated items and windows are kept once.
    """
    words = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words"))
    several = F.transform(
        F.sequence(F.lit(1), F.size("words") - (width - 1)), lambda i: F.slice("words", i, F.lit(width))
    )
    each = words.filter(F.size("words") > 0).select(
        "item_id",
        F.explode(F.when(F.size("words") >= width, several).otherwise(F.array("words"))).alias("words"),
    )
    windows = written(
        each.select("words").distinct().withColumn("win", F.monotonically_increasing_id()), "test-windows"
    )
    owners = written(each.join(windows, "words").select("win", "item_id").distinct(), "test-items")
    return windows, owners


def test_terms(windows: DataFrame) -> DataFrame:
    """(word, term) with a number for each distinct word of the windows."""
    words = windows.select(F.explode("words").alias("word")).distinct()
    return written(words.withColumn("term", F.monotonically_increasing_id()), "terms")


def test_postings(windows: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, win, offset, length) of every word of every window."""
    each = windows.select("win", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
    return written(each.join(terms, "word").drop("word"), "test-postings")


def training_postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: (row, pos, term) for each word of ``docs`` (row, text) that is a term.

    Postings stay where their documents are read unless the terms are too many to be broadcast.
    """
    everywhere = docs.select("row", F.posexplode(words_of(F.col("text"))).alias("pos", "word"))
    return written(everywhere.join(maybe_broadcast(terms, LOOKUP_ROW), "word").select("row", "pos", "term"), "postings", POSTINGS_GROUP)


def _ranked(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The windows' terms with their rank from the rarest on, by postings in all documents."""
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("win").orderBy(F.coalesce("n", F.lit(0)), "offset"))
    return written(wanted.join(counts, "term", "left").withColumn("rank", rank).drop("n"), "lookup")


def _shifted(index: DataFrame, lookup: DataFrame) -> DataFrame:
    """Postings of the terms in ``lookup``, each with the window start that its offset gives."""
    return index.join(maybe_broadcast(lookup, LOOKUP_ROW), "term").withColumn("start", F.col("pos") - F.col("offset"))


def _index_of(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, width: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The windows, their items, the index and the windows' ranked terms."""
    windows, owners = test_windows(items, item_id, item_text, width)
    terms = test_terms(windows)
    index = training_postings(docs, terms)
    return windows, owners, index, _ranked(index, test_postings(windows, terms))


def _words_around(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The documents that ``places`` (row, and others) are in, with their words and places."""
    fields = [c for c in places.columns if c != "row"]
    by_row = written(places.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("places")), "places")
    small = places.count() * CANDIDATE_ROW <= BROADCAST_BYTES
    rows = docs.join(F.broadcast(by_row) if small else by_row, "row")
    return rows.select("row", "places", words_of(F.col("text")).alias("doc_words"))


def phrase_matches(docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text",
                   width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Exact occurrences (row, win, start, length) of test windows, and (win, item_id).

    ``docs`` has row and text. The lists of a window's rarest terms are intersected on
    (row, adjusted start); the few places that remain are compared word by word.
    """
    windows, owners, index, ranked = _index_of(docs, items, item_id, item_text, width)
    lists = _shifted(index, ranked.filter(F.col("rank") <= RAREST))
    # One exchange: a bit for each list that has the place.
    met = lists.groupBy("row", "win", "start", "length").agg(F.bit_or(F.expr("shiftleft(1, rank - 1)")).alias("lists"))
    wanted = F.expr(f"shiftleft(1, least(length, {RAREST})) - 1")
    places = written(met.filter((F.col("lists") == wanted) & (F.col("start") >= 0)).drop("lists"), "places")
    said = _words_around(docs, places).select(
        "row",
        F.explode(
            F.transform("places", lambda p: F.struct(p.win.alias("win"), p.start.alias("start"), p.length.alias("length"),
                        F.slice("doc_words", p.start + 1, p.length).alias("said")))
        ).alias("p"),
    ).select("row", "p.*")
    exact = said.join(windows, "win").filter(F.col("said") == F.col("words"))
    return written(exact.select("row", "win", "start", "length"), "matches"), owners


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int = 5, width: int = WINDOW, id_col: str = "doc_id",
                      text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start): places where every term of a window stands within ``slop`` words of
    its place there, counted from the window's rarest term, in any order. ``start`` is where the
    window would start by that term (it may lie before the document).

    Candidates come from the lists of the two rarest terms; each is confirmed on all terms.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    windows, owners, index, ranked = _index_of(base.select("row", "text"), items, item_id, item_text, width)
    lists = _shifted(index, ranked.filter(F.col("rank") <= RAREST))
    near = Window.partitionBy("row", "win").orderBy("start").rangeBetween(-slop, slop)
    met = lists.withColumn("lists", F.bit_or(F.expr("shiftleft(1, rank - 1)")).over(near))
    wanted = F.expr(f"shiftleft(1, least(length, {RAREST})) - 1")
    places = written(
        met.filter((F.col("rank") == 1) & (F.col("lists") == wanted)).select("row", "win", "start", "length").distinct(), "near-places"
    )
    around = _words_around(base.select("row", "text").dropDuplicates(["row"]), places).select("row", "doc_words", F.explode("places").alias("p")).select("row", "doc_words", "p.*")

    def close(word: Column, offset: Column) -> Column:
        first = F.col("start") + offset - slop
        low = F.greatest(first, F.lit(0))
        return F.array_contains(F.slice("doc_words", low + 1, F.greatest(first + 2 * slop + 1 - low, F.lit(0))), word)

    pairs = F.arrays_zip(F.col("words").alias("word"), F.sequence(F.lit(0), F.size("words") - 1).alias("offset"))
    found = around.join(windows, "win").filter(F.forall(pairs, lambda x: close(x["word"], x["offset"])))
    matched = written(found.select("row", "win", "start").join(owners, "win").select("row", "item_id", "start").distinct(), "near-matches")
    return base.select("doc_id", "row").distinct().join(matched, "row").select("doc_id", "item_id", "start").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any occurrence), item_ids (sorted as
    strings, of items that occur), contaminated.

    Null and empty texts have no words. Rows that repeat an id with the same text give equal
    rows; rows with a null id, or with an id of several texts, are searched each by itself. An
    item with a null id makes hits but is not named. Empty tables give an empty result, or clean
    documents; other columns are not read.
    """
    key = row_key(F.col(id_col), F.col(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), key.alias("row"), F.col(text_col).alias("text"))
    found, owners = phrase_matches(base.select("row", "text"), items, item_id, item_text, width)
    spans = found.select("row", "start", "length").distinct()
    hit = (
        spans.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("p"))
        .distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_hit"))
    )
    occurring = (
        found.select("row", "win").distinct().join(owners, "win").select("row", "item_id").distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    hits = maybe_broadcast(written(hit.join(occurring, "row"), "hits"), HIT_ROW)
    return (
        base.select("doc_id", "row", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
        .join(hits, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without an occurrence of a test window, with all their columns. Each row is
    searched by itself, so rows without an id are searched like all others."""
    key = row_key(docs[id_col], docs[text_col])
    found, _ = phrase_matches(docs.select(key.alias("row"), docs[text_col].alias("text")), items)
    dirty = written(found.select(F.col("row").alias("dirty_key")).distinct(), "dirty")
    # Few rows against whole texts: these do not move while the few are counted as small.
    return docs.join(maybe_broadcast(dirty, 24), key == dirty["dirty_key"], "left_anti")

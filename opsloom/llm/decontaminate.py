"""Benchmark decontamination with a positional inverted index of the training words.

Words of benchmark items are counted in the training texts first. Each window of an item then
leads with its rarest words: only their postings (word, row, position) are stored. The lists are
shifted by the place of the word in the window and intersected from the rarest on; what is left
is compared word by word. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import staged, unused

WINDOW_WORDS = 10
# How many of a window's rarest words are looked up in the index before words are compared.
KEY_WORDS = 3
# Distinct words or windows that are sent to all tasks, at most; more of them are joined by shuffle.
BROADCAST_ROWS = 200_000
# What separates words, and the letters that are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lowered; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _sized(frame: DataFrame) -> DataFrame:
    """``frame``, marked for broadcast if it was counted to be small."""
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def benchmark_windows(benchmark: DataFrame, *, key: str = "item_id", text: str = "text", size: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, window, words``: each run of ``size`` words, or all words of a shorter item.

    Items without an id or without words have no windows; repeated items count once.
    """
    items = benchmark.select(F.col(key).alias("item_id"), words_of(F.col(text)).alias("all"))
    items = items.where(F.col("item_id").isNotNull() & (F.size("all") > 0))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - size, F.lit(0)))
    rows = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("all", s + 1, size))).alias("words"))
    return rows.distinct().withColumn("window", F.array_join("words", " "))


def word_counts(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``word, n``: how often each word of the vocabulary stands in ``rows.text``."""
    words = rows.select(F.explode(words_of(F.col("text"))).alias("word"))
    return words.join(_sized(vocabulary), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))


def postings(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``word, row_a, row_b, place`` of the vocabulary's words: the inverted index."""
    placed = rows.select("row_a", "row_b", F.posexplode(words_of(F.col("text"))).alias("place", "word"))
    return placed.join(_sized(vocabulary), "word", "left_semi").select("word", "row_a", "row_b", "place")


def keyed_windows(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows whose words all occur, with the words to look up: ``keys`` of (n, place, word)."""
    distinct = windows.select("window", "words").distinct()
    terms = distinct.select("window", F.posexplode("words").alias("place", "word"))
    ranked = terms.join(counts, "word", "left").groupBy("window")
    keys = ranked.agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "word"))).alias("keys"),
        F.count("*").alias("size"),
    )
    return keys.where(F.col("keys")[0]["n"] > 0)


def phrase_candidates(index: DataFrame, keyed: DataFrame) -> DataFrame:
    """``row_a, row_b, start, size``: where the rarest words of a window stand as they do in it."""

    def key(rank: int) -> Column:
        return F.get("keys", F.least(F.lit(rank), F.size("keys") - 1))

    found = None
    for rank in range(KEY_WORDS):
        word, place = key(rank)["word"], key(rank)["place"]
        if found is None:
            lead = keyed.withColumn("word", word)
            found = index.join(_sized(lead), "word").withColumn("start", F.col("place") - place)
            found = found.where("start >= 0").select("row_a", "row_b", "start", "size", "keys")
        else:
            wanted = found.withColumn("word", word).withColumn("place", F.col("start") + place)
            found = wanted.join(index, ["word", "row_a", "row_b", "place"], "left_semi").select("row_a", "row_b", "start", "size", "keys")
    return found.select("row_a", "row_b", "start", "size").distinct()


def near_matches(index: DataFrame, pairs: DataFrame, distance: int) -> DataFrame:
    """``pair, row_a, row_b``: rows in which two words stand at most ``distance`` words apart.

    ``pairs`` holds ``pair, first, second``. Positions meet in strips of ``distance`` words and the
    strip after, so no list is multiplied with a whole other one.
    """
    strip = F.floor(F.col("place") / distance)
    left = pairs.join(index.withColumnRenamed("word", "first"), "first").select(
        "pair", "second", "row_a", "row_b", F.col("place").alias("at"), F.explode(F.array(strip - 1, strip, strip + 1)).alias("strip")
    )
    right = index.select(F.col("word").alias("second"), "row_a", "row_b", "place", strip.alias("strip"))
    met = left.join(right, ["second", "row_a", "row_b", "strip"])
    return met.where((F.abs(F.col("at") - F.col("place")) <= distance) & (F.col("at") != F.col("place"))).select("pair", "row_a", "row_b").distinct()


def _identified(frame: DataFrame, key: str, text: str, one: str, two: str) -> DataFrame:
    """Two hashes tell rows apart by key and text; rows equal in both are one."""
    key_column, text_column = F.col(f"`{key}`"), F.col(f"`{text}`")
    return frame.withColumns({one: F.xxhash64(text_column, key_column), two: F.hash(key_column, text_column)})


def find_phrases(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """``row_a, row_b, start, size, item_id``: every occurrence of a window in ``rows.text``."""
    windows = staged(windows, "windows")
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = staged(word_counts(rows, vocabulary), "word-counts")
    keyed = staged(keyed_windows(windows, counts), "keyed-windows")
    used = keyed.select(F.explode(F.slice("keys", 1, KEY_WORDS)["word"]).alias("word")).distinct()
    index = staged(postings(rows, used), "postings")
    candidates = phrase_candidates(index, keyed)
    # Bounded by the words of the text and the lengths of windows.
    places = candidates.groupBy("row_a", "row_b").agg(F.collect_set(F.struct("start", "size")).alias("places"))
    texts = rows.join(places, ["row_a", "row_b"]).withColumn("all", words_of(F.col("text")))
    read = F.transform(
        "places",
        lambda p: F.struct(p["start"].alias("start"), p["size"].alias("size"), F.array_join(F.slice("all", p["start"] + 1, p["size"].cast("int")), " ").alias("window")),
    )
    spots = texts.select("row_a", "row_b", F.explode(read).alias("spot")).select("row_a", "row_b", "spot.*").distinct()
    return spots.join(windows.select("window", "item_id"), "window").select("row_a", "row_b", "start", "size", "item_id")


def mark_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW_WORDS,
) -> DataFrame:
    """``documents`` with ``n_words``, ``n_hit``, ``n_items``, ``items``, ``contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` lists the ids, as
    sorted text, of the items with one. Null texts have no words, an empty benchmark marks
    nothing, repeated rows are marked alike. Columns of these names are replaced, others kept.
    """
    added = ("n_words", "n_hit", "n_items", "items", "contaminated")
    kept = documents.select(*(F.col(f"`{c}`") for c in documents.columns if c not in added))
    one, two, count, hit, listed = unused(kept, "row_a", "row_b", "word_count", "hit_count", "hit_items")
    rows = _identified(kept, key, text, one, two)
    windows = benchmark_windows(benchmark, key=item_key, text=item_text, size=size)
    slim = rows.select(F.col(one).alias("row_a"), F.col(two).alias("row_b"), F.col(f"`{text}`").alias("text"))
    found = staged(find_phrases(slim, windows), "phrases")
    # All three lists are bounded by the text's words and by the benchmark's items.
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).cast("int").alias("end"))))
    joined = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    hits = found.groupBy("row_a", "row_b").agg(
        spans.alias("spans"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    hits = hits.select(F.col("row_a").alias(one), F.col("row_b").alias(two), joined.cast("long").alias(hit), F.col("items").alias(listed))
    counted = rows.withColumn(count, F.size(words_of(F.col(f"`{text}`"))).cast("long")).join(hits, [one, two], "left")
    items = F.coalesce(listed, F.array().cast("array<string>"))
    return counted.select(
        *(F.col(f"`{c}`") for c in kept.columns),
        F.col(count).alias("n_words"),
        F.coalesce(hit, F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.col(hit).isNotNull().alias("contaminated"),
    )


def benchmark_neighbours(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    terms: int = 2,
    distance: int = WINDOW_WORDS,
) -> DataFrame:
    """``key, item_id``: documents in which an item's rarest words stand close, whatever lies between.

    Of each item the ``terms`` distinct words that are rarest in the documents are taken, ties by the
    word; the item is near where each pair of neighbours among them, from the rarest on, stands at
    most ``distance`` words apart. An item with fewer distinct words, or with a word that no document
    has, is near nothing; rows with a null key or id, null and empty texts likewise. Repeated rows and
    items count once.
    """
    if terms < 2:
        raise ValueError("proximity needs two or more terms")
    items = benchmark.select(F.col(f"`{item_key}`").alias("item_id"), words_of(F.col(f"`{item_text}`")).alias("all"))
    words = staged(items.where("item_id is not null").select("item_id", F.explode("all").alias("word")).distinct(), "item-words")
    source = documents.where(F.col(f"`{key}`").isNotNull())
    rows = _identified(source.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")), "id", "text", "row_a", "row_b")
    counts = staged(word_counts(rows, words.select("word").distinct()), "word-counts")
    ranked = words.join(counts, "word", "left").groupBy("item_id")
    # As many words as an item has.
    rarest = F.slice(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))), 1, terms)
    chosen = ranked.agg(rarest.alias("keys")).where((F.size("keys") == terms) & (F.col("keys")[0]["n"] > 0))
    steps = F.array(*[F.struct(F.col("keys")[i]["word"].alias("first"), F.col("keys")[i + 1]["word"].alias("second")) for i in range(terms - 1)])
    pairs = staged(chosen.select("item_id", F.inline(steps)), "term-pairs")
    used = pairs.select(F.explode(F.array("first", "second")).alias("word")).distinct()
    index = staged(postings(rows.select("row_a", "row_b", "text"), used), "postings")
    # Items that share a pair look it up once.
    distinct = pairs.select("first", "second").distinct().withColumn("pair", F.struct("first", "second"))
    met = near_matches(index, distinct, distance)
    held = met.join(pairs.withColumn("pair", F.struct("first", "second")), "pair").groupBy("item_id", "row_a", "row_b").agg(F.count("*").alias("n"))
    ids = rows.select("id", "row_a", "row_b").distinct()
    return held.where(F.col("n") == terms - 1).join(ids, ["row_a", "row_b"]).select(F.col("id").alias(key), "item_id").distinct()

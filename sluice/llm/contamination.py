"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Texts and benchmark items are lower-cased and cut into words of letters, digits and non-ASCII
characters. A text is contaminated by an item if, at some alignment, ``WINDOW`` consecutive words of
both agree in all but ``MISSES`` places. Items shorter than the window have to occur whole; items of
fewer than six words (the weight of a seed) are too short to be told from prose and never match.

A seed is a fixed mask over a few words that ignores the positions between. The two masks below are
such that every window with at most two substituted words contains a hit of one of them, whatever
the places (``tests/llm`` tries all), so seeds lose nothing. Texts and items are looked at in pieces
that share ``WINDOW - 1`` words, so every window lies in a piece and no row grows with a text. Pieces
of items with equal words are looked for once, as one needle. Seed hashes of texts and needles are
joined; around every hit the windows that contain it are compared word by word.

Seeds (hash, needle, place) and needles are broadcast while they are at most ``BROADCAST_SEEDS`` with
``BROADCAST_BYTES``. Up to ``SLICES`` times that, one slice of the needles is broadcast after the
other, and each takes a pass over the texts. For a larger benchmark seeds of texts are shuffled to
those of needles, without words; those of the texts that were hit are read again. The result is the
same. Null and empty texts and items match nothing. Repeated rows get the same result; items with one
id are one item, items with a null id count for contamination but are not listed. Other columns of
the documents are left out.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import staged, unused

MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 4, 6, 9, 10))
WINDOW = 13
MISSES = 2
BROADCAST_SEEDS = 500_000
#: Words can be long, so the bytes of seeds and needles are bounded as well.
BROADCAST_BYTES = 64 * 1024 * 1024
SLICES = 4
#: A piece has the words of so many windows.
TEXT_PIECE = 1024
ITEM_PIECE = 256
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _BREAKS), "")


def _pieces(rows: DataFrame, windows: int) -> DataFrame:
    """``rows(words, ...)`` in pieces of so many windows; adds piece, the place of its first word."""
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    # The outer form for the reason given in ``with_seeds``.
    placed = rows.withColumn("piece", F.explode_outer(F.sequence(F.lit(0), last, F.lit(windows))))
    return placed.withColumn("words", F.slice("words", F.col("piece") + 1, windows + WINDOW - 1))


def _seeds(hashes: str, number: int) -> Column:
    """Hashes of one mask at every place it fits."""
    mask = MASKS[number]
    last = F.size(hashes) - 1 - mask[-1]
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        places,
        lambda i: F.xxhash64(F.lit(number), *(F.get(hashes, i + offset) for offset in mask)),
    )


def with_seeds(rows: DataFrame) -> DataFrame:
    """``rows(words, ...)`` once for every seed: adds seed, at (its first word) and mask."""
    hashed = rows.withColumn("_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    every = hashed.select(
        *rows.columns,
        F.greatest(F.size("_hashes") - MASKS[0][-1], F.lit(0)).alias("_first"),
        F.concat(*(_seeds("_hashes", n) for n in range(len(MASKS)))).alias("_seeds"),
    )
    # The outer form: for the inner one the optimiser would test the size of the array first, and
    # push that test, with the hashes written out at every use, below the projections.
    placed = every.select(
        *rows.columns, "_first", F.posexplode_outer("_seeds").alias("_place", "seed")
    )
    second = F.col("_place") >= F.col("_first")
    return placed.select(
        *rows.columns,
        "seed",
        F.when(second, F.col("_place") - F.col("_first")).otherwise(F.col("_place")).alias("at"),
        second.cast("int").alias("mask"),
    )


def _matching_windows() -> Column:
    """Item positions of windows that contain the hit and agree well enough."""
    size = F.least(F.lit(WINDOW), F.size("item_words"))
    least = F.when(F.size("item_words") >= WINDOW, WINDOW - MISSES).otherwise(size)
    span = F.when(F.col("mask") == 0, MASKS[0][-1] + 1).otherwise(MASKS[1][-1] + 1)
    shift = F.col("at") - F.col("item_at")
    low = F.greatest(F.lit(0), F.col("item_at") + span - size, -shift)
    high = F.least(
        F.col("item_at"), F.size("item_words") - size, F.size("words") - size - shift
    )

    def agreeing(start: Column) -> Column:
        same = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda n: F.get("words", shift + start + n) == F.get("item_words", start + n),
        )
        return F.size(same) >= least

    starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    return F.filter(starts, agreeing)


def _small(frame: DataFrame) -> DataFrame:
    """A staged table of keys, broadcast if it has few rows."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_SEEDS else frame


def _benchmark_tables(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """owners(needle, item_id), needles(needle, item_words) and seeds(seed, needle, item_at)."""
    items = benchmark.where("text IS NOT NULL").select(
        "item_id", words_of(F.col("text")).alias("words")
    )
    parts = _pieces(items, ITEM_PIECE).where(F.size("words") > MASKS[0][-1])
    parts = staged(parts.select("item_id", "words").distinct(), "items")
    # The numbers are written with the words, so a lost task changes none that is in use.
    needles = staged(
        parts.select(F.col("words").alias("item_words"))
        .distinct()
        .select(F.monotonically_increasing_id().alias("needle"), "item_words"),
        "needles",
    )
    owners = parts.join(needles, F.col("words") == F.col("item_words")).select("needle", "item_id")
    seeds = with_seeds(needles.withColumnRenamed("item_words", "words")).select(
        "seed", "needle", F.col("at").alias("item_at")
    )
    return staged(owners, "owners"), needles, staged(seeds, "seeds")


def _covered(hits: DataFrame) -> DataFrame:
    """(doc_id, key, needle, first_word, last_word) of hits that have a matching window."""
    found = hits.select(
        "doc_id",
        "key",
        "needle",
        (F.col("piece") + F.col("at") - F.col("item_at")).alias("shift"),
        F.least(F.lit(WINDOW), F.size("item_words")).alias("size"),
        _matching_windows().alias("starts"),
    )
    # Hits without a window go after the aggregate: a test before it would become part of the join
    # and make every text position carry its piece's words.
    first = F.min(F.array_min("starts") + F.col("shift"))
    last = F.max(F.array_max("starts") + F.col("shift") + F.col("size") - 1)
    return (
        found.groupBy("doc_id", "key", "needle")
        .agg(first.cast("bigint").alias("first_word"), last.cast("bigint").alias("last_word"))
        .where("first_word IS NOT NULL")
    )


def _hit_by_shuffle(texts: DataFrame, needles: DataFrame, seeds: DataFrame) -> DataFrame:
    """Hits with the words of both sides; positions of texts travel without theirs."""
    placed = with_seeds(_pieces(_with_words(texts), TEXT_PIECE)).select(
        "doc_id", "key", "piece", "seed", "at", "mask"
    )
    hits = placed.join(seeds, "seed").drop("seed").distinct()
    hits = staged(hits, "hits", free=True)
    named = _small(staged(hits.select("doc_id", "key").distinct(), "hit-texts"))
    same = F.expr("t.doc_id <=> h.doc_id AND t.key = h.key")
    # Repeated rows have the same words.
    hit = texts.alias("t").join(named.alias("h"), same, "left_semi").dropDuplicates(["doc_id", "key"])
    pieces = _pieces(_with_words(hit), TEXT_PIECE)
    return (
        pieces.alias("t")
        .join(hits.alias("h"), same & F.expr("t.piece = h.piece"))
        .select("t.*", "needle", "at", "item_at", "mask")
        .join(needles, "needle")
    )


def _with_words(texts: DataFrame) -> DataFrame:
    return texts.select("doc_id", "key", words_of(F.col("text")).alias("words"))


def _matches(docs: DataFrame, needles: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id, key, needle, first_word, last_word) of texts and the needles they overlap."""
    texts = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("key"), "text")
    # A word costs its letters and the 24 bytes that an array spends on each element; a seed costs 72
    # bytes in a table of hashes.
    letters = F.octet_length(F.array_join("item_words", "")) + 24 * F.size("item_words")
    number = seeds.count()
    held = (needles.agg(F.sum(letters.cast("bigint"))).first()[0] or 0) + 72 * number
    slices = max(1, ceil(held / BROADCAST_BYTES))
    if number > BROADCAST_SEEDS:
        slices = max(slices, ceil(number / BROADCAST_SEEDS) if BROADCAST_SEEDS else SLICES + 1)
    if slices > SLICES:
        return _covered(_hit_by_shuffle(texts, needles, seeds))
    positions = with_seeds(_pieces(_with_words(texts), TEXT_PIECE))
    found = []
    for n in range(slices):
        own = F.pmod("needle", F.lit(slices)) == n
        hits = positions.join(F.broadcast(seeds.where(own)), "seed")
        found.append(_covered(hits.join(F.broadcast(needles.where(own)), "needle")))
        if slices > 1:  # only one slice is held at a time
            found[-1] = staged(found[-1], "slice", free=True)
    return reduce(DataFrame.union, found)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, key, item_id, first_word, last_word) of texts and the items they overlap.

    ``key`` is the hash of the row's text, the words are those of the text that matching windows
    cover, from the first to the last.
    """
    owners, needles, seeds = _benchmark_tables(benchmark)
    return (
        _matches(docs, needles, seeds)
        .join(owners, "needle")
        .groupBy("doc_id", "key", "item_id")
        .agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: doc_id, contaminated, n_items, items, first_word, last_word.

    ``items`` are the ids of the overlapping items in order, joined by commas; the words are those
    covered by matching windows, from the first to the last, else null.
    """
    per_text = (
        overlaps(docs, benchmark)
        .groupBy("doc_id", "key")
        .agg(
            F.collect_set("item_id").alias("found"),
            F.min("first_word").alias("first_word"),
            F.max("last_word").alias("last_word"),
        )
    )
    per_text = staged(per_text, "contaminated")
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"))
    return (
        rows.alias("d")
        .join(per_text.alias("f"), F.expr("d.doc_id <=> f.doc_id AND d.key = f.key"), "left")
        .select(
            "d.doc_id",
            F.col("first_word").isNotNull().alias("contaminated"),
            F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce(F.array_join(F.array_sort("found"), ","), F.lit("")).alias("items"),
            "first_word",
            "last_word",
        )
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text overlaps no item."""
    _, needles, seeds = _benchmark_tables(benchmark)
    doc, key = unused(docs.columns, 2)
    bad = staged(
        _matches(docs, needles, seeds)
        .select(F.col("doc_id").alias(doc), F.col("key").alias(key))
        .distinct(),
        "contaminated",
    )
    # Few keys are broadcast; else whole texts would be shuffled and sorted to lose some of them.
    return docs.join(
        _small(bad),
        F.col(doc).eqNullSafe(docs["doc_id"]) & (F.xxhash64(docs["text"]) == F.col(key)),
        "left_anti",
    )

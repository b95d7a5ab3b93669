"""Near duplicates of texts by b-bit MinHash.

Texts are compared as sets of word shingles. A signature keeps the lowest ``BITS`` bits of each of
``PERMUTATIONS`` minima; bands of whole minima bring candidates together. For a candidate pair the
share of equal b-bit lanes, corrected for lanes that are equal by chance, estimates the similarity;
pairs clearly below the threshold end there, all others are confirmed on their full sets.

Equal sets are collapsed first. Candidates of a band are then compared in three steps: every row
with the band's smallest id; the rows outside the band's largest component with a few rows of it;
and what is still outside with every row of another component that shares a band with it and that its
size and its shared shingles allow. Rows of that last step meet in blocks of bounded size, which
compare them in place: rows are sent, not pairs. Rows already known to be connected need no comparison, because only the component is asked
for, so a large group costs a few pairs a row while no candidate pair of different components goes
unchecked. The last two steps first count the shingles that a row has alone among all rows it could
meet: two rows have at most the smaller of the other counts in common, so a row with many edits of
its own can link with rows of few sizes or with none, and meets no others.

Lower-casing is by bytes A-Z. Null, empty and blank texts have no shingles, link with nothing and
stay. Texts shorter than a shingle have their whole word sequence as only shingle. Rows with a null
id have no component and stay. Rows that repeat an id are one member of a component: they share its
links. Extra columns of ``near_duplicate_groups``'s input are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import (
    as_signed,
    components,
    flat,
    mapped,
    mixed,
    run_hashes,
    staged,
    text_bytes,
    unused,
    word_hashes,
)

PERMUTATIONS = 128
#: Rows a band: a pair at similarity 0.8 misses all 32 bands with probability 5e-8.
ROWS = 4
BITS = 4
LANES = 64 // BITS
#: Candidates are given up only this many standard deviations below the threshold.
DEVIATIONS = 6.0
SHINGLE_WORDS = 5
PERCENT = 80
#: Rows of a component that rows outside it, but in a band with it, meet before all others.
PIVOTS = 12
#: Rows, and shingles of them, that one side of a comparison of blocks has on average at most.
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 21
#: Shingles of a block, and pairs, that are compared at once.
_SLICE, _PAIRS = 1 << 14, 1 << 12

_random = np.random.default_rng(7)
_FACTOR = _random.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_SHIFT = _random.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    hashes = word_hashes(text.lower()) if text else np.zeros(0, dtype=np.uint64)
    if not len(hashes):
        return hashes
    return np.unique(run_hashes(hashes, min(words, len(hashes))))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every permutation, over pieces of a long set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    found = np.full(PERMUTATIONS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, len(low), 4096):
        values = low[start : start + 4096]
        np.minimum(
            found, (values * _FACTOR[:, None] + _SHIFT[:, None]).min(axis=1), out=found
        )
    return found


def _signatures(words: int):
    def rows(batch: pa.RecordBatch):
        ids, sizes, first, second, bands, packed = [], [], [], [], [], []
        places = np.arange(0, 64, BITS, dtype=np.uint64)
        for doc, text in zip(batch["doc_id"].to_pylist(), text_bytes(batch["text"])):
            shingles = shingle_set(text, words)
            ids.append(doc)
            sizes.append(len(shingles))
            if not len(shingles) or doc is None:
                first.append(None)
                second.append(None)
                bands.append(None)
                packed.append(None)
                continue
            # Two sums of independent mixes name a set in 128 bits.
            first.append(int(as_signed(shingles.sum(keepdims=True))[0]))
            second.append(int(as_signed(mixed(shingles).sum(keepdims=True))[0]))
            low = minima(shingles).astype(np.uint64)
            grouped = low.reshape(-1, ROWS)
            keys = np.arange(1, len(grouped) + 1, dtype=np.uint64)
            for part in range(ROWS):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, part])
            bands.append(as_signed(keys).tolist())
            lanes = (low & np.uint64((1 << BITS) - 1)).reshape(-1, LANES) << places
            packed.append(as_signed(np.bitwise_or.reduce(lanes, axis=1)).tolist())
        yield {
            "doc_id": ids,
            "n_shingles": sizes,
            "set_a": first,
            "set_b": second,
            "bands": bands,
            "signature": packed,
        }

    return rows


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, signature) of every row."""
    schema = (
        "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, "
        "bands array<bigint>, signature array<bigint>"
    )
    return mapped(docs.select(F.col("doc_id").cast("bigint"), "text"), _signatures(words), schema)


def equal_lanes(left: str, right: str) -> Column:
    """How many b-bit lanes of two packed signatures agree."""
    ones = int("0" * (BITS - 1) + "1", 2)
    every = sum(ones << place for place in range(0, 64, BITS))
    every = every - (1 << 64) if every >= 1 << 63 else every

    def different(place: int) -> Column:
        bits = F.col(left)[place].bitwiseXOR(F.col(right)[place])
        folded = reduce(
            lambda a, b: a.bitwiseOR(b), (F.shiftrightunsigned(bits, n) for n in range(BITS))
        )
        return F.bit_count(folded.bitwiseAND(F.lit(every)))

    words = PERMUTATIONS // LANES
    return F.lit(PERMUTATIONS) - reduce(lambda a, b: a + b, (different(n) for n in range(words)))


def estimate(left: str, right: str) -> Column:
    """Similarity from the share of equal lanes, corrected for chance agreement."""
    chance = 2.0**-BITS
    return (equal_lanes(left, right) / PERMUTATIONS - chance) / (1 - chance)


def lowest_estimate(percent: int) -> float:
    chance, real = 2.0**-BITS, percent / 100
    agree = real + (1 - real) * chance
    spread = (agree * (1 - agree) / PERMUTATIONS) ** 0.5 / (1 - chance)
    return real - DEVIATIONS * spread


def _agreeing(words: int, percent: int):
    def rows(batch: pa.RecordBatch):
        left, right, known, last = [], [], None, None
        texts = zip(text_bytes(batch["text_a"]), text_bytes(batch["text_b"]))
        for a, b, (text_a, text_b) in zip(
            batch["a"].to_pylist(), batch["b"].to_pylist(), texts
        ):
            if (a, text_a) != last:
                known, last = shingle_set(text_a, words), (a, text_a)
            other = shingle_set(text_b, words)
            both = len(np.intersect1d(known, other, assume_unique=True))
            if both and 100 * both >= percent * (len(known) + len(other) - both):
                left.append(a)
                right.append(b)
        yield {"a": left, "b": right}

    return rows


def _common(values: np.ndarray, lengths: np.ndarray, left: np.ndarray, right: np.ndarray):
    """How many values each pair of rows has in common; a row's values are distinct."""
    both = np.zeros(len(left), dtype=np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    _, place, counts = np.unique(values, return_inverse=True, return_counts=True)
    # Values of one row alone need no place.
    often = counts > 1
    owner, place = owner[often[place]], (np.cumsum(often) - 1)[place[often[place]]]
    for start in range(0, int(often.sum()), _SLICE):
        here = (place >= start) & (place < start + _SLICE)
        bits = np.zeros((len(lengths), _SLICE), dtype=bool)
        bits[owner[here], place[here] - start] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for at in range(0, len(left), _PAIRS):
            part = slice(at, at + _PAIRS)
            both[part] += np.bitwise_count(packed[left[part]] & packed[right[part]]).sum(axis=1, dtype=np.int64)
    return both


def _joining(left: np.ndarray, right: np.ndarray) -> list[int]:
    """The places of pairs that join two parts not joined by an earlier pair."""
    above: dict[int, int] = {}

    def top(part: int) -> int:
        while part in above:
            part = above[part]
        return part

    places = []
    for place, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = top(a), top(b)
        if a != b:
            above[max(a, b)] = min(a, b)
            places.append(place)
    return places


def _block_links(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(group: pa.Table) -> pa.Table:
        ids, part, size, shared = (
            group[n].to_numpy() for n in ("doc_id", "part", "size", "shared")
        )
        outside = group["outside"].to_numpy()
        x, y = np.flatnonzero(outside), np.flatnonzero(~outside)
        bands, shingles = (group[n].combine_chunks() for n in ("bands", "shingles"))
        bands = bands.flatten().to_numpy().reshape(group.num_rows, -1)
        near = np.zeros((len(x), len(y)), dtype=bool)
        for band in bands.T:
            near |= band[x][:, None] == band[y]
        near &= part[x][:, None] != part[y]
        most = np.minimum(shared[x][:, None], shared[y])
        near &= most * (100 + percent) >= (size[x][:, None] + size[y]) * percent
        i, j = np.nonzero(near)
        left, right = x[i], y[j]
        lengths = shingles.value_lengths().to_numpy()
        both = _common(shingles.flatten().to_numpy(), lengths, left, right)
        fine = (both > 0) & (100 * both >= percent * (size[left] + size[right] - both))
        left, right = left[fine], right[fine]
        # Only components are asked for.
        told = _joining(part[left], part[right])
        return pa.Table.from_arrays([ids[left[told]], ids[right[told]]], schema=schema)

    return links


class _Candidates:
    """Rows that share a band with another row, and what is needed to compare them."""

    def __init__(self, docs: DataFrame, reps: DataFrame, words: int, percent: int):
        self.words, self.percent = words, percent
        keyed = reps.select("doc_id", F.explode("bands").alias("band"))
        # A band with one row gives no candidate; the smallest row of a band is its centre.
        centres = (
            keyed.groupBy("band")
            .agg(F.min("doc_id").alias("centre"), F.count("*").alias("n"))
            .where("n > 1")
        )
        self.bands = staged(keyed.join(centres, "band"), "bands")
        ids = self.bands.select("doc_id").distinct()
        self.signatures = reps.select("doc_id", "signature")
        self.keys = reps.select("doc_id", "bands")
        texts = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL")
        self.texts = staged(texts.join(ids, "doc_id"), "texts")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that pass the estimate and then the test on full sets."""
        pairs = pairs.distinct()
        for side in ("a", "b"):
            named = self.signatures.select(
                F.col("doc_id").alias(side), F.col("signature").alias(f"sig_{side}")
            )
            pairs = pairs.join(named, side)
        likely = pairs.where(estimate("sig_a", "sig_b") >= lowest_estimate(self.percent))
        likely = staged(likely.select("a", "b"), "likely")
        for side in ("b", "a"):
            named = self.texts.select(
                F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")
            )
            likely = likely.join(named, side)
        found = mapped(likely, _agreeing(self.words, self.percent), "a bigint, b bigint")
        return staged(found, "links")

    def unsettled(self, known: DataFrame) -> DataFrame:
        """Rows of bands that hold several components, with the band's largest one as home."""
        placed = self.bands.where("n > 2").join(
            known.withColumnRenamed("id", "doc_id"), "doc_id", "left"
        ).select("band", "centre", "doc_id", F.coalesce("component", "doc_id").alias("part"))
        homes = (
            placed.groupBy("band", "part")
            .agg(F.count("*").alias("size"))
            .groupBy("band")
            .agg(F.max(F.struct("size", "part")).alias("home"), F.count("*").alias("parts"))
            .where("parts > 1")
            .select("band", F.col("home.part").alias("home"))
        )
        return staged(placed.join(homes, "band"), "unsettled")


    def shared(self, open_rows: DataFrame) -> DataFrame:
        """(home, doc_id, size, shared, shingles) of ``open_rows``, once for each text of an id.

        ``shared`` counts the shingles that some other row of the same home has too.
        """
        homes = open_rows.groupBy("doc_id").agg(F.collect_set("home").alias("homes"))
        words = self.words

        def rows(batch: pa.RecordBatch):
            sets = [shingle_set(text, words) for text in text_bytes(batch["text"])]
            yield {
                "doc_id": batch["doc_id"],
                "homes": batch["homes"],
                "size": [len(own) for own in sets],
                "key": [int(as_signed(own.sum(keepdims=True))[0]) for own in sets],
                "shingles": [as_signed(own) for own in sets],
            }

        schema = "doc_id bigint, homes array<bigint>, size bigint, key bigint"
        sets = staged(
            mapped(
                self.texts.join(homes, "doc_id").select("doc_id", "text", "homes"),
                rows,
                f"{schema}, shingles array<bigint>",
            ).select(F.explode("homes").alias("home"), "doc_id", "key", "size", "shingles"),
            "open-sets",
        )
        alone = (
            sets.select("home", "doc_id", "key", F.explode("shingles").alias("shingle"))
            .groupBy("home", "shingle")
            .agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.count("*").alias("n"))
            .where("n = 1")
            .groupBy("home", "doc_id", "key")
            .agg(F.count("*").alias("alone"))
        )
        return (
            sets.join(alone, ["home", "doc_id", "key"], "left")
            .select(
                "home", "doc_id", "size",
                (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"),
                "shingles",
            )
        )

    def _enough(self, common: Column, sizes: Column) -> Column:
        """n and m shingles with k in common: 100 k >= percent (n + m - k)."""
        return common * (100 + self.percent) >= sizes * self.percent

    def _allowed(self) -> Column:
        return self._enough(F.least("shared_x", "shared_y"), F.col("size_x") + F.col("size_y"))

    def near_home(self, open_rows: DataFrame, shared: DataFrame) -> DataFrame:
        """Pairs (x, y) of rows outside a home with up to ``PIVOTS`` rows y of that home.

        Half of them are those with the fewest shingles of their own, half are picked by a hash. The
        same rows lie in many bands; each needs a home's pivots only once.
        """
        inside = shared.join(
            open_rows.where("part = home").select("home", "doc_id").distinct(), ["home", "doc_id"]
        )
        pivots = None
        for first in (F.desc(F.col("shared") / F.col("size")), F.xxhash64("doc_id")):
            order = [first, "doc_id"]
            place = F.row_number().over(Window.partitionBy("home").orderBy(*order))
            taken = inside.withColumn("place", place).where(F.col("place") <= PIVOTS // 2)
            pivots = taken if pivots is None else pivots.union(taken)
        pivots = pivots.select(
            "home", F.col("doc_id").alias("y"), F.col("size").alias("size_y"),
            F.col("shared").alias("shared_y"),
        ).distinct()
        outside = open_rows.where("part <> home").select("home", "doc_id").distinct()
        return (
            outside.join(shared, ["home", "doc_id"])
            .select(
                "home", F.col("doc_id").alias("x"), F.col("size").alias("size_x"),
                F.col("shared").alias("shared_x"),
            )
            .join(pivots, "home")
            .where(self._allowed())
        )

    def possible(self, open_rows: DataFrame, shared: DataFrame) -> DataFrame:
        """Links (a, b) of rows outside a home with rows of other components of its bands.

        Each block of a home's outside rows meets each block of all its rows. Whatever sizes and
        shared shingles rule out is left out before; of the links of two blocks those are returned
        that their components need.
        """
        size, rows = F.col("size"), F.count("*")
        least = F.ceil(size * self.percent / 100)
        able = staged(
            open_rows.select("home", "doc_id", "part")
            .distinct()
            .join(shared.where(self._enough(F.col("shared"), size + least)), ["home", "doc_id"])
            .join(self.keys, "doc_id"),
            "able",
        )

        def blocks(number: Column, shingles: Column) -> Column:
            return F.ceil(F.greatest(number / BLOCK_ROWS, shingles / BLOCK_SHINGLES)).cast("int")

        out = F.col("part") != F.col("home")
        counts = able.groupBy("home").agg(
            blocks(F.count_if(out), F.sum(F.when(out, size))).alias("n_x"),
            blocks(rows, F.sum("size")).alias("n_y"),
        )
        dealt = able.join(counts.where("n_x > 0"), "home")
        own = F.xxhash64("doc_id", "size")
        others = {
            True: {"x": F.pmod(own, "n_x").cast("int"), "y": F.explode(F.expr("sequence(0, n_y - 1)"))},
            False: {"y": F.pmod(own, "n_y").cast("int"), "x": F.explode(F.expr("sequence(0, n_x - 1)"))},
        }
        sides = [
            (dealt.where(out) if outside else dealt)
            .withColumns(placed)
            .select(
                "home", "x", "y", F.lit(outside).alias("outside"),
                "doc_id", "part", "size", "shared", "bands", "shingles",
            )
            for outside, placed in others.items()
        ]
        found = sides[0].union(sides[1]).groupBy("home", "x", "y")
        return staged(found.applyInArrow(_block_links(self.percent), "a bigint, b bigint"), "links")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicate_groups(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links of at least ``percent`` per cent
    similarity; ``kept`` marks the row with that id.
    """
    rows = staged(signatures(docs, words), "signatures")
    # One representative for every distinct set.
    by_set = staged(
        rows.where("set_a IS NOT NULL")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min(F.struct("doc_id", "bands", "signature")).alias("rep")),
        "sets-once",
    )
    search = _Candidates(docs, by_set.select("rep.*"), words, percent)
    # First every row with its band's centre.
    links = search.linked(
        search.bands.where("centre < doc_id").select(
            F.col("centre").alias("a"), F.col("doc_id").alias("b")
        )
    )
    groups = components(links, "components")
    # Then the rows outside a band's largest component: with a few rows of that component, which
    # settles almost all of a large group, and at last with every row of another component.
    for last in (False, True):
        open_rows = search.unsettled(groups)
        if not open_rows.limit(1).count():
            break
        shared = staged(search.shared(open_rows), "shared")
        if last:
            more = search.possible(open_rows, shared)
        else:
            pairs = search.near_home(open_rows, shared.drop("shingles"))
            more = search.linked(pairs.select(*_ordered("x", "y")))
        links = links.union(more)
        groups = components(links, "components")
    reached = by_set.select(
        "set_a", "set_b", "n_shingles", F.col("rep.doc_id").alias("id")
    ).join(groups, "id", "left")
    found = rows.join(
        reached.select("set_a", "set_b", "n_shingles", F.coalesce("component", "id").alias("group")),
        ["set_a", "set_b", "n_shingles"],
        "left",
    ).select("doc_id", "n_shingles", F.coalesce("group", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)))


def one_per_group(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those that another document of their group represents."""
    gone = near_duplicate_groups(docs, words, percent).where("NOT kept")
    # Written first: its size is then known when the join with the texts is planned.
    (name,) = unused(docs.columns, 1)
    gone = staged(gone.select(F.col("doc_id").alias(name)).distinct(), "gone")
    return docs.join(gone, gone[name] == docs["doc_id"].cast("bigint"), "left_anti")

"""What the seed join of the decontamination carries, and its results by brute force."""

import random

from sluice.llm import contamination


def prose(pick, count, vocabulary):
    return [f"w{pick.randrange(vocabulary)}" for _ in range(count)]


def covered(text, item):
    """First and last word of the windows that agree, from the definition."""
    size = min(13, len(item))
    least = 11 if len(item) >= 13 else size
    found = [
        a
        for a in range(len(text) - size + 1)
        if size >= 6
        and any(
            sum(x == y for x, y in zip(text[a : a + size], item[s : s + size])) >= least
            for s in range(len(item) - size + 1)
        )
    ]
    return (found[0], found[-1] + size - 1) if found else None


def test_pieces_slices_and_shuffles_find_the_same(spark, monkeypatch):
    pick = random.Random(7)
    items = [prose(pick, n, 50) for n in (3, 6, 9, 12, 13, 14, 20, 33, 61)]
    items += [items[4], items[8][:40], ["a"] * 15]
    texts = []
    for n in range(60):
        text = prose(pick, pick.randrange(0, 70), 50)
        for item in pick.sample(items, 2):
            start = pick.randrange(len(item))
            planted = [w if pick.random() < 0.95 else "other" for w in item[start:] if start < 20]
            at = pick.randrange(len(text) + 1)
            text[at:at] = planted
        texts.append(text)
    texts += [["a"] * n for n in (6, 12, 13, 40)] + [texts[0], texts[1]]
    ids = [*range(len(items) - 1), None]
    expected = set()
    for doc, text in enumerate(texts):
        found = {n: at for n, item in zip(ids, items) if (at := covered(text, item))}
        listed = ",".join(str(n) for n in sorted(n for n in found if n is not None))
        ends = (min(a for a, _ in found.values()), max(b for _, b in found.values())) if found else (None, None)
        expected.add((doc, bool(found), listed, *ends))
    assert 20 < sum(e[1] for e in expected) < 50
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id bigint, text string")
    docs = docs.union(docs.where("doc_id < 5"))
    benchmark = spark.createDataFrame([(n, " ".join(t)) for n, t in zip(ids, items)], "item_id bigint, text string")
    for text_piece, item_piece, most, slices in ((1024, 256, 500_000, 4), (3, 2, 100, 99), (5, 7, 0, 4)):
        monkeypatch.setattr(contamination, "TEXT_PIECE", text_piece)
        monkeypatch.setattr(contamination, "ITEM_PIECE", item_piece)
        monkeypatch.setattr(contamination, "BROADCAST_SEEDS", most)
        monkeypatch.setattr(contamination, "SLICES", slices)
        rows = contamination.contamination(docs, benchmark).collect()
        assert len(rows) == docs.count()
        assert {(r.doc_id, r.contaminated, r["items"], r.first_word, r.last_word) for r in rows} == expected
        left = {r.doc_id for r in contamination.without_contaminated(docs, benchmark).collect()}
        assert left == {e[0] for e in expected if not e[1]}


def test_seeds_and_positions_travel_without_words(spark, monkeypatch):
    kinds, counts = {}, {}

    def noted(frame, label, free=False):
        written = staged(frame, label, free)
        kinds[label], counts[label] = [t for _, t in frame.dtypes], written.count()
        return written

    staged = contamination.staged
    monkeypatch.setattr(contamination, "staged", noted)
    item = " ".join(prose(random.Random(1), 40, 400))
    docs = spark.createDataFrame([(0, f"x {item} y"), (1, "no words of it")], "doc_id bigint, text string")
    for most in (500_000, 0):
        monkeypatch.setattr(contamination, "BROADCAST_SEEDS", most)
        for copies in (1, 5):
            benchmark = spark.range(copies).selectExpr("id AS item_id", f"'{item}' AS text")
            found = contamination.contamination(docs, benchmark).collect()
            assert {(r.doc_id, r.n_items, r.first_word, r.last_word) for r in found} == {
                (0, copies, 1, 40),
                (1, 0, None, None),
            }
            # Every seed had the words of its item, once for each copy of the item; without a
            # broadcast every position of a text had the text's words.
            assert counts["seeds"] == 35 + 30
            assert not any("array" in kind for kind in kinds["seeds"])
        assert ("hits" in kinds) == (most == 0)
    assert not any("array" in kind for kind in kinds["hits"])


def test_texts_stay_where_they_are_for_few_contaminated_ones(spark, monkeypatch):
    item = " ".join(prose(random.Random(1), 40, 400))
    docs = spark.createDataFrame([(0, item), (None, item), (2, "no words of it")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(0, item)], "item_id bigint, text string")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        # As if the keys were more than Spark broadcasts by itself.
        spark.conf.set(name, "-1")
        for most, moved in ((500_000, False), (0, True)):
            monkeypatch.setattr(contamination, "BROADCAST_SEEDS", most)
            left = contamination.without_contaminated(docs, benchmark)
            plan = left._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) == moved
            assert [r.doc_id for r in left.collect()] == [2]
    finally:
        spark.conf.set(name, before)

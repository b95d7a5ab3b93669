"""The pipeline's stages against brute force on a small corpus, and as a whole."""

import itertools
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from sluice.session import scratch_path

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key int, start int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, count):
    pick = random.Random(seed)
    return " ".join(f"word{pick.randrange(3000)}" for _ in range(count))


def edited(text, every):
    parts = text.split()
    return " ".join(p + "x" if n % every == every // 2 else p for n, p in enumerate(parts))


@pytest.fixture(scope="module")
def texts():
    passage = prose(1, 80)
    long = prose(2, 300)
    return {
        None: "nobody owns this text " + prose(3, 20),
        1: None,
        2: "",
        3: " \n\t",
        10: long,
        11: long,
        12: long.upper(),
        13: edited(long, 150),
        14: edited(long, 20),
        20: prose(4, 40) + " " + passage + " " + prose(5, 40),
        21: prose(6, 60) + "\n" + passage + "\n" + prose(7, 10),
        22: passage,
        23: prose(8, 49),
        24: prose(8, 49) + " end",
        30: "one",
        31: "one",
        40: prose(9, 20_000),
        41: "w" * 50_000,
    }


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(n, t, "en", "web", None if t is None else len(t), 1, 1) for n, t in texts.items()]
    return spark.createDataFrame([*rows, rows[5]], DOCS).repartition(3).cache()


def test_one_document_of_each_group_stays(spark, docs, texts):
    sets = {}
    for doc, text in texts.items():
        parts = words((text or "").lower())
        runs = [tuple(parts[n : n + 5]) for n in range(len(parts) - 4)] or [tuple(parts)] * bool(parts)
        sets[doc] = set(runs)
    label = {doc: doc for doc in texts}
    linked = [
        (a, b)
        for a, b in itertools.combinations([d for d in texts if d is not None], 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    for _ in texts:
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    kept = pipeline.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    found = [r["doc_id"] for r in kept.collect()]
    assert set(found) == {d for d in texts if d == label[d]}
    assert {11, 12, 13, 24} & set(found) == set() and 14 in found


def test_repeated_passages_go_and_their_lengths_change(spark, docs, texts):
    kept = pipeline.repeated_passages(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    owned = [d for d in texts if d is not None]
    first = {}
    for doc in sorted(owned):
        parts = words(texts[doc])
        for n in range(len(parts) - 49):
            first.setdefault(tuple(parts[n : n + 50]), doc)
    for doc in owned:
        parts, gone = words(texts[doc]), set()
        for n in range(len(parts) - 49):
            if first[tuple(parts[n : n + 50])] < doc:
                gone |= set(range(n, n + 50))
        left = [p for n, p in enumerate(parts) if n not in gone]
        assert words(rows[doc]["text"]) == left, doc
        if gone:
            assert rows[doc]["n_chars"] == len(rows[doc]["text"])
        else:
            assert rows[doc]["text"] == texts[doc]
    assert rows[None]["text"] == texts[None]


def test_documents_with_benchmark_passages_go(spark):
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    item = max(items, key=lambda t: len(words(t)))
    assert len(words(item)) >= 13
    changed = " ".join(w + "q" if n % 7 == 3 else w for n, w in enumerate(words(item)))
    plain = [(1, prose(1, 300)), (2, None), (3, ""), (4, " ".join(words(item)[:5]))]
    leaked = [(5, f"{prose(2, 50)} {item} {prose(3, 50)}"), (6, item.upper()), (7, f"{prose(4, 9)} {changed}")]
    rows = [(n, t, "en", "web", 1, 1, 1) for n, t in plain + leaked]
    kept = pipeline.decontaminated(spark, spark.createDataFrame(rows, DOCS), SF_DIR)
    assert kept.columns == DOCS.replace(",", "").split()[::2]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4]


def test_texts_are_encoded_as_a_whole(spark, docs, texts):
    # The lattice of one word of 50,000 characters does not fit into the memory of a test session.
    shorter = "CASE WHEN doc_id = 41 THEN left(text, 2000) ELSE text END"
    texts = {**texts, 41: texts[41][:2000]}
    rows = pipeline.encoded(spark, docs.withColumn("text", F.expr(shorter)), SF_DIR).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted([*map(str, texts), str([*texts][5])])
    for row in rows:
        assert row["n_tokens"] == len(row["ids"] or [])
        text = texts[row["doc_id"]]
        if text:
            assert row["n_tokens"] > 0 and row["round_trip"]


def test_empty_corpus(spark):
    none = spark.createDataFrame([], DOCS)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, SF_DIR).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not mounted")
def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    at, kept = docs, []
    for name, stage in pipeline.STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, at, SF_DIR).write.parquet(path)
        at = spark.read.parquet(path)
        assert at.columns == docs.columns, name
        kept.append({r["doc_id"] for r in at.select("doc_id").collect()})
    for before, after in zip(kept, kept[1:]):
        assert after <= before
    found = pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in found.select("doc_id").collect()} == kept[-1]
    # Most documents are clean prose and stay.
    assert len(kept[-1]) > 0.6 * docs.count()

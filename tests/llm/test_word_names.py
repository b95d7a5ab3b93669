"""Words and runs of words that polynomial hashes would take for each other."""

import numpy as np
import pytest

from sluice.llm import minhash, scoring, substrings
from sluice.llm.common import run_hashes, spans_hash, word_hashes


def thue_morse(length):
    text = "a"
    while len(text) < length:
        text += text.translate(str.maketrans("ab", "ba"))
    return text, text.translate(str.maketrans("ab", "ba"))


ONE, OTHER = thue_morse(1024)


def test_words_and_runs_have_names_of_their_own():
    found = word_hashes(f"{ONE} {OTHER} {ONE} {'x' * 5000} {'x' * 5001} {'x' * 5000}".encode())
    assert found[0] == found[2] != found[1] and found[3] == found[5] != found[4]
    first, second = (word_hashes(" ".join(t).encode()) for t in thue_morse(4096))
    for length in (1, 2, 50, 1024, 4096):
        runs, others = run_hashes(first, length), run_hashes(second, length)
        assert len(runs) == 4096 - length + 1
        named = {}
        for text, hashes in zip(thue_morse(4096), (runs, others)):
            for start, name in enumerate(hashes.tolist()):
                assert named.setdefault(text[start : start + length], name) == name
        assert len(set(named.values())) == len(named)
    starts, lengths = np.array([0, 5, 7, 100]), np.array([1, 50, 1024, 3])
    spans = spans_hash(first, starts, starts + lengths)
    for start, length, name in zip(starts, lengths, spans):
        assert run_hashes(first, int(length))[start] == name


@pytest.mark.parametrize("length", range(1, 20))
def test_every_byte_of_a_word_counts(length):
    words = {b"a" * length}
    for place in range(length):
        words.add(b"a" * place + b"b" + b"a" * (length - place - 1))
    words |= {b"a" * n for n in range(1, 25)}
    names = word_hashes(b" ".join(sorted(words))).tolist()
    assert len(set(names)) == len(words)


def docs(spark, texts):
    rows = [(n, t, "en", 1, 1) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, _own0 int, _gone int")


def test_no_passage_is_cut_for_another(spark):
    before, after = " ".join(f"p{n}" for n in range(29)), " ".join(f"q{n}" for n in range(30))
    frame = docs(spark, [f"{before} {ONE} {after}", f"{before} {OTHER} {after}"])
    found = substrings.without_repeats(frame, width=50)
    assert [r["n_removed"] for r in found.orderBy("doc_id").collect()] == [0, 0]
    assert {"_own0", "_gone"} < set(found.columns)
    long = [" ".join(t) for t in thue_morse(1024)]
    runs = substrings.repeated_windows(docs(spark, [f"{before} {t} {after}" for t in long]), width=1024)
    assert runs.collect() == []


def test_documents_of_different_words_do_not_link(spark):
    found = minhash.near_duplicate_groups(docs(spark, [ONE, OTHER, ONE]), words=2)
    assert [r["component_id"] for r in found.orderBy("doc_id").collect()] == [0, 1, 0]
    kept = minhash.one_per_group(docs(spark, [ONE, OTHER, ONE]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1] and "_gone" in kept.columns


def test_unseen_words_are_unknown(spark):
    import zlib

    def held_out(n):
        return zlib.crc32(str(n).encode()) % 7 == 2

    ids = range(40)
    rows = [(n, OTHER if held_out(n) else ONE) for n in ids]
    found = scoring.language_scores(spark.createDataFrame(rows, "doc_id bigint, text string"))
    known = {r["doc_id"]: r["n_known"] for r in found.collect()}
    assert known == {n: 1 if held_out(n) else 2 for n in ids}

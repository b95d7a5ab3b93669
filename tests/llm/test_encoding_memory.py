"""What travels between the steps of the encoding."""

import re

from sluice.llm import encoding
from sluice.llm.pieces import SPACE, load_pieces


def test_ids_of_words_travel_as_bytes(spark, monkeypatch):
    kinds, freed = {}, {}

    def noted(frame, label, free=False):
        kinds[label], freed[label] = dict(frame.dtypes), free
        return staged(frame, label, free)

    staged = encoding.staged
    monkeypatch.setattr(encoding, "staged", noted)
    texts = [(0, "some words and some more"), (1, ""), (2, None), (3, "日本 語 x\n"), (4, "some words")]
    texts += [(n, f"rare{n} words {n} of {n % 3}") for n in range(5, 40)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2)
    pieces = load_pieces().bytes_of()
    for frequent in (1000, 2):
        found = encoding.encode_texts(frame, frequent=frequent).collect()
        assert {r.doc_id: r.text for r in found} == dict(texts)
        for r in found:
            assert (r.ids is None) == (r.text is None) and r.exact and r.round_trip
            spelled = b"".join(pieces[i] for i in r.ids or ()).decode()
            assert re.sub(f"^{SPACE}|^ ", "", spelled) == (r.text or "")
    # Lists of ids became objects by the thousand in tasks; shuffle files of finished steps stayed.
    assert kinds["encoded-words"]["ids"] == "binary" and all(freed.values())

"""URL filters, hard negatives and the conversation trie on awkward rows, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import negatives, prefixes, urls

# -- URL filters ---------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, host int, address int, token int, rule int"
LONG = "http://a.org/" + "/".join(f"seg{i}" for i in range(30_000)) + "/login"
URLS = [
    None,
    "",
    "no scheme example.com/en/x",
    "://",
    "http://",
    "HTTP://WWW.Example.COM/en/x",
    "http://example.com/en/",
    "http://example.com/EN/x",
    "http://example.com/en",
    "http://notexample.com/en/x",
    "http://a.b.example.com/en/x?q=1#f",
    "http://example.com:8080/en/x",
    "http://user@example.com/en/x",
    "http://foo?x.com/en/",
    "http://foo#x.com/en/",
    "https://x.net/es/1",
    "https://x.net/de/1",
    "https://x.net/fr/1\n",
    "https://m.x.org/fr/a.html",
    "https://m.x.org/fr/a.html\n",
    "https://blog.x.org/de/1?utm_source=feed",
    "https://blog.x.org/de/1",
    "https://ads.x.org/",
    "https://Kads.x.org/",
    "https://x.org/a?page=2&ref=x",
    "https://x.org/a?page=2",
    "https://x.org/a?xpage=2",
    "https://x.org/LOGIN",
    "https://x.org/login.html",
    "https://x.org/Viagra-now",
    "https://x.org/a?b=http://example.com/en/",
    LONG,
]


def page_rows():
    return [(i, u, "<p>", 1, 1, 1, 1) for i, u in enumerate(URLS)] + [
        (None, "https://x.org/login", None, 1, 1, 1, 1),
        (7, URLS[7], "again", 1, 1, 1, 1),
    ]


def split(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1].split("#", 1)[0]
    host = re.match("[^/?]*", rest)[0]
    tail = rest[len(host) :]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    return host, tail.split("?", 1)[0], host + tail


def fits(pattern, any_case, address):
    """The meaning of a pattern, by another spelling of it as a regular expression."""
    body, head, foot = pattern, "", ""
    if body.startswith("||"):
        body, head = body[2:], r"^(?:[^/?]*\.)?"
    elif body.startswith("|"):
        body, head = body[1:], "^"
    if body.endswith("|"):
        body, foot = body[:-1], r"\Z"
    body = body if head else body.lstrip("*")
    body = body if foot else body.rstrip("*")
    spelled = "".join(
        ".*" if c == "*" else r"(?:[^0-9A-Za-z_.%\-]|\Z)" if c == "^" else re.escape(c) for c in body
    )
    flags = re.S | re.A | (re.I if any_case else 0)
    return re.search(head + spelled + foot, address, flags) is not None


def winner(rules, address):
    found = [r for r in rules if address is not None and fits(r[0], r[3], address)]
    return min(found, key=lambda r: (-r[2], -len(r[0]), r[0], r[1]), default=None)


def test_site_verdicts(spark):
    rules = [("||" + r, v, 2, False) for r, v in urls.SITE_RULES]
    rules += [(p, v, 1, True) for p, v in urls.PAGE_RULES]
    expected = []
    for page_id, url, *_ in page_rows():
        host, path, address = split(url)
        won = winner(rules, address)
        rule = won[0][2:] if won and won[2] == 2 else None
        pattern = won and won[0]
        expected.append((page_id, host, path, rule, won[1] if won else "allow", pattern))
    found = urls.site_verdicts(spark.createDataFrame(page_rows(), PAGES).repartition(3))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    by_url = dict(zip(URLS, expected))
    assert by_url["HTTP://WWW.Example.COM/en/x"][3:5] == ("www.example.com/en/", "allow")
    assert by_url["http://example.com/EN/x"][3] == "com/"
    assert by_url["http://foo?x.com/en/"][3] is None
    assert by_url[LONG][4] == "block"


@pytest.mark.parametrize("broadcast_bytes", [0, urls.BROADCAST_BYTES])
def test_random_rules(spark, broadcast_bytes):
    pick = random.Random(7)
    parts = ["ab", "b", "ab1", "*", "^", "/", ".", "=", "?", "Ab", "(", "+", "[", "$", "\\", "é", "-"]
    rules = []
    for _ in range(60):
        body = "".join(pick.choice(parts) for _ in range(pick.randint(1, 5)))
        pattern = pick.choice(["", "", "|", "||"]) + body + pick.choice(["", "", "|"])
        rules.append((pattern, pick.choice(["allow", "block"]), pick.randint(0, 2), pick.random() < 0.5))
    rules += rules[:3]
    marks = [p for p in parts if p not in "*^"]
    texts = ["http://" + "".join(pick.choice(marks) for _ in range(pick.randint(0, 9))) for _ in range(150)]
    pages = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "page_id bigint, url string")
    nothing = [(None, "block", 9, False), ("ab", None, 9, False)]
    table = spark.createDataFrame(rules + nothing, "pattern string, verdict string, tier int, any_case boolean")
    found = urls.judge_urls(pages, table, ["page_id"], broadcast_bytes=broadcast_bytes)
    got = {r.page_id: (r.pattern, r.tier, r.verdict) for r in found.collect()}
    for i, text in enumerate(texts):
        won = winner(rules, split(text)[2])
        assert got[i] == ((won[0], won[2], won[1]) if won else (None, None, "allow")), text


def test_rules_are_listed_by_their_rarest_token(spark):
    rules = spark.createDataFrame(
        [("||www.example.com/en/", "allow", 1, False), ("*open*", "block", 1, False), ("/a1^b", "block", 1, False)],
        "pattern string, verdict string, tier int, any_case boolean",
    )
    addresses = spark.createDataFrame(
        [("www.example.com/",), ("www.example.org/en/",), ("example.com/en/",)], "address string"
    )
    listed = urls._indexed(urls._compiled(rules), addresses)
    got = {r.rule.pattern: r.token for r in listed.collect()}
    # www, example, com and en are in 2, 3, 2 and 2 addresses; 'open' is no whole token, 'b' neither.
    assert got == {"||www.example.com/en/": "com", "*open*": "", "/a1^b": "a1"}


def test_no_urls_and_no_python(spark):
    assert urls.site_verdicts(spark.createDataFrame([], PAGES)).collect() == []
    found = urls.site_verdicts(spark.range(3).selectExpr("id AS page_id", "'http://a.net/fr/' AS url"))
    assert {r.rule for r in found.collect()} == {"net/fr/"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|ExistingRDD", plan)


# -- hard negatives ------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, v int, a int, n int"


def vector_rows(count, dims, seed, spread=1.0):
    pick = random.Random(seed)
    rows = []
    for i in range(count):
        base = [1.0 if d == i % 3 else 0.2 for d in range(dims)]
        vector = [x * spread + pick.uniform(-0.6, 0.6) * spread for x in base]
        rows.append((i, vector, pick.choice([0, 0, 0, 1, 2, 9]), 1, 1, 1))
    return rows


def negatives_of(rows):
    usable = {}
    for vec_id, vector, label, *_ in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * x) for x in vector]
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label, q)
        usable[vec_id] = min(row, usable.get(vec_id, row))
    found = set()
    for anchor, (label, q) in usable.items():
        if anchor % 50:
            continue
        scores = [
            (-sum(x * y for x, y in zip(q, other)), i, other_label == label)
            for i, (other_label, other) in usable.items()
            if i != anchor and len(other) == len(q)
        ]
        ranked = [(-s, i, same) for s, i, same in sorted(scores)]
        for p, positive, _ in [x for x in ranked if x[2]][:5]:
            window = [(s, i) for s, i, same in ranked if not same and 50 * p <= 100 * s <= 95 * p]
            for rank, (s, i) in enumerate(window[:3], 1):
                found.add((anchor, positive, rank, i, p, s))
    return found


@pytest.mark.parametrize("dims, spread", [(20, 1.0), (3, 1.0), (20, 1e12), (1, 0.01)])
def test_hard_negatives(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(negatives, "ROWS", 64)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 3)
    rows = vector_rows(420, dims, dims, spread)
    found = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(3))
    got = [tuple(r) for r in found.collect()]
    low, high = -(1 << 63), (1 << 63) - 1
    expected = {tuple(min(max(x, low), high) for x in row) for row in negatives_of(rows)}
    assert len(got) == len(set(got)) and set(got) == expected and expected


def test_hard_negatives_of_awkward_rows(spark):
    rows = vector_rows(120, 4, 3)
    rows += [
        (None, [1.0] * 4, 0, 1, 1, 1),
        (500, None, 0, 1, 1, 1),
        (501, [1.0, None, 1.0, 1.0], 0, 1, 1, 1),
        (502, [1.0, float("nan"), 1.0, 1.0], 0, 1, 1, 1),
        (503, [float("inf"), 1.0, 1.0, 1.0], 0, 1, 1, 1),
        (504, [1.0] * 4, None, 1, 1, 1),
        (550, [1.0, 2.0], 0, 1, 1, 1),
        (551, [1.0, 2.0], 0, 1, 1, 1),
        (552, [1.0, 1.2], 1, 1, 1, 1),
        (600, [], 3, 1, 1, 1),
        (601, [], 3, 1, 1, 1),
        (603, [], 4, 1, 1, 1),
        (650, [0.0] * 4, 2, 1, 1, 1),
        (-50, [0.5] * 4, 0, 1, 1, 1),
        (-49, [-0.5] * 4, 0, 1, 1, 1),
    ]
    rows += [rows[0], rows[50], (50, [3.0] * 4, 1, 1, 1, 1)]
    # Ties: the same vector under many ids.
    rows += [(i, [0.9, 0.3, 0.1, 0.2], i % 4, 1, 1, 1) for i in range(700, 730)]
    found = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(4))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == negatives_of(rows)
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty).collect() == []


def test_the_scan_drops_candidates_early():
    import numpy as np
    import pyarrow as pa

    pick = np.random.default_rng(1)
    vectors = np.floor(256 * pick.normal(0, 0.1, (500, 64)))
    vectors[:20, :8] += 400
    table = pa.table({"vec_id": range(500), "label": [0] * 500, "v": vectors.tolist()})
    block, sizes = negatives.Block(table), []
    stays = negatives._reaches(5)

    def counted(least, most):
        sizes.append(len(least))
        return stays(least, most)

    kept, scores = block.scan(vectors[0], np.arange(500), counted)
    assert sizes[0] == 500 and sizes[-1] < 100
    exact = vectors @ vectors[0]
    assert (exact[kept] == scores).all() and set(np.argsort(-exact)[:5]) <= set(kept)


# -- conversation trie ---------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, seq int, n int, ends int"


def nodes_of(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, tid, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, seq in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        rebuilt[c] = turns.get(base, [])[:h] + seq[h:]
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved, found = {}, {}, set()
    for key in sorted(members, key=len, reverse=True):
        convs = members[key]
        leaves[key] = sum(leaves[k] for k in children[key]) or 1
        own_saved = (len(convs) - 1) * len(key[-1][1]) if key else 0
        saved[key] = own_saved + sum(saved[k] for k in children[key])
        ends = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(key))
        found.add(
            (
                convs[0],
                len(key),
                members[key[:-1]][0] if key else None,
                len(convs),
                len(children[key]),
                leaves[key],
                saved[key],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return found


def conversation_rows(seed, count, longest, vocabulary):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(-120, 900), count):
        for turn in range(pick.randint(1, longest)):
            said = "x" * pick.randint(0, vocabulary - 1) + pick.choice(["", "é"])
            rows.append((c, turn, pick.choice(["user", "assistant"]), said, 1, 1, 1, 1))
    pick.shuffle(rows)
    return rows


def trie(spark, rows, limit):
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    got = [tuple(r) for r in prefixes.conversation_trie(frame, limit).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("limit", [1, 3, 64])
def test_conversation_trie(spark, limit):
    rows = conversation_rows(limit, 150, 9, 2)
    # One very common conversation, one very common start, and a conversation that is the start of others.
    for c in range(2000, 2060):
        rows += [(c, t, "user", f"same {t}", 1, 1, 1, 1) for t in range(7)]
    for c in range(3000, 3040):
        rows += [(c, t, "user", f"same {t}", 1, 1, 1, 1) for t in range(7 + c % 3)]
        rows += [(c, 50, "user", f"own {c % 11}", 1, 1, 1, 1)]
    assert trie(spark, rows, limit) == nodes_of(rows)


@pytest.mark.parametrize("limit", [1, 64])
def test_awkward_conversations(spark, limit):
    rows = [
        (None, 0, "user", "nobody", 1, 1, 1, 1),
        (0, None, None, None, 1, 1, 1, 1),
        (0, 3, "user", "later", 1, 1, 1, 1),
        (0, None, "user", "first", 1, 1, 1, 1),
        (1, 0, "user", "", 1, 1, 1, 1),
        (1, 0, "user", "", 1, 1, 1, 1),
        (2, 0, "us", "er:", 1, 1, 1, 1),
        (3, 0, "use", "r:", 1, 1, 1, 1),
        (4, 5, "user", "tie b", 1, 1, 1, 1),
        (4, 5, "user", "tie a", 1, 1, 1, 1),
        (205, 0, "user", "no base", 1, 1, 1, 1),
        (-7, 0, "user", "\U0001f600é", 1, 1, 1, 1),
        (-100, 0, "user", "below zero", 1, 1, 1, 1),
        (-150, 0, "user", "x" * 200_000, 1, 1, 1, 1),
        (-151, 0, "user", "x" * 200_000, 1, 1, 1, 1),
    ]
    rows += [(c, 0, "user", "one turn", 1, 1, 1, 1) for c in range(300, 330)]
    # Long conversations with one long start.
    rows += [
        (c, t, "user", f"{t if t < 700 + c else -c}", 1, 1, 1, 1) for c in (901, 902, 903) for t in range(1000)
    ]
    assert trie(spark, rows, limit) == nodes_of(rows)


def test_turnless_conversations(spark):
    # The base is absent and all own turns are replaced: only the root is left.
    lone = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2][:3]
    rows = [(c, 0, "user", "gone", 1, 1, 1, 1) for c in lone]
    got = trie(spark, rows, 64)
    ends = hashlib.sha256(",".join(map(str, lone)).encode()).hexdigest()
    assert got == {(lone[0], 0, None, 3, 0, 1, 0, ends)} == nodes_of(rows)
    assert prefixes.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_long_lists_of_ids_are_digested_in_chunks(spark, monkeypatch):
    rows = spark.range(0, 120_000, 2).select(
        F.col("id").alias("conv_id"),
        F.array(F.struct(F.lit(b"a" * 16).alias("tid"), F.lit(3).alias("chars"))).alias("seq"),
    )
    got = prefixes.distinct_sequences(rows.repartition(5)).drop("seq").collect()
    joined = ",".join(str(i) for i in range(0, 120_000, 2))
    assert [tuple(r) for r in got] == [(0, 60_000, hashlib.sha256(joined.encode()).hexdigest())]

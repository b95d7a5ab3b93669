"""One query per operator, with the parameters used in production."""

from __future__ import annotations

import math

from sluice.llm.common import table
from sluice.llm.contamination import contamination
from sluice.llm.encoding import encode_texts
from sluice.llm.language import identify
from sluice.llm.licenses import CONTAINMENT, PHRASES, SLACK, TEMPLATES, license_scan
from sluice.llm.minhash import near_duplicate_groups
from sluice.llm.negatives import hard_negatives
from sluice.llm.prefixes import conversation_trie
from sluice.llm.registry import register
from sluice.llm.scoring import language_scores
from sluice.llm.sharding import LIMIT, with_shards
from sluice.llm.substrings import without_repeats
from sluice.llm.token_counts import with_token_counts
from sluice.llm.urls import SITE_RULES, site_verdicts
from sluice.llm.vectors import near_duplicate_vectors

#: Components of a link table ``links(a, b)`` over ``nodes(id)``: smallest id reachable.
_REACHED = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT id, id FROM nodes),
reach AS (
  SELECT a AS id, b AS other FROM both_ways
  UNION
  SELECT r.id, w.b FROM reach r JOIN both_ways w ON r.other = w.a
),
groups AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP6 = f"""
WITH RECURSIVE toks AS (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents WHERE text IS NOT NULL
), shingled AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
      WHEN len(w) = 1 THEN [w[1]]
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM toks)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
nodes AS (SELECT doc_id AS id FROM documents),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n
    FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id) p
  JOIN sizes sx ON sx.doc_id = p.a JOIN sizes sy ON sy.doc_id = p.b
  WHERE 100 * both_n >= 80 * (sx.n + sy.n - both_n)
), {_REACHED}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, g.component_id, d.doc_id = g.component_id AS kept
FROM documents d JOIN groups g ON g.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
register(
    "op6_minhash_near_dedup",
    lambda s, d: near_duplicate_groups(table(s, d, "documents"), words=2, percent=80),
    OP6,
)

OP3 = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98
), nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (SELECT a, b FROM pairs WHERE a < b), {_REACHED},
counted AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, g.component_id, e.vec_id = g.component_id AS kept
FROM embeddings e JOIN groups g ON g.id = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
"""
register(
    "op3_vector_range_join",
    lambda s, d: near_duplicate_vectors(table(s, d, "embeddings"), cosine=0.98),
    OP3,
)

OP2 = f"""
WITH toks AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[]
    ELSE {_WORDS.format("text")} END AS w FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM toks WHERE len(w) >= 50)
), first_seen AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT w.doc_id, unnest(range(w.s, w.s + 50)) AS p
  FROM windows w JOIN first_seen f ON f.h = w.h AND f.low < w.doc_id
), listed AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, len(t.w) AS n_words, coalesce(len(l.ps), 0) AS n_removed,
    list_filter(t.w, lambda x, i: NOT coalesce(list_contains(l.ps, i), false)) AS k
  FROM toks t LEFT JOIN listed l USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""
register(
    "op2_substring_dedup",
    lambda s, d: without_repeats(table(s, d, "documents"), width=50).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    ),
    OP2,
)

register(
    "op9_language_profiles",
    lambda s, d: identify(table(s, d, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score"
    ),
)

_PHRASE_ROWS = ", ".join(f"('{p}', '{l}', {len(p.split())})" for p, l in PHRASES.items())
_TEMPLATE_ROWS = ", ".join(
    f"({n}, '{label}', ['"
    + "', '".join(sorted(set(text.split())))
    + f"'], {math.ceil(SLACK * len(text.split()))})"
    for n, (label, text) in enumerate(TEMPLATES)
)
_PARTS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8 = f"""
WITH phrases(phrase, label, n) AS (VALUES {_PHRASE_ROWS}),
templates(id, label, t, run) AS (VALUES {_TEMPLATE_ROWS}),
lowered AS (SELECT doc_id, coalesce({_LOWER}, '') AS text FROM documents),
toks AS (SELECT doc_id, {_PARTS.format("text")} AS w FROM lowered),
places AS (
  SELECT doc_id, label, s FROM (
    SELECT doc_id, label, phrase, n, w, unnest(range(0, len(w) - n + 1)) AS s
    FROM toks JOIN phrases ON contains(array_to_string(w, ' '), phrase)
  ) p WHERE array_to_string(w[s + 1:s + n], ' ') = phrase
), based AS (
  SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
    list_sort(list(DISTINCT label)) AS base FROM places GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_distinct({_PARTS.format("line")}) AS b FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM lowered)
), able AS (
  SELECT doc_id, label, t, run, w FROM toks
  JOIN templates ON len(list_intersect(w, t)) >= ceil({CONTAINMENT} * len(t) - 1e-9)
), held AS (
  SELECT doc_id, label, len(list_intersect(b, t)) AS both_n, len(t) AS size
  FROM lines CROSS JOIN templates
  UNION ALL
  -- Notices that run over several lines: words from one of the template on.
  SELECT doc_id, label, len(list_intersect(w[s:s + run - 1], t)), len(t)
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS s FROM able) p WHERE list_contains(t, w[s])
), more AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(both_n / size) AS best FROM held
  WHERE both_n >= ceil({CONTAINMENT} * size - 1e-9) GROUP BY doc_id
)
SELECT t.doc_id, len(t.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(base, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []),
    coalesce(m.labels, [])))), ','), '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS DOUBLE) AS score
FROM toks t LEFT JOIN based USING (doc_id) LEFT JOIN more m USING (doc_id)
"""
register("op8_license_scan", lambda s, d: license_scan(table(s, d, "documents")), OP8)
register(
    "op4_token_counts",
    lambda s, d: with_token_counts(table(s, d, "documents")).select("doc_id", "n_tokens"),
)
register(
    "op5_sentencepiece",
    lambda s, d: encode_texts(table(s, d, "documents").select("doc_id", "text")).selectExpr(
        "doc_id", "CAST(coalesce(size(ids), 0) AS BIGINT) AS n_tokens", "ids", "round_trip",
        "exact",
    ),
)

_ITEM_WORDS = r"regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP7 = f"""
WITH toks AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents WHERE text IS NOT NULL),
items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
doc_words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM toks),
item_words AS (
  SELECT item_id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS j FROM items
), same AS (
  SELECT d.doc_id, t.item_id, t.n, d.i - t.j AS shift, t.j
  FROM doc_words d JOIN item_words t ON d.x = t.x WHERE t.n >= 6
), windows AS (
  SELECT doc_id, item_id, shift, j AS s, n, count(*) OVER (
    PARTITION BY doc_id, item_id, shift ORDER BY j
    RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS agree FROM same
  UNION ALL
  -- A window may begin with up to two words that differ.
  SELECT doc_id, item_id, shift, j - e AS s, n, count(*) OVER (
    PARTITION BY doc_id, item_id, shift, e ORDER BY j
    RANGE BETWEEN CURRENT ROW AND 12 - e FOLLOWING) AS agree
  FROM same, (VALUES (1), (2)) v(e)
), matched AS (
  SELECT w.doc_id, item_id, s + shift AS a, s + shift + least(13, n) - 1 AS b
  FROM windows w JOIN toks t USING (doc_id)
  WHERE s >= 0 AND s + shift >= 0 AND s + least(13, n) <= n
    AND s + shift + least(13, n) <= len(t.w)
    AND agree >= CASE WHEN n >= 13 THEN 11 ELSE n END
)
SELECT d.doc_id, count(m.item_id) > 0 AS contaminated, count(DISTINCT m.item_id) AS n_items,
  coalesce(array_to_string(list_sort(list(DISTINCT m.item_id)), ','), '') AS items,
  min(a) AS first_word, max(b) AS last_word
FROM documents d LEFT JOIN matched m USING (doc_id) GROUP BY d.doc_id
"""
register(
    "op7_spaced_seeds",
    lambda s, d: contamination(table(s, d, "documents"), table(s, d, "benchmark")),
    OP7,
)

register(
    "op10_backoff_scores",
    lambda s, d: language_scores(table(s, d, "documents")),
)

_HALF = "(CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT) >> 2)"
_KEY = "coalesce(CAST(doc_id AS VARCHAR), '')"
_KEYS = _HALF.format(f"{_KEY} || '|' || coalesce(text, '')")
OP1 = f"""
WITH hashed AS (
  SELECT doc_id, ({_HALF.format(_KEY)} << 30) | {_KEYS} AS bits,
    coalesce(strlen(text), 0) AS n_bytes FROM documents
), levels AS (SELECT *, unnest(range(0, 61)) AS level FROM hashed),
nodes AS (
  SELECT level, bits >> (60 - level) AS node, sum(n_bytes) AS total FROM levels GROUP BY ALL
), placed AS (
  SELECT doc_id, bits, n_bytes, min(level) AS depth FROM levels l
  JOIN nodes n USING (level) WHERE n.node = l.bits >> (60 - level)
    AND (total <= {LIMIT} OR level = 60) GROUP BY ALL
)
SELECT doc_id, n_bytes, substr(lpad(bin(bits), 60, '0'), 1, depth) AS shard,
  CAST(total AS BIGINT) AS shard_bytes, total > {LIMIT} AS oversized
FROM placed p JOIN nodes n ON n.level = p.depth AND n.node = p.bits >> (60 - p.depth)
"""
register(
    "op1_extendible_shards",
    lambda s, d: with_shards(
        table(s, d, "documents"), key=["doc_id"], spread=["text"], size="text"
    ).selectExpr(
        "doc_id", "CAST(coalesce(octet_length(text), 0) AS BIGINT) AS n_bytes", "shard",
        "shard_bytes", "oversized",
    ),
    OP1,
)

#: The page rules of op11 as expressions over the address, in the order in which they win.
_BREAK = r"(?:[^0-9A-Za-z_.%-]|$)"
_PAGE_SQL = [
    (rf"^(?:[^/?]*\.)?blog\..*/de/.*utm_source=feed{_BREAK}", "||blog.*/de/*utm_source=feed^", "allow"),
    (r"^(?:[^/?]*\.)?m\..*\.org/fr/.*\.html$", "||m.*.org/fr/*.html|", "block"),
    (rf"{_BREAK}replytocom=", "^replytocom=", "block"),
    (rf"{_BREAK}page=.*{_BREAK}ref=x{_BREAK}", "^page=*^ref=x^", "allow"),
    (r"^(?:[^/?]*\.)?blog\..*/de/", "||blog.*/de/", "block"),
    (r"^(?:[^/?]*\.)?tracker\.", "||tracker.*", "block"),
    (rf"{_BREAK}phpsessid=", "^phpsessid=", "block"),
    (rf"{_BREAK}sessionid=", "^sessionid=", "block"),
    (r"^(?:[^/?]*\.)?casino.*\.", "||casino*.", "block"),
    (rf"/checkout{_BREAK}", "/checkout^", "block"),
    (r"/wp-admin/", "/wp-admin/", "block"),
    (r"/cgi-bin/", "/cgi-bin/", "block"),
    (rf"{_BREAK}print=1{_BREAK}", "^print=1^", "block"),
    (rf"/signup{_BREAK}", "/signup^", "block"),
    (r"viagra", "*viagra*", "block"),
    (rf"/login{_BREAK}", "/login^", "block"),
    (r"^(?:[^/?]*\.)?ads\.", "||ads.*", "block"),
    (r"/feed/$", "/feed/|", "block"),
    (rf"{_BREAK}page=", "^page=", "block"),
    (rf"/cart{_BREAK}", "/cart^", "block"),
    (r"\.rss$", ".rss|", "block"),
    (r"\.xml$", ".xml|", "block"),
]
_SITE_ROWS = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in SITE_RULES)
_PAGE_CASE = " ".join(
    f"WHEN regexp_matches(address, '{regex}', 'si') THEN {{{{'pattern': '{p}', 'verdict': '{v}'}}}}"
    for regex, p, v in _PAGE_SQL
).replace("{{", "{").replace("}}", "}")
OP11 = f"""
WITH rules(rule, verdict) AS (VALUES {_SITE_ROWS}),
parted AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND contains(url, '://')
    THEN split_part(substr(url, instr(url, '://') + 3), '#', 1) END AS rest FROM pages
), split AS (
  SELECT page_id, rest,
    translate(regexp_extract(rest, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?]*(.*)$', 1, 's') AS tail FROM parted
), placed AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(split_part(tail, '?', 1), '') AS path,
    host || tail AS address FROM split
), sites AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM placed JOIN rules ON starts_with(path, substr(rule, instr(rule, '/')))
    AND (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
  GROUP BY page_id
), judged AS (
  SELECT p.page_id, host, path, s.rule, s.verdict AS site,
    CASE WHEN address IS NULL THEN NULL {_PAGE_CASE} END AS page
  FROM placed p LEFT JOIN sites s USING (page_id)
)
SELECT page_id, host, path, rule, coalesce(site, page.verdict, 'allow') AS verdict,
  CASE WHEN rule IS NOT NULL THEN '||' || rule ELSE page.pattern END AS pattern
FROM judged
"""
register("op11_url_filters", lambda s, d: site_verdicts(table(s, d, "pages")), OP11)

OP12 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
    CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), found AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= 3
"""
register("op12_hard_negatives", lambda s, d: hard_negatives(table(s, d, "embeddings")), OP12)

#: CRC-32 of a number's decimal digits, bit by bit.
_CRC32 = """
xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
  list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))
"""
OP13 = f"""
WITH named AS (
  SELECT conv_id, turn, sha256(length(r) || ':' || r || t) AS tid, length(t) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
    WHERE conv_id IS NOT NULL)
), own AS (
  SELECT conv_id, list({{'tid': tid, 'chars': chars}} ORDER BY turn NULLS FIRST, tid) AS seq,
    CAST({_CRC32} % 6 AS INT) AS h FROM named GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.seq[1:o.h], []), coalesce(o.seq[o.h + 1:], [])) AS seq
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), members AS (
  SELECT conv_id, depth, sha256(array_to_string(list_transform(seq[1:depth], lambda x: x.tid), ','))
      AS node,
    CASE WHEN depth > 0 THEN
      sha256(array_to_string(list_transform(seq[1:depth - 1], lambda x: x.tid), ',')) END AS above,
    CASE WHEN depth > 0 THEN seq[depth].chars ELSE 0 END AS chars, depth = len(seq) AS ends
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM rebuilt)
), nodes AS (
  SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(chars) AS own_saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
      FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY depth, node
), children AS (
  SELECT above AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), whole AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node, depth)
), below AS (
  SELECT m.node, m.depth, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves,
    CAST(sum(x.own_saved) AS BIGINT) AS saved_tokens
  FROM whole x JOIN members m ON m.conv_id = x.conv_id AND m.depth <= x.depth GROUP BY ALL
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves,
  b.saved_tokens, w.ends_sha256
FROM whole w JOIN below b ON b.node = w.node AND b.depth = w.depth
LEFT JOIN nodes p ON p.node = w.above AND p.depth = w.depth - 1
"""
register("op13_conversation_trie", lambda s, d: conversation_trie(table(s, d, "conversations")), OP13)

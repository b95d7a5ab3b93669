"""URL filters: pattern rules indexed by their rarest literal token, with DataFrame functions only.

A rule is a pattern over an address (host, path and query of a URL; the scheme and the fragment are
left out). ``||`` in front anchors at the host or at one of its domains, ``|`` in front or behind at
the start or the end of the address, ``*`` stands for any text, ``^`` for one separator (neither
letter nor digit nor one of ``_ . % -``) or the end. Everything else is literal.

The runs of ASCII letters and digits that a pattern fixes as a whole are tokens that every matching
address has too. A rule is listed under the one that fewest addresses have. The tokens of an address
fetch its candidate rules, and only those are run as regular expressions. A rule without such a
token is listed under the empty token, which every address has. Of several matching rules the
highest ``tier`` wins, then the longest pattern, then the smallest pattern, then the smaller verdict.

A URL that is null or has no ``://`` has no address: its host and path are empty, no rule matches
it, and it gets the default verdict. Equal URLs are matched once. Empty tables give empty results.
Null patterns or verdicts are no rules. Only the columns named in ``keep`` are returned of the input,
so other columns cannot clash; a kept column with the name of an added one is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import staged

ALLOW, BLOCK = "allow", "block"
#: The index is broadcast up to this many bytes of patterns, tokens and regular expressions.
BROADCAST_BYTES = 8 << 20
_SEPARATOR = r"(?:[^0-9A-Za-z_.%-]|\\z)"
_TOKEN = "[0-9A-Za-z]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Host and path rules of the first tier: (rule, verdict). They hold for the host's subdomains too.
SITE_RULES = [
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
]
#: Rules of the second tier, for pages that are rarely prose: lists, forms, shops, machine output.
PAGE_RULES = [
    ("^page=", BLOCK),
    ("^sessionid=", BLOCK),
    ("^phpsessid=", BLOCK),
    ("^replytocom=", BLOCK),
    ("^print=1^", BLOCK),
    ("/login^", BLOCK),
    ("/signup^", BLOCK),
    ("/cart^", BLOCK),
    ("/checkout^", BLOCK),
    ("/wp-admin/", BLOCK),
    ("/cgi-bin/", BLOCK),
    ("/feed/|", BLOCK),
    (".rss|", BLOCK),
    (".xml|", BLOCK),
    ("||ads.*", BLOCK),
    ("||tracker.*", BLOCK),
    ("||casino*.", BLOCK),
    ("*viagra*", BLOCK),
    ("||blog.*/de/", BLOCK),
    ("||m.*.org/fr/*.html|", BLOCK),
    ("||blog.*/de/*utm_source=feed^", ALLOW),
    ("^page=*^ref=x^", ALLOW),
]


def site_and_page_rules(spark) -> DataFrame:
    """The rules in use: pattern, verdict, tier and any_case (letters match in either case)."""
    sites = [f"('||{rule}', '{verdict}', 2, false)" for rule, verdict in SITE_RULES]
    pages = [f"('{pattern}', '{verdict}', 1, true)" for pattern, verdict in PAGE_RULES]
    rows = ", ".join(sites + pages)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(pattern, verdict, tier, any_case)")


def with_address(pages: DataFrame, url: str, keep: list[str]) -> DataFrame:
    """``keep``, host, path and address (null without one) of every row."""
    after = F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(after, r"(?s)^([^#]*)", 1))
    host = F.translate(F.regexp_extract(rest, r"^([^/?]*)", 1), UPPER, LOWER)
    tail = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)", 1)
    return pages.select(
        *keep,
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(tail, r"^([^?]*)", 1), F.lit("")).alias("path"),
        F.concat(host, tail).alias("address"),
    )


def _compiled(rules: DataFrame) -> DataFrame:
    """The distinct rules with regex and the tokens that any match must have."""
    pattern = F.col("pattern")
    body = F.regexp_replace(F.regexp_replace(pattern, r"^\|\|?", ""), r"\|$", "")
    literal = F.regexp_replace(body, r"([\\.+?(){}\[\]$|])", r"\\$1")
    pieces = F.split(F.regexp_replace(literal, r"\^", _SEPARATOR), r"\*", -1)
    # The first place of each piece leaves the most for the next, so none is ever tried twice:
    # matching takes time in proportion to the address, however many '*' a pattern has.
    before = (
        F.when(pattern.startswith("||"), r"(?:[^/?]*?\.)??")
        .when(pattern.startswith("|"), "")
        .otherwise(".*?")
    )
    found = F.transform(
        pieces, lambda piece, i: F.concat(F.when(i == 0, before).otherwise(".*?"), piece)
    )
    once = F.transform(found, lambda piece: F.concat(F.lit("(?>"), piece, F.lit(")")))
    to_end = F.concat(
        F.array_join(F.slice(once, 1, F.size(once) - 1), ""), F.element_at(found, -1), F.lit(r"\z")
    )
    spelled = F.when(pattern.endswith("|"), to_end).otherwise(F.array_join(once, ""))
    flags = F.when(F.coalesce("any_case", F.lit(False)), r"(?si)\A").otherwise(r"(?s)\A")
    closed = F.concat(
        F.when(pattern.startswith("|"), "^").otherwise("*"),
        body,
        F.when(pattern.endswith("|"), "^").otherwise("*"),
    )
    return (
        rules.where("pattern IS NOT NULL AND verdict IS NOT NULL")
        .select("pattern", "verdict", F.coalesce("tier", F.lit(0)).alias("tier"), "any_case")
        .distinct()
        .select(
            "pattern",
            "verdict",
            "tier",
            F.concat(flags, spelled).alias("regex"),
            _tokens(closed, rf"(?<=[^0-9A-Za-z*]){_TOKEN}(?=[^0-9A-Za-z*])").alias("tokens"),
        )
    )


def _tokens(text: Column, pattern: str = _TOKEN) -> Column:
    lowered = F.translate(text, UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0)))


def _indexed(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """(token, rule) with every rule under the one of its tokens that fewest addresses have."""
    listed = rules.withColumn("token", F.explode_outer("tokens"))
    wanted = listed.select("token").where("token IS NOT NULL").distinct()
    seen = addresses.select(F.explode(_tokens(F.col("address"))).alias("token"))
    counts = seen.join(wanted, "token", "left_semi").groupBy("token").count()
    return (
        listed.join(counts, "token", "left")
        .groupBy("pattern", "verdict", "tier", "regex")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("rarest"))
        .select(
            F.coalesce("rarest.token", F.lit("")).alias("token"),
            F.struct(
                "tier",
                F.length("pattern").alias("size"),
                "pattern",
                "verdict",
                "regex",
            ).alias("rule"),
        )
    )


def _best(matches: DataFrame) -> DataFrame:
    """Per address its winning rule."""
    rule = F.col("rule")
    # The smallest struct wins, so what should be large is negated.
    order = F.struct((-rule.tier).alias("t"), (-rule["size"]).alias("s"), rule.pattern, rule.verdict)
    return matches.groupBy("address").agg(F.min(order).alias("won"))


def matched(addresses: DataFrame, rules: DataFrame, broadcast_bytes: int = BROADCAST_BYTES):
    """(address, pattern, tier, verdict) of the distinct ``addresses(address)`` that a rule matches."""
    index = staged(_indexed(_compiled(rules), addresses), "rule-index")
    size = index.agg(
        F.sum(F.length("token") + F.length("rule.pattern") * 2 + F.length("rule.regex") * 2 + 64)
    ).first()[0]
    tokens = F.explode(F.array_append(_tokens(F.col("address")), F.lit(""))).alias("token")
    if (size or 0) <= broadcast_bytes:
        # Nothing is copied: the address is read once for all of its tokens.
        hits = addresses.select("address", tokens).join(F.broadcast(index), "token")
    else:
        # Only names of addresses travel with their tokens; those with a candidate are read again.
        name = F.sha2("address", 256).alias("name")
        found = addresses.select(name, tokens).join(index, "token").select("name", "rule")
        hits = found.join(addresses.select(name, "address"), "name")
    runs = hits.where(F.regexp_like("address", F.col("rule.regex")))
    return _best(runs).select(
        "address",
        F.col("won.pattern").alias("pattern"),
        (-F.col("won.t")).alias("tier"),
        F.col("won.verdict").alias("verdict"),
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    keep: list[str],
    url: str = "url",
    default: str = ALLOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``keep``, host, path, pattern and tier of the winning rule (null without one) and verdict."""
    rows = with_address(pages, url, keep)
    addresses = staged(rows.select("address").where("address IS NOT NULL").distinct(), "addresses")
    verdicts = staged(matched(addresses, rules, broadcast_bytes), "verdicts")
    # Rows without an address meet nothing. A key of their own ('#' is in no address) spreads them.
    apart = F.concat(F.lit("#"), F.xxhash64(*keep).cast("string"))
    return (
        rows.withColumn("address", F.coalesce("address", apart))
        .join(verdicts, "address", "left")
        .select(
            *keep,
            "host",
            "path",
            "pattern",
            "tier",
            F.coalesce("verdict", F.lit(default)).alias("verdict"),
        )
    )


def site_verdicts(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule (of the first tier, else null), verdict and pattern."""
    rules = site_and_page_rules(pages.sparkSession)
    site = F.when(F.col("tier") == 2, F.substring_index("pattern", "||", -1))
    return judge_urls(pages, rules, keep=["page_id"]).select(
        "page_id", "host", "path", site.alias("rule"), "verdict", "pattern"
    )

"""URL filters: host rules, and pattern rules found by their rarest literal token.

A pattern is text in which ``*`` stands for anything, ``^`` for a character that is no
letter, digit or one of ``_.%-`` (or for the end), a leading ``||`` for the beginning of a
host or of one of its parents, and ``|`` at either end for that end of the url. Case does
not count. A literal token is a run of letters and digits with other literal characters on
both sides; where the pattern matches, it is a token of the url. Each pattern is indexed
under the one of its tokens that fewest urls hold. A url's tokens fetch patterns from that
index, and only those run, as regular expressions. Only DataFrame operations are used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import small, staged

#: (verdict, host, beginning of the path)
HOST_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Patterns of urls to block.
PATTERNS = (
    "||adult-*^", "||casino-*^", "||porn-*^", "||xxx.*^", "||spam-*^", "||cheap-pills.*^",
    "||free-bets.*^", "/ads/*", "/adserver/*", "/banner/*", "||ads.*^", "||ads-*^", "||doubleclick.net^", "||tracker.*^", "?affiliate=",
    "&affiliate=", "/wp-login.php", "/wp-admin/*", "/cgi-bin/*", "||bit.ly^", "||torrent.*^",
    "/warez/*", "/phishing/*", ".exe|", ".apk|",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return _lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def compiled(patterns: DataFrame) -> DataFrame:
    """(pattern, regex, tokens) of a table of patterns."""
    low = patterns.select(_lower(F.col("pattern")).alias("pattern")).where(
        "length(pattern) > 0"
    ).distinct()
    body = F.regexp_replace(F.regexp_replace("pattern", r"^\|\|?", ""), r"\|$", "")
    body = F.regexp_replace(body, r"([.+?$(){}\[\]\\|])", r"\\$1")
    body = F.replace(body, F.lit("^"), F.lit("(?:[^a-z0-9_.%-]|$)"))
    body = F.replace(body, F.lit("*"), F.lit("(?s:.*)"))
    head = F.when(F.col("pattern").startswith("||"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?").when(
        F.col("pattern").startswith("|"), "^"
    ).otherwise("")
    tail = F.when(F.col("pattern").endswith("|"), r"\z").otherwise("")
    tokens = F.regexp_extract_all("pattern", F.lit(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), 0)
    return low.select("pattern", F.concat(head, body, tail).alias("regex"), F.array_distinct(tokens).alias("tokens"))


def _blocked(urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct urls (column url) that a pattern matches."""
    rules = compiled(patterns)
    low = urls.withColumn("low", _lower(F.col("url")))
    tokens = low.select("url", "low", F.explode(F.array_distinct(F.split("low", "[^a-z0-9]+"))).alias("token"))
    used = small(staged(rules.select(F.explode("tokens").alias("token")).distinct(), "tokens"))
    held = tokens.join(used, "token").groupBy("token").agg(F.count("*").alias("urls"))
    index = rules.select("pattern", "regex", F.explode("tokens").alias("token")).join(
        held, "token", "left"
    ).groupBy("pattern", "regex").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("rarest")
    ).select("regex", F.col("rarest.token").alias("token"))
    index = small(staged(index, "index"))
    hits = tokens.join(index, "token").where("low rlike regex").select("url")
    always = [r["regex"] for r in rules.where(F.size("tokens") == 0).select("regex").collect()]
    for regex in always:  # patterns without a literal token run on every url
        hits = hits.unionByName(low.where(F.col("low").rlike(regex)).select("url"))
    return hits.distinct()


def verdicts(
    pages: DataFrame, host_rules=HOST_RULES, patterns=PATTERNS, id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    A host rule fits its host and all subdomains if the path begins with the rule's; the
    longest decides, of equally long ones the first. Where none fits, a url that a pattern
    matches is blocked, any other allowed. A null url, or one without ``://``, has empty
    host and path and fits no host rule; patterns still see such a url, but not null.
    Repeated rows stay. Further columns are not looked at.
    """
    source = pages.select(F.col(id).alias("id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    found = source.select("id", "url", host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for decision, own, begin in sorted(host_rules, key=lambda r: len(r[1] + r[2]), reverse=True)[::-1]:
        fits = ((F.col("host") == own) | F.col("host").endswith("." + own)) & F.col("path").startswith(begin)
        rule = F.when(fits, own + begin).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    found = found.select("*", rule.alias("rule"), verdict.alias("decided"))
    table = pages.sparkSession.createDataFrame([(p,) for p in patterns], "pattern string")
    undecided = found.where("decided IS NULL AND url IS NOT NULL").select("url").distinct()
    blocked = small(staged(_blocked(undecided, table), "blocked")).withColumn("matched", F.lit(True))
    # only undecided rows are looked up, by a key that is null for all others
    key = F.when(F.col("decided").isNull(), F.col("url"))
    found = found.withColumn("key", key).join(blocked.withColumnRenamed("url", "key"), "key", "left")
    return found.select(
        F.col("id").alias(id), "host", "path", "rule",
        F.coalesce("decided", F.when(F.col("matched"), "block").otherwise("allow")).alias("verdict"),
    )

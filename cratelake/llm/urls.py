"""URL filter: path rules, and host reputations shrunk to registered domain and suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.llm.store import stored

# Fixed values of the contract: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
BAR = 0.5  # a host is blocked if it is good with less than this probability,
DEVIATIONS = 1.645  # even at so many standard deviations above its posterior mean

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    found = F.instr(url, "://")
    return F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, null if none does."""
    rule = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        rule = F.when(fits, found) if rule is None else rule.when(fits, found)
    return rule


def _concentration(units: DataFrame) -> float:
    """How many pages of prior a unit's parent is worth, by the beta-binomial's second moment.

    ``units`` has good ones ``g`` of ``n`` pages and the parent's rate ``m``. Rates scatter about
    their parents by m(1-m)(1+(n-1)r)/n, which gives r; the prior weighs 1/r - 1 pages.
    """
    spread = F.col("m") * (1 - F.col("m"))
    row = units.where("n > 0").select(
        F.sum(F.col("n") * F.pow(F.col("g") / F.col("n") - F.col("m"), 2)).alias("seen"),
        F.sum(spread).alias("alone"), F.sum((F.col("n") - 1) * spread).alias("shared"),
    ).first()
    shared = row["shared"] or 0.0
    r = (row["seen"] - row["alone"]) / shared if shared > 0 else 0.001
    r = min(max(r, 0.001), 0.999)
    return 1 / r - 1


def reputations(hosts: DataFrame) -> DataFrame:
    """``host, mean, upper`` from ``hosts(host, g, n)``: the posterior of each host's share of good pages.

    The rate over all pages is the suffixes' prior mean, a suffix' posterior mean that of its
    registered domains (the last two labels), theirs that of the hosts. How much a
    level's prior weighs is estimated from how its units scatter. Three numbers, one per level, reach the
    driver. ``upper`` is the mean and ``DEVIATIONS`` standard deviations of the beta posterior.
    """
    units = stored(
        hosts.withColumn("domain", F.substring_index("host", ".", -2))
        .withColumn("suffix", F.substring_index("host", ".", -1)),
        "hosts",
    )
    total = units.agg(F.sum("g").alias("g"), F.sum("n").alias("n")).first()
    base = ((total["g"] or 0) + 1) / ((total["n"] or 0) + 2)

    def level(rows: DataFrame) -> DataFrame:
        weight = F.lit(_concentration(rows))
        return rows.withColumn("k", weight).withColumn("mean", (F.col("g") + weight * F.col("m")) / (F.col("n") + weight))

    counts = [F.sum("g").alias("g"), F.sum("n").alias("n")]
    suffixes = level(units.groupBy("suffix").agg(*counts).withColumn("m", F.lit(base)))
    parents = suffixes.select("suffix", F.col("mean").alias("m"))
    domains = level(units.groupBy("suffix", "domain").agg(*counts).join(parents, "suffix"))
    parents = domains.select("domain", F.col("mean").alias("m"))
    weighed = level(units.join(parents, "domain"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("k") + 1))
    return weighed.select("host", "mean", (F.col("mean") + DEVIATIONS * deviation).alias("upper"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages(page_id, url)``.

    ``outcomes(host, good)`` are labelled pages; a null ``good`` does not count. A page is allowed or
    blocked by the longest rule that fits, else blocked if its host's posterior bound lies
    below ``BAR``, else allowed. A host without labels has its domain's prior.

    Null urls and those without ``://`` have empty host and path, which no rule fits; they form one
    host. Repeated rows get equal verdicts, a null page_id is kept, other columns are not read, an
    empty table gives an empty result. Outcomes are summed per host before the shuffle, and only
    blocked hosts are joined with pages: a host that very many pages share is split by size.
    """
    rules = RULES if rules is None else rules
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    counted = outcomes.where("good is not null").groupBy("host").agg(
        F.sum(F.col("good").cast("long")).alias("g"), F.count(F.lit(1)).alias("n")
    )
    every = counted.union(
        parsed.groupBy("host").agg(F.lit(0).cast("long").alias("g"), F.lit(0).cast("long").alias("n"))
    ).groupBy("host").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    poor = reputations(every).where(F.col("upper") < BAR).select("host", F.lit(True).alias("_poor"))
    found = parsed.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).join(poor, "host", "left")
    return found.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(
            F.col("_rule.verdict"), F.when(F.col("_poor"), F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
    )

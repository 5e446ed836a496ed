"""URL filter: explicit rules first, else the host's reputation by empirical Bayes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import materialize, skewed_join

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Suffixes of two labels under which names are registered, the common ones.
PUBLIC_SUFFIXES = (
    "ac.jp", "ac.uk", "co.id", "co.il", "co.in", "co.jp", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au",
    "com.br", "com.cn", "com.co", "com.hk", "com.mx", "com.my", "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn",
    "edu.au", "gov.au", "gov.uk", "ne.jp", "net.au", "or.jp", "or.kr", "org.au", "org.br", "org.uk",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls.

    A rule fits its host and every subdomain if the path starts with the rule's.
    """
    rule = verdict = None
    for kind, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, name + start) if rule is None else rule.when(fits, name + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def domain_of(host: Column, public_suffixes: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix: the last two labels and the last, or one label more where
    the last two are one of ``public_suffixes`` (such as ``co.uk``)."""
    two = F.substring_index(host, ".", -2)
    longer = two.isin(*public_suffixes) if public_suffixes else F.lit(False)
    domain = F.when(longer, F.substring_index(host, ".", -3)).otherwise(two)
    return domain, F.when(longer, two).otherwise(F.substring_index(host, ".", -1))


def _concentration(groups: DataFrame, centre: Column) -> float:
    """Prior strength of a level by the method of moments for beta-binomial counts.

    ``groups`` has n and bad per group, ``centre`` is the mean expected from the level above.
    """
    gap = F.col("bad") / F.col("n") - centre
    some = groups.where(F.col("n") > 0)
    n, squares, count, spread, noise = some.agg(
        F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count("*"),
        F.sum(F.col("n") * gap * gap), F.avg(centre * (1 - centre)),
    ).first()
    if not count or count < 2 or not noise:
        return 1e4
    free = n - squares / n - (count - 1)
    rho = (spread - noise * (count - 1)) / (noise * free) if free > 0 else 0.0
    rho = min(max(rho, 1e-4), 0.5)
    return (1 - rho) / rho


def host_reputations(
    outcomes: DataFrame, *, z: float = 1.645, max_bad: float = 0.25, public_suffixes: tuple[str, ...] = ()
) -> DataFrame:
    """(host, n, bad, mean, bound, verdict) for every host of an (host, outcome) table.

    ``outcome`` is 1 for a bad page, 0 for a good one, null for a page without a label. The
    overall bad rate is the prior mean of suffixes, a suffix's posterior mean that of its
    registered domains, and a domain's that of its hosts; each level's prior strength comes
    from the spread of its groups. A host is blocked if the lower bound of its bad rate,
    ``z`` posterior deviations below the mean, exceeds ``max_bad``. Without any label the
    mean is one half and every host is allowed.
    """
    domain, suffix = domain_of(F.col("host"), public_suffixes)
    hosts = materialize(
        outcomes.groupBy("host")
        .agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).cast("bigint").alias("bad"))
        .withColumn("domain", domain).withColumn("suffix", suffix),
        "hosts",
    )

    def sums(level: str, *above: str) -> DataFrame:
        return hosts.groupBy(level, *above).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def posterior(strength: float, centre: Column) -> Column:
        return (F.lit(strength) * centre + F.col("bad")) / (F.lit(strength) + F.col("n"))

    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    overall = F.lit((bad + 0.5) / (n + 1) if n else 0.5)
    suffixes = sums("suffix")
    suffixes = suffixes.select("suffix", posterior(_concentration(suffixes, overall), overall).alias("_suffix"))
    domains = materialize(skewed_join(sums("domain", "suffix"), suffixes, "suffix", salt_by=["domain"]), "domains")
    strength = _concentration(domains, F.col("_suffix"))
    domains = domains.select("domain", posterior(strength, F.col("_suffix")).alias("_domain"))
    placed = materialize(skewed_join(hosts, domains, "domain", salt_by=["host"]), "placed")
    strength = _concentration(placed, F.col("_domain"))
    mean = posterior(strength, F.col("_domain"))
    bound = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (strength + F.col("n") + 1))
    bound = bound if n else F.lit(0.0)
    return (
        placed.select("host", "n", "bad", mean.alias("mean"))
        .withColumn("bound", bound)
        .withColumn("verdict", F.when(F.col("bound") > max_bad, "block").otherwise("allow"))
    )


def judge_urls(
    pages: DataFrame, outcome: Column, *, key: str = "page_id", url: str = "url", rules=RULES, **options
) -> DataFrame:
    """(key, host, path, rule, verdict, bad_rate, bound) for every page.

    The longest fitting rule decides; else the reputation of the host does, learnt from
    ``outcome`` over all pages. A null url, or one without ``://``, has empty host and path
    and is judged as the empty host. Repeated rows count as often as they come; a hot host
    is spread over tasks for the join with its reputation.
    """
    parts = pages.select(
        F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        outcome.alias("outcome"),
    )
    known = host_reputations(parts.select("host", "outcome"), **options)
    known = known.select("host", F.col("mean").alias("bad_rate"), "bound", F.col("verdict").alias("_by_host"))
    judged = skewed_join(parts.drop("outcome"), known, "host", salt_by=["page_id", "path"])
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.col("_by_host")).alias("verdict"), "bad_rate", "bound",
    )


def symbol_outcome(html: str = "html", share: float = 0.01) -> Column:
    """1 for a page with many symbols that prose hardly has, 0 otherwise, null without html.

    A stand-in for page labels where a table has none.
    """
    symbols = F.regexp_count(F.col(html), F.lit(r"[#*$%|]"))
    return F.when(F.col(html).isNotNull(), (symbols > share * F.length(html)).cast("int"))

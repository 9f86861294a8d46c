"""URL filter: host reputation by empirical Bayes, and rules that override it.

Each host's labelled pages, if any, are shrunk towards its registered domain, the domain towards its
suffix, and the suffix towards all pages. At every level the strength of the prior is fitted from how
much the rates of the level below differ; a level with a single labelled child is skipped. A host is
blocked if even the lower bound of its posterior rate of bad pages is above the limit, so a few bad
pages block nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import table
from reviewmill.operators.joins import fits_broadcast, hot_key_join
from reviewmill.session import written

# A host is blocked if its rate of bad pages is above this many times the rate of all labelled pages,
# with the given certainty in deviations: 95 % unless a caller says otherwise, 90 % in the query.
MAX_LIFT = 1.0
DEVIATIONS, QUERY_DEVIATIONS = 1.645, 1.282
# Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 10_000.0
# Labels that countries put before their own, so that names are registered under both.
COUNTRY_LABELS = [
    "ac", "co", "com", "edu", "go", "gob", "gov", "gouv", "ltd", "me", "mil", "ne", "net", "nom", "or",
    "org", "plc", "sch",
]
RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
    ("net/es/", "block"), ("net/fr/", "block"),
]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


def suffix_of(host: Column, suffixes: list[str]) -> Column:
    """What names are registered under: ``suffixes`` first, else by the shape of the last labels.

    A last label of two letters is a country's; with one of the labels that countries use before it,
    both are the suffix. Otherwise the last label is.
    """
    labels = F.split(host, r"\.")
    last, two = F.element_at(labels, -1), F.concat_ws(".", F.slice(labels, -2, 2))
    several = F.size(labels) >= 2
    country = (F.length(last) == 2) & F.get(labels, F.size(labels) - 2).isin(COUNTRY_LABELS)
    found = F.when(several & country, two).otherwise(last)
    for suffix in sorted(suffixes, key=lambda s: (s.count("."), s)):
        fits = (host == suffix) | F.endswith(host, F.lit("." + suffix))
        found = F.when(fits, F.lit(suffix)).otherwise(found)
    return found


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it; a host that is a suffix is its own domain."""
    labels = F.split(host, r"\.")
    wanted = F.least(F.size(labels), F.size(F.split(suffix, r"\.")) + 1)
    return F.concat_ws(".", F.slice(labels, -wanted, wanted))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does.

    A rule ``name/start`` fits the host ``name`` and its subdomains if the path starts with
    ``/start``. Rules are tried from the longest down, so the first that fits wins.
    """
    name = verdict = F.lit(None).cast("string")
    for rule, decision in sorted(rules, key=lambda r: len(r[0])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(
            path, F.lit("/" + rest)
        )
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def with_priors(levels: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The posterior of each row of ``levels`` (n, bad) under a prior fitted per parent.

    The prior's mean is the parent's own posterior mean. Its strength comes from moments: the more
    the labelled children's rates differ beyond chance, the weaker it is. One labelled child tells
    nothing of that, so its level is skipped: it has the parent's own prior, whose mean does not
    count the child's labels yet. A row without labels has its prior as posterior, and next to a
    single labelled child or none the strength of the parent's prior.
    """
    mean = F.col("_mean")
    joined = levels.join(
        parents.select(
            key, mean, F.col("_prior").alias("_mean_above"), F.col("_strength").alias("_above")
        ),
        key,
    )
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    fitted = (
        joined.groupBy(key)
        .agg(
            F.count_if(n > 0).alias("_children"),
            F.sum("n").cast("double").alias("_n"),
            F.sum(n * n).alias("_nn"),
            F.first(mean).alias("_mean"),
            F.first("_mean_above").alias("_mean_above"),
            F.first("_above").alias("_above"),
            F.sum(n * F.pow(F.try_divide(bad, n) - mean, F.lit(2.0))).alias("_spread"),
        )
        .withColumn("_chance", mean * (1 - mean))
        .withColumn("_room", F.col("_n") - F.try_divide("_nn", "_n"))
        .withColumn(
            "_excess",
            F.try_divide(
                F.col("_spread") - F.col("_chance") * (F.col("_children") - 1), F.col("_room")
            ),
        )
    )
    strength = (
        F.when(F.col("_children") <= 1, F.col("_above"))
        .when(
            F.col("_excess") > 0,
            F.least(F.greatest(F.col("_chance") / F.col("_excess") - 1, F.lit(WEAKEST)),
                    F.lit(STRONGEST)),
        )
        .otherwise(F.lit(STRONGEST))
    )
    prior = fitted.select(
        key, F.col("_mean").alias("_own"), "_mean_above", strength.alias("_strength"),
        (F.col("_children") > 1).alias("_several"),
    )
    posterior = (F.col("_prior") * F.col("_strength") + F.col("bad")) / (
        F.col("_strength") + F.col("n")
    )
    return (
        levels.join(prior, key)
        .withColumn(
            "_prior",
            F.when(F.col("_several") | (F.col("n") == 0), F.col("_own"))
            .otherwise(F.col("_mean_above")),
        )
        .withColumn("_mean", posterior)
        .drop("_own", "_mean_above", "_several")
    )


def host_reputation(
    outcomes: DataFrame, pages: DataFrame, suffixes: list[str] | None = None,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """Posterior rate of bad pages of each host of ``pages``, with its lower bound and overall rate.

    ``outcomes`` has a row per labelled page: host and bad (0 or 1); ``pages`` has a row per page:
    host. A host without a label has what its domain, suffix or all pages say. Pages without a host
    count for the overall rate only. Counts are summed before anything is joined, so a host with a
    third of all pages is a single row from then on.
    """
    none = F.lit(0).cast("bigint")
    seen = pages.select("host", none.alias("n"), none.alias("bad"), F.lit(1).alias("pages"))
    told = outcomes.select(
        "host", F.lit(1).cast("bigint").alias("n"), F.col("bad").cast("bigint").alias("bad"),
        F.lit(0).alias("pages"),
    )
    hosts = written(
        seen.union(told).groupBy("host")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("pages").alias("pages"))
        .withColumn("suffix", suffix_of(F.col("host"), suffixes or []))
        .withColumn("domain", domain_of(F.col("host"), F.col("suffix"))),
        "host-counts",
    )
    named = hosts.where("host != ''")
    domains = written(
        named.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")),
        "domain-counts",
    )
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # All pages start from one good and one bad page; without labels there is no rate at all.
    root = hosts.where("n > 0").agg(
        ((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("_mean"),
        F.lit(0.5).alias("_prior"), F.lit(2.0).alias("_strength"),
    )
    all_ = F.lit("all").alias("_all")
    suffix_rates = with_priors(
        suffixes.withColumn("_all", all_), root.withColumn("_all", all_), "_all"
    )
    domain_rates = with_priors(domains, suffix_rates, "suffix")
    rates = with_priors(named, domain_rates, "domain")
    weight = F.col("_strength") + F.col("n") + 1
    low = F.col("_mean") - deviations * F.sqrt(F.col("_mean") * (1 - F.col("_mean")) / weight)
    # The overall rate is one row.
    return rates.crossJoin(F.broadcast(root.select(F.col("_mean").alias("overall_rate")))).select(
        "host", "pages", F.col("n").alias("n_labelled"), F.col("_mean").alias("bad_rate"),
        F.greatest(low, F.lit(0.0)).alias("bad_rate_low"), "overall_rate",
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]] | None = None,
    max_lift: float = MAX_LIFT,
    id_col: str = "page_id",
    url_col: str = "url",
    suffixes: list[str] | None = None,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """Host, path, fitting rule and verdict of every page, with the host's reputation.

    A page without a rule is blocked if the lower bound of its host's rate is above ``max_lift`` times
    the rate of all labelled pages. ``suffixes`` names what else domains are registered under.

    ``outcomes`` has the columns ``page_id`` and ``bad``; several labels of a page all count, null
    labels do not. A host without a label has the reputation of its domain, or of its suffix or all
    pages where these have no label either; an url without a host has none and is allowed. Pages with
    the same id stay separate rows, and a label of the id counts once for each of their hosts; a null
    id has no label. Other columns are not returned, so names cannot clash. An empty table gives an
    empty result, and without labels only the rules decide.
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    labelled = (
        outcomes.where("bad IS NOT NULL").select("page_id", "bad")
        .join(parts.select("page_id", "host").distinct(), "page_id")
    )
    reputation = written(host_reputation(labelled, parts.select("host"), suffixes, deviations),
                         "host-rates")
    if fits_broadcast(reputation, "host"):
        judged = parts.join(F.broadcast(reputation), "host", "left")
    else:
        judged = hot_key_join(parts, reputation, "host", "pages", "page_id")
    rule, decision = matching_rule(F.col("host"), F.col("path"), RULES if rules is None else rules)
    worse = F.col("bad_rate_low") > max_lift * F.col("overall_rate")
    by_rate = F.when(worse, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path",
        rule.alias("rule"),
        F.coalesce(decision, by_rate).alias("verdict"),
        F.coalesce("n_labelled", F.lit(0)).alias("n_labelled"),
        "bad_rate", "bad_rate_low",
    )


def op6_judge_urls(spark, sf_dir: str) -> DataFrame:
    """A page is bad if the label of its number says low quality or toxic."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"),
    )
    judged = judge_urls(table(spark, sf_dir, "pages"), outcomes, deviations=QUERY_DEVIATIONS)
    return judged.select(
        "page_id", "host", "path", "rule", "verdict", "n_labelled",
        F.round("bad_rate", 9).alias("bad_rate"), F.round("bad_rate_low", 9).alias("bad_rate_low"),
    )


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END
           AS rest
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM u
), rules(rule, rhost, rpath, decision) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
         ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(decision, length(rule)) AS decision
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
), split AS (
  SELECT page_id, host, string_split(host, '.') AS l FROM p
), suffixed AS (
  SELECT page_id, host, l,
         CASE WHEN len(l) >= 2 AND length(l[-1]) = 2 AND l[-2] IN (
                'ac', 'co', 'com', 'edu', 'go', 'gob', 'gov', 'gouv', 'ltd', 'me', 'mil', 'ne',
                'net', 'nom', 'or', 'org', 'plc', 'sch') THEN 2 ELSE 1 END AS k
  FROM split
), told AS (
  SELECT doc_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1.0 ELSE 0.0 END AS bad
  FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL OR quality = 0 OR toxic = 1
), hosts AS (
  SELECT host, array_to_string(l[-k:], '.') AS suffix,
         array_to_string(l[-least(len(l), k + 1):], '.') AS domain,
         count(doc_id)::double AS n, coalesce(sum(bad), 0)::double AS bad
  FROM suffixed LEFT JOIN told ON page_id = doc_id GROUP BY ALL
), domains AS (
  SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts WHERE host <> '' GROUP BY ALL
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
), top AS (
  SELECT (sum(bad) + 1) / (sum(n) + 2) AS m, 0.5 AS above, 2.0 AS s FROM hosts
), fit1 AS (
  SELECT m, above, s, count(*) FILTER (n > 0) AS k,
         sum(n) - sum(n * n) / nullif(sum(n), 0) AS room,
         sum(CASE WHEN n > 0 THEN n * (bad / n - m) ** 2 END) AS spread
  FROM suffixes, top GROUP BY m, above, s
), strength1 AS (
  SELECT m, above, k, CASE WHEN k <= 1 THEN s
    WHEN (spread - m * (1 - m) * (k - 1)) / room > 0
    THEN least(greatest(m * (1 - m) / ((spread - m * (1 - m) * (k - 1)) / room) - 1, 1), 10000)
    ELSE 10000 END AS s
  FROM fit1
), prior1 AS (
  SELECT suffix, n, bad, s, CASE WHEN k > 1 OR n = 0 THEN m ELSE above END AS above
  FROM suffixes, strength1
), rate1 AS (
  SELECT suffix, above, s, (above * s + bad) / (s + n) AS m FROM prior1
), fit2 AS (
  SELECT suffix, m, above, s, count(*) FILTER (n > 0) AS k,
         sum(n) - sum(n * n) / nullif(sum(n), 0) AS room,
         sum(CASE WHEN n > 0 THEN n * (bad / n - m) ** 2 END) AS spread
  FROM domains JOIN rate1 USING (suffix) GROUP BY suffix, m, above, s
), strength2 AS (
  SELECT suffix, m, above, k, CASE WHEN k <= 1 THEN s
    WHEN (spread - m * (1 - m) * (k - 1)) / room > 0
    THEN least(greatest(m * (1 - m) / ((spread - m * (1 - m) * (k - 1)) / room) - 1, 1), 10000)
    ELSE 10000 END AS s
  FROM fit2
), prior2 AS (
  SELECT domain, n, bad, s, CASE WHEN k > 1 OR n = 0 THEN m ELSE above END AS above
  FROM domains JOIN strength2 USING (suffix)
), rate2 AS (
  SELECT domain, above, s, (above * s + bad) / (s + n) AS m FROM prior2
), fit3 AS (
  SELECT domain, m, above, s, count(*) FILTER (n > 0) AS k,
         sum(n) - sum(n * n) / nullif(sum(n), 0) AS room,
         sum(CASE WHEN n > 0 THEN n * (bad / n - m) ** 2 END) AS spread
  FROM hosts JOIN rate2 USING (domain) WHERE host <> '' GROUP BY domain, m, above, s
), strength3 AS (
  SELECT domain, m, above, k, CASE WHEN k <= 1 THEN s
    WHEN (spread - m * (1 - m) * (k - 1)) / room > 0
    THEN least(greatest(m * (1 - m) / ((spread - m * (1 - m) * (k - 1)) / room) - 1, 1), 10000)
    ELSE 10000 END AS s
  FROM fit3
), prior3 AS (
  SELECT host, n, bad, s, CASE WHEN k > 1 OR n = 0 THEN m ELSE above END AS above
  FROM hosts JOIN strength3 USING (domain) WHERE host <> ''
), rated AS (
  SELECT host, n::bigint AS n_labelled, (above * s + bad) / (s + n) AS bad_rate, s + n + 1 AS w FROM prior3
), bounded AS (
  SELECT host, n_labelled, bad_rate, greatest(bad_rate - 1.282 * sqrt(bad_rate * (1 - bad_rate) / w), 0) AS low
  FROM rated
)
SELECT p.page_id, p.host, path, rule,
       coalesce(decision, CASE WHEN low > m THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(n_labelled, 0) AS n_labelled, round(bad_rate, 9) AS bad_rate,
       round(low, 9) AS bad_rate_low
FROM p LEFT JOIN fits USING (page_id) LEFT JOIN bounded USING (host), top
"""

QUERIES = {"op6_judge_urls": op6_judge_urls}
ORACLES = {"op6_judge_urls": ORACLE}

"""URL verdicts: rules for hosts and paths, and trust carried over the host graph.
DataFrame functions only.

* A rule (host, path, verdict) fits a url whose host is the rule's or below it and
  whose path starts with the rule's; of several, the longest wins.
* What no rule covers is judged by its host.  Hosts of which at least SEED_SHARE of
  the pages are allowed by rules are trusted seeds, those blocked likewise are
  blocked ones.  Trust runs from trusted seeds along links, distrust from blocked
  seeds against them, each as a personalised PageRank in which every seed starts
  with 1, run until no rank can still change by LEFT.  A host whose distrust exceeds
  its trust by BLOCK_AT or more is blocked.
* Edges are links to other hosts in pages (counted once for each pair of hosts
  before anything is shuffled further), and a host and the domain right above it,
  both ways, as one party runs them.  They end at the domain that a party can
  register: names under a public suffix (PUBLIC_SUFFIX, such as ``uk``, ``co.uk`` or
  ``github.io``) are parties of their own.

Ranks move by joins and sums over (host, host) rows; a host with very many links
is split by adaptive skew joins, and sums combine before the shuffle.  Every few
rounds the ranks become a table in the shared checkpoint folder, and the one before
goes.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and has no links.  Null html has no links.  Repeated rows each get
their verdict; equal rules count once, and an equally long one of another text
wins by the order of the text.  Urls and pages of any length are read whole.  Empty
tables give none.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, remove, scratch

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
SEED_SHARE = 0.5
BLOCK_AT = 0.1
#: Share of a host's rank that it hands on each round, and rounds: ROUNDS at least,
#: and more, CUT_EVERY at a time, until all ranks together change by less than LEFT
#: in whatever rounds could follow.
DAMPING, ROUNDS, CUT_EVERY = 0.85, 50, 5
LEFT = 0.001

# Labels under which a country's names are registered (with any top-level
# domain of two letters), and domains whose owners let others run hosts under them.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gouv", "gov", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
HOSTING = ("appspot.com", "azurewebsites.net", "blogspot.com", "cloudfront.net", "fly.dev", "github.io", "gitlab.io",
           "herokuapp.com", "netlify.app", "pages.dev", "readthedocs.io", "vercel.app", "web.app", "wordpress.com", "workers.dev")
#: Pattern of whole domains under which unrelated parties have their names.
PUBLIC_SUFFIX = (r"^([^.]*|(" + "|".join(SECOND_LEVEL) + r")[.][a-z]{2}|"
                 + "|".join(h.replace(".", "[.]") for h in HOSTING) + ")$")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]*)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def domains_of(host: Column) -> Column:
    """A host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def host_rules(hosts: DataFrame, rules=RULES) -> DataFrame:
    """(host) -> (host, rules): those that fit it, longest first."""
    listed = F.array(*[F.struct(F.lit(h).alias("domain"), F.lit(p).alias("path"),
                                F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for h, p, v in rules])
    rows = hosts.sparkSession.range(1).select(F.inline(listed)).distinct()
    fits = hosts.select("host", F.explode(domains_of(F.col("host"))).alias("domain")).distinct().join(rows, "domain")
    longest_first = F.struct(-F.length("rule"), F.col("rule"), F.col("path"), F.col("verdict"))
    return fits.groupBy("host").agg(F.sort_array(F.collect_list(longest_first)).alias("rules"))


def ruled(pages: DataFrame, fitting: DataFrame) -> DataFrame:
    """(page_id, host, path) -> with the winning rule, as a struct or null."""
    first = F.get(F.filter("rules", lambda r: F.startswith("path", r["path"])), F.lit(0))
    return pages.join(fitting, "host", "left").withColumn("won", first).drop("rules")


def edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts and domains."""
    targets = F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lambda h: F.translate(h, UPPER, LOWER))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    chain = hosts.where("host <> ''").select(F.explode(domains_of(F.col("host"))).alias("src")).distinct().select(
        "src", F.expr("substring(src, instr(src, '.') + 1)").alias("dst")).where(
        ~F.col("src").rlike(PUBLIC_SUFFIX) & ~F.col("dst").rlike(PUBLIC_SUFFIX) & ~F.startswith("dst", F.lit(".")))
    back = chain.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return (links.unionByName(chain).unionByName(back).where("src <> dst and dst <> ''")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))


def propagate(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Edges and (host, trusted, blocked) seeds -> (host, trust, distrust)."""
    ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    out = ways.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    ways = cut(ways.join(out, ["kind", "src"]).select(
        "kind", "src", "dst", (F.lit(DAMPING) * F.col("weight") / F.col("all")).alias("share")), "host-links")
    start = seeds.where("trusted").select(F.lit("trust").alias("kind"), "host").unionByName(
        seeds.where("blocked").select(F.lit("distrust").alias("kind"), "host"))
    start = cut(start.select("kind", "host", F.lit(1 - DAMPING).alias("rank")), "seeds")
    rank = start.withColumn("rank", F.lit(1.0))
    # A change of c over CUT_EVERY rounds is one of c * still at most over the next,
    # and so on: the shares of a host sum to DAMPING.
    done, left, still = 0, LEFT, DAMPING**CUT_EVERY
    made: list[str] = []
    while done < ROUNDS or left >= LEFT:
        before = rank.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("old"))
        for _ in range(CUT_EVERY):
            moved = rank.join(ways.withColumnRenamed("src", "host"), ["kind", "host"]).select(
                "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share")).alias("rank"))
            rank = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        done += CUT_EVERY
        with scratch() as now:
            rank = cut(rank.withColumn("old", F.lit(0.0)).unionByName(before).groupBy("kind", "host").agg(
                F.sum("rank").alias("rank"), F.sum("old").alias("old")), "ranks")
        remove(links.sparkSession, made)
        made = now
        if done >= ROUNDS:
            change = rank.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0
            left = change * still / (1 - still)
        rank = rank.drop("old")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    return rank.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url, html) -> (page_id, host, path, rule, verdict)."""
    located = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = cut(located.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    fitting = cut(host_rules(hosts, rules), "host-rules")
    found = ruled(located.select("page_id", "host", "path"), fitting)

    share = lambda v: F.avg(F.when(F.col("won.verdict") == v, 1.0).otherwise(0.0))
    seeds = found.where("host <> ''").groupBy("host").agg(
        (share("allow") >= SEED_SHARE).alias("trusted"), (share("block") >= SEED_SHARE).alias("blocked"))
    with scratch() as made:
        scores = cut(propagate(edges(located, hosts), seeds), "host-scores")
    remove(pages.sparkSession, made[:-1])
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    judged = found.join(scores, "host", "left")
    method = F.when(distrust - trust >= BLOCK_AT, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", method).alias("verdict"))

"""URL filters: rules by host and path, and trust spread over the graph of hosts.

A rule (verdict, host, path) fits a url whose host is the rule's or below it and
whose path starts with the rule's path; the longest rule that fits decides (ties go
to the longer host). What no rule fits is judged by the url's host:

1. Host edges: links in the pages (``href`` with a host, counted), and the steps
   between a host and the host above it (``m.x.org`` - ``x.org`` - ``x.org``'s own
   names, down to two labels), weighted by the pages below.
2. Two personalised PageRanks over them, in one pass a turn: trust starts at the
   hosts of allowed pages and follows the links, distrust starts at the hosts of
   blocked pages and goes against them. A host starts with its pages of that kind,
   so both are in units of pages. Shares are rounded down to ``UNIT`` parts of a page,
   so sums are whole numbers and equal in any order.
3. A host is blocked where distrust exceeds trust by more than ``block_pct`` percent
   of its own pages (at least one page counts), else allowed. So a section that a
   rule blocks does not by itself block the rest of its host, but a host that mostly
   links to blocked ones is.

Hosts and edges are grouped with partial sums, ranks join edges by host, and adaptive
execution splits a host that holds many; nothing but the rules (at most ``MOST_RULES``,
checked) is on the driver. Each turn is cut at the shared checkpoint folder.

Defined cases: a null url or one without ``://`` has empty host and path, fits no
rule, is no seed and is allowed; null, empty and very long html is scanned whole; repeated
pages count as often as they are there; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cut import cut, stored

MOST_RULES = 500
UNIT = 1_000_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {self.verdict!r}")

    @property
    def name(self) -> str:
        return self.host + self.path


#: fixed values: the rules of the registered query
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class TrustSpec:
    turns: int = 10
    damping_pct: int = 85
    block_pct: int = 50


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""[Hh][Rr][Ee][Ff][\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?[\x09-\x0D\x20]*(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#"'<>\x09-\x0D\x20]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def apply_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` (url) with host, path, rule and ruled (its verdict); null where none fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MOST_RULES} are held in the plan")
    placed = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the last one wrapped around is asked first
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule = F.when(fits, F.lit(r.name)).otherwise(rule)
        ruled = F.when(fits, F.lit(r.verdict)).otherwise(ruled)
    return placed.withColumn("rule", rule).withColumn("ruled", ruled)


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """src, dst, w: links between hosts and steps up and down their names.

    ``pages``: host, html; ``hosts``: host, pages."""
    links = pages.filter("host != ''").select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("dst")) \
        .select("src", F.translate("dst", _UPPER, _LOWER).alias("dst")).filter("src != dst") \
        .groupBy("src", "dst").agg(F.count("*").alias("w"))
    # a.b.c.d: the steps a.b.c.d - b.c.d and b.c.d - c.d
    labels = F.split("host", r"\.")
    steps = hosts.filter("host != ''").select("pages", labels.alias("l")).filter(F.size("l") > 2) \
        .select("pages", "l", F.explode(F.sequence(F.lit(1), F.size("l") - 2)).alias("i")) \
        .select("pages", F.expr("array_join(slice(l, i, size(l)), '.')").alias("low"),
                F.expr("array_join(slice(l, i + 1, size(l)), '.')").alias("high")) \
        .groupBy("low", "high").agg(F.sum("pages").alias("w"))
    up = steps.select(F.col("low").alias("src"), F.col("high").alias("dst"), "w")
    down = steps.select(F.col("high").alias("src"), F.col("low").alias("dst"), "w")
    return links.unionByName(up).unionByName(down).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def spread(edges: DataFrame, seeds: DataFrame, spec: TrustSpec = TrustSpec()) -> DataFrame:
    """host, trust, distrust in parts of a page. ``seeds``: host, allowed, blocked (pages)."""
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "w").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    out = both.groupBy("kind", "src").agg(F.sum("w").alias("total"))
    both = cut(both.join(out, ["kind", "src"]).withColumnRenamed("src", "host"))
    start = cut(seeds.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), "host", F.col("allowed").alias("pages")),
        F.struct(F.lit("distrust").alias("kind"), "host", F.col("blocked").alias("pages")))).alias("s"))
        .select("s.kind", "s.host", (F.col("s.pages") * UNIT).alias("mass")).filter("mass > 0"))
    kept = (100 - spec.damping_pct) * UNIT // 100
    home = start.select("kind", "host", (F.expr(f"mass div {UNIT}") * kept).alias("mass"))
    rank = start
    for _ in range(spec.turns):
        sent = rank.join(both, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"),
            F.floor(F.col("mass").cast("double") * (spec.damping_pct / 100.0) * F.col("w") / F.col("total"))
            .cast("long").alias("mass"))
        rank = cut(sent.unionByName(home).groupBy("kind", "host").agg(F.sum("mass").alias("mass")).filter("mass > 0"))
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0)).alias(kind)
    return rank.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, spec: TrustSpec = TrustSpec()) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict.  ``pages``: page_id, url, html."""
    ruled = apply_rules(pages.select("page_id", F.col("url").cast("string").alias("url"),
                                     F.col("html").cast("string").alias("html")), rules)
    kinds = lambda v: F.count_if(F.col("ruled") == v)
    hosts = cut(ruled.groupBy("host").agg(F.count("*").alias("pages"), kinds("allow").alias("allowed"),
                                          kinds("block").alias("blocked")))
    edges = cut(host_edges(ruled.select("host", "html"), hosts.select("host", "pages")))
    ranks = spread(edges, hosts.select("host", "allowed", "blocked"), spec)
    bad = stored(hosts.join(ranks, "host")
                 .filter(100 * (F.col("distrust") - F.col("trust")) > spec.block_pct * UNIT * F.greatest("pages", F.lit(1)))
                 .select("host", F.lit("block").alias("spread")), "blocked-hosts")
    return ruled.join(bad, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "spread", F.lit("allow")).alias("verdict"))


def oracle_sql(spec: TrustSpec = TrustSpec()) -> str:
    """The whole judgement in SQL (DuckDB), a turn a table."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = LINK.replace("'", "''")
    turns = ",\n".join(f"""r{k + 1} as (select kind, host, cast(sum(mass) as bigint) as mass from (
    select r.kind, e.dst as host, floor(cast(r.mass as double) * {spec.damping_pct / 100.0}::double * e.w / e.total) as mass
    from r{k} r join b e on e.kind = r.kind and e.src = r.host
    union all select kind, host, pages * {(100 - spec.damping_pct) * UNIT // 100} from st) group by 1, 2 having sum(mass) > 0)"""
                         for k in range(spec.turns))
    return f"""
with p as (select page_id, html, {lower.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
ru(verdict, rhost, rpath) as (values {', '.join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}),
fit as (select page_id, arg_max(rhost || rpath, length(rhost || rpath) * 1000 + length(rhost)) as rule,
    arg_max(verdict, length(rhost || rpath) * 1000 + length(rhost)) as ruled
  from p join ru on (host = rhost or suffix(host, '.' || rhost)) and prefix(path, rpath) group by 1),
q as (select p.*, rule, ruled from p left join fit using (page_id)),
h as (select host, count(*) as pages, count(*) filter (ruled = 'allow') as allowed,
    count(*) filter (ruled = 'block') as blocked from q group by 1),
l as (select host as src, {lower.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} as dst from p where host <> ''),
s as (select pages, string_split(host, '.') as l, unnest(range(1, len(string_split(host, '.')) - 1)) as i from h where host <> ''),
u as (select array_to_string(l[i:], '.') as low, array_to_string(l[i + 1:], '.') as high, pages from s),
e as (select src, dst, sum(w) as w from (select src, dst, 1 as w from l where src <> dst
    union all select low, high, pages from u union all select high, low, pages from u) group by 1, 2),
b0 as (select 'trust' as kind, src, dst, w from e union all select 'distrust', dst, src, w from e),
b as (select *, sum(w) over (partition by kind, src) as total from b0),
st as (select * from (select 'trust' as kind, host, allowed as pages from h union all select 'distrust', host, blocked from h)
  where pages > 0),
r0 as (select kind, host, pages * {UNIT} as mass from st),
{turns},
t as (select host, sum(mass) filter (kind = 'trust') as trust, sum(mass) filter (kind = 'distrust') as distrust
  from r{spec.turns} group by 1),
bad as (select host from h join t using (host)
  where 100 * (coalesce(distrust, 0) - coalesce(trust, 0)) > {spec.block_pct * UNIT} * greatest(pages, 1))
select page_id, host, path, rule, coalesce(ruled, case when host in (select host from bad) then 'block' end, 'allow') as verdict
from q"""

"""URL filters: rules, and propagation of trust and distrust over the link graph of hosts.

A rule judges the urls of its host and all subdomains whose path starts with the
rule's path; the longest rule that fits wins.  Other urls get their host's
verdict.  Hosts with allowed pages are trusted seeds, hosts of whose pages rules
block more than half are blocked seeds.  Trust is a personalised PageRank from
the trusted seeds along links; distrust is one from the blocked seeds along
reversed links, so that who links to blocked hosts is distrusted.  A host is
blocked when its distrust exceeds its trust by ``RATIO``.

Links are the hosts of absolute ``href`` and ``src`` addresses (quoted either way or
not at all, in any case), host names of three labels or more that the page
mentions outside addresses and attributes, and the tie between a host and its
parent domain where both have pages.  User names and ports are no part of a node
of the graph.  Page links are summed per host pair before anything is joined.
Mass is a whole number of ``FINE`` parts a unit, so sums do not depend on their order
and reruns agree.  It is multiplied by a link's weight before it is divided by all
the weight of the host, so a link of a hub loses less than a part, not its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch

#: (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
ROUNDS = 12
#: Total mass of each walk, and the part of it that follows links (per cent).
MASS, FOLLOW = 10**12, 85
#: Parts of a unit of mass; mass in parts times a weight of up to 10^13 fits into 38 digits.
FINE = 10**12
RATIO = 2
#: Rounds between two cuts of the lineage.
CUT_EVERY = 6
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: One pass over a page finds address attributes with their values, other addresses, and names.
_ATTRIBUTE = r"""(?:href|src)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
_FOUND = rf"""(?<![^\s"'/])(?i:{_ATTRIBUTE})|//[^\s"'<>]*|(?<![A-Za-z0-9-])(?:[A-Za-z0-9-]++\.){{2,}}[A-Za-z]{{2,}}"""
#: The host that an address attribute leads to.
_LEADS = r"""(?i)^\w+\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""
# Last parts of file names, which are no host names.
_FILES = (
    "css", "gif", "gz", "htm", "html", "ico", "jpeg", "jpg", "js", "json", "md", "pdf", "php", "png", "svg", "txt",
    "webp", "xml", "zip"
)
_NODE = r"([^@:]*)(:\d*)?$"


def _low(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and where ``://`` is missing."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    ok = url.isNotNull() & (at > 0)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(ok, _low(host)).otherwise(""), F.when(ok, path).otherwise("")


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def node_of(host: Column) -> Column:
    """The host's node in the graph: without user name and port, A-Z lower-cased."""
    return _low(F.regexp_extract(host, _NODE, 1))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n) from (node, html): links between different hosts, summed."""
    found = F.regexp_extract_all("html", F.lit(_FOUND), F.lit(0))
    one = pages.where("node <> ''").select(
        F.col("node").alias("src"), F.explode(found).alias("x")
    ).where(~F.startswith("x", F.lit("//")))
    name = F.when(~F.lower(F.substring_index("x", ".", -1)).isin(*_FILES), F.col("x"))
    one = one.withColumn("x", F.when(F.contains("x", F.lit("=")), F.regexp_extract("x", _LEADS, 1)).otherwise(name))
    one = one.select("src", node_of(F.col("x")).alias("dst")).where("src <> dst AND dst <> ''")
    return one.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


_WHOLE = "decimal(38,0)"


def _share(mass: Column, n: Column, total: Column) -> Column:
    """mass * n / total, rounded down; the product is exact and so is the quotient."""
    product = (mass.cast("decimal(25,0)") * n.cast("decimal(13,0)")).cast(_WHOLE)
    total = total.cast("decimal(20,0)")
    return ((product - product % total) / total).cast(_WHOLE)


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Mass in parts of each (walk, host) from ``edges`` (walk, src, dst, n) and ``seeds`` (walk, host, n)."""
    scratch = Scratch(edges.sparkSession)
    out = edges.groupBy("walk", "src").agg(F.sum("n").alias("all"))
    parts = scratch.write(edges.join(out, ["walk", "src"]).select("walk", "src", "dst", "n", "all"), "parts")
    total = seeds.groupBy("walk").agg(F.sum("n").alias("all"))
    start = scratch.write(
        seeds.join(total, "walk").select(
            "walk", "host", _share(F.lit(str(MASS * FINE)), F.col("n"), F.col("all")).alias("mass")
        ),
        "seeds"
    )
    per_cent = lambda k: _share(F.col("mass"), F.lit(k), F.lit(100))
    mass = start
    for k in range(rounds):
        out = mass.select("walk", F.col("host").alias("src"), per_cent(FOLLOW).alias("mass"))
        moved = out.join(parts, ["walk", "src"]).select(
            "walk", F.col("dst").alias("host"), _share(F.col("mass"), F.col("n"), F.col("all")).alias("mass")
        )
        back = start.select("walk", "host", per_cent(100 - FOLLOW).alias("mass"))
        mass = moved.unionByName(back).groupBy("walk", "host").agg(F.sum("mass").cast(_WHOLE).alias("mass"))
        if k % CUT_EVERY == CUT_EVERY - 1:
            mass = scratch.write(mass, "mass")
    return mass


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, rules: tuple = RULES,
    rounds: int = ROUNDS, ratio: int = RATIO
) -> DataFrame:
    """Judge each page.

    Returns a row for each input row: the id, ``host``, ``path``, ``rule`` (or
    null), ``verdict`` (allow or block), ``trust`` and ``distrust`` of the host
    (whole numbers of MASS, rounded down; 0 where no walk comes).  The verdict
    compares them unrounded.

    * null urls and urls without ``://`` have empty host and path and are allowed;
    * null html has no links; null ids stay null; repeated rows count as pages of their own;
    * with no rule that fits anywhere there are no seeds and every page is allowed;
    * an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    host, path = host_and_path(F.col(url_col).cast("string"))
    src = pages.select(
        F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).cast("string").alias("html")
    )
    judged = src.withColumn(
        "r", rule_of(F.col("host"), F.col("path"), rules)
    ).withColumn("node", node_of(F.col("host")))
    hosts = judged.where("node <> ''").groupBy(F.col("node").alias("host")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("r.verdict") == "allow").alias("allowed"),
        F.count_if(F.col("r.verdict") == "block").alias("blocked")
    )
    hosts = scratch.write(hosts, "hosts")
    trusted = hosts.where("allowed > 0 AND 2 * blocked <= pages").select(
        F.lit(0).alias("walk"), "host", F.col("allowed").alias("n")
    )
    distrusted = hosts.where("2 * blocked > pages").select(F.lit(1).alias("walk"), "host", F.col("blocked").alias("n"))
    parent = hosts.select(
        F.col("host").alias("a"), F.regexp_extract("host", r"^[^.]*\.(.*)$", 1).alias("b")
    ).join(hosts.select(F.col("host").alias("b")), "b", "left_semi")
    ties = parent.select(
        F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(1).cast("long").alias("n")
    ).unionByName(parent.select(F.col("b").alias("src"), F.col("a").alias("dst"), F.lit(1).cast("long").alias("n")))
    links = scratch.write(
        host_links(judged).unionByName(ties).groupBy("src", "dst").agg(F.sum("n").alias("n")), "links"
    )
    both = links.select(F.lit(0).alias("walk"), "src", "dst", "n").unionByName(
        links.select(F.lit(1).alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    mass = propagate(both, trusted.unionByName(distrusted), rounds)
    mass = mass.groupBy("host").agg(
        *[
            F.sum(
                F.when(F.col("walk") == k, F.col("mass")).otherwise(F.lit(0).cast(_WHOLE))
            ).cast(_WHOLE).alias(c) for k,
            c in enumerate(("trust", "distrust"))
        ]
    )
    known = scratch.write(
        hosts.select("host").join(mass, "host").select(
            F.col("host").alias("h"),
            *[_share(F.col(c), F.lit(1), F.lit(FINE)).cast("long").alias(c) for c in ("trust", "distrust")],
            (F.col("distrust") > F.col("trust") * ratio).alias("bad")
        ),
        "trust"
    )
    out = judged.drop("html").join(known, judged["node"] == known["h"], "left").withColumns(
        {"trust": F.coalesce("trust", F.lit(0)), "distrust": F.coalesce("distrust", F.lit(0))}
    )
    method = F.when(F.col("bad"), "block").otherwise("allow")
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", method).alias("verdict"), "trust", "distrust"
    )


def oracle(table: str = "pages") -> str:
    """The same walks in SQL, one table expression a round; each quoting of an address has a pattern of its own."""
    cases = "".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN {{'rule': '{r}', 'verdict': '{v}'}} " for v,
        r in sorted(RULES, key=lambda x: (-len(x[1]), x[1])) for h, _, p in [r.partition("/")]
    )
    low = lambda x: f"translate({x}, '{_UPPER}', '{_UPPER.lower()}')"
    node = lambda x: low(rf"regexp_extract({x}, '([^@:]*)(:\d*)?$', 1)")
    rounds = []
    for k in range(ROUNDS):
        prev = "start" if k == 0 else f"m{k - 1}"
        rounds.append(f"""m{k} AS MATERIALIZED (SELECT walk, host, sum(mass)::HUGEINT AS mass FROM (
  SELECT p.walk, p.dst AS host, ((m.mass * {FOLLOW} // 100) * p.n) // p.total AS mass FROM {prev} m JOIN parts p ON m.walk = p.walk AND m.host = p.src
  UNION ALL SELECT walk, host, mass * {100 - FOLLOW} // 100 FROM start) GROUP BY walk, host)""")
    scheme, host = r"\s*(?:[Hh][Tt][Tt][Pp][Ss]?:)?//", r"""([^/?#"''\s<>]+)"""
    attribute = r"""(?:^|[\s"''/])(?:[Hh][Rr][Ee][Ff]|[Ss][Rr][Cc])\s*=\s*"""
    found = ", ".join(f"regexp_extract_all(html, '{attribute}{quote}{scheme}{host}', 1)" for quote in ('"', "''", ""))
    address = rf"""(?:^|[\s"''/])(?i:{_ATTRIBUTE})|//[^\s"''<>]*""".replace("'[^']*'", "''[^'']*''").replace(
        """[^\\s"'>]+""", """[^\\s"''>]+"""
    )
    name = r"(?:[A-Za-z0-9-]+\.){2,}[A-Za-z]{2,}"
    return rf"""
WITH u AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM {table}),
s AS (SELECT page_id, html, coalesce({low("regexp_extract(rest, '^([^/?#]*)', 1)")}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
j AS MATERIALIZED (SELECT *, {node('host')} AS node, CASE {cases}END AS r FROM s),
hosts AS MATERIALIZED (SELECT node AS host, count(*) AS pages, count(*) FILTER (r.verdict = 'allow') AS allowed, count(*) FILTER (r.verdict = 'block') AS blocked FROM j WHERE node <> '' GROUP BY node),
seeds AS (SELECT 0 AS walk, host, allowed AS n FROM hosts WHERE allowed > 0 AND 2 * blocked <= pages UNION ALL SELECT 1, host, blocked FROM hosts WHERE 2 * blocked > pages),
parent AS (SELECT a.host AS a, b.host AS b FROM hosts a JOIN hosts b ON b.host = regexp_extract(a.host, '^[^.]*\.(.*)$', 1)),
x AS (SELECT node AS src, unnest(list_concat({found})) AS x FROM j WHERE node <> ''
  UNION ALL SELECT src, x FROM (SELECT node AS src, unnest(regexp_extract_all(regexp_replace(html, '{address}', ' ', 'g'), '{name}')) AS x FROM j WHERE node <> '') WHERE lower(string_split(x, '.')[-1]) NOT IN {_FILES}),
y AS (SELECT src, {node('x')} AS dst FROM x),
links AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM (SELECT src, dst FROM y WHERE src <> dst AND dst <> '' UNION ALL SELECT a, b FROM parent UNION ALL SELECT b, a FROM parent) GROUP BY src, dst),
edges AS (SELECT 0 AS walk, src, dst, n FROM links UNION ALL SELECT 1, dst, src, n FROM links),
parts AS MATERIALIZED (SELECT walk, src, dst, n::HUGEINT AS n, (sum(n) OVER (PARTITION BY walk, src))::HUGEINT AS total FROM edges),
start AS MATERIALIZED (SELECT walk, host, ({MASS * FINE}::HUGEINT * n) // (sum(n) OVER (PARTITION BY walk))::HUGEINT AS mass FROM seeds),
{", ".join(rounds)},
known AS (SELECT host, sum(CASE WHEN walk = 0 THEN mass ELSE 0 END)::HUGEINT AS trust, sum(CASE WHEN walk = 1 THEN mass ELSE 0 END)::HUGEINT AS distrust FROM m{ROUNDS - 1} GROUP BY host)
SELECT page_id, j.host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN h.host IS NOT NULL AND coalesce(distrust, 0) > {RATIO} * coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN h.host IS NULL THEN 0 ELSE coalesce(trust, 0) // {FINE} END::BIGINT AS trust, CASE WHEN h.host IS NULL THEN 0 ELSE coalesce(distrust, 0) // {FINE} END::BIGINT AS distrust
FROM j LEFT JOIN hosts h ON h.host = j.node LEFT JOIN known ON j.node = known.host"""

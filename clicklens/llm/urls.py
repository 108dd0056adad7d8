"""URL filters: explicit rules, and block decisions handed on to aliases.

Pages that redirect to, or name as canonical, one another are one resource under
several addresses. Connected components of these links are the resources; an
address without a rule of its own gets the decision of its resource.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.graph import components
from clicklens.llm.ranks import gapless
from clicklens.llm.store import stage

# Rules are a part of the query text, so their number is bounded.
MAX_RULES = 500
NODES_A_BUCKET = 100_000

# A tag ends at the next angle bracket, so no text is read twice.
SKIPPED = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</(?:script|style)\s*>|\z)"
TAG = r"(?i)(<(?:link|meta)\b[^<>]*>)"
IS_CANONICAL = (
    r"(?i)\srel\s*=\s*(?:\"[^\"]*\bcanonical\b[^\"]*\"|'[^']*\bcanonical\b[^']*'"
    r"|canonical[\s/>])"
)
IS_REFRESH = r"(?i)\shttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"
HREF = r"(?i)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
REFRESH_URL = r"(?i)[;,\s\"']url\s*=\s*[\"']?([^\"'>\s]+)"


@dataclass(frozen=True)
class Rule:
    """A decision for a host, its subdomains, and paths that start so."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; NULL where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def host_of(url: Column) -> Column:
    """The host with A-Z lower-cased, empty for NULL or a text without ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    path = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def address_of(url: Column) -> Column:
    """Host, path and query: what tells resources apart. NULL without a host."""
    rest = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^#]*)", 1)
    host = host_of(url)
    return F.when(host != "", F.concat(host, rest))


def resolved(link: Column, base: Column) -> Column:
    """A link as an absolute address, as seen from the page ``base``."""
    scheme = F.regexp_extract(base, r"\A(.*?://)", 1)
    site = F.regexp_extract(base, r"\A(.*?://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"\A(.*?://[^?#]*)", 1)
    folder = F.regexp_extract(page, r"\A(.*?://[^/]*/.*/|.*?://[^/]*/)", 1)
    folder = F.when(folder == "", F.concat(site, F.lit("/"))).otherwise(folder)
    return (
        F.when(link.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.substring_index(scheme, "//", 1), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(folder, link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``from_url, to_url`` of canonical links and refresh redirects in the pages.

    Comments, scripts and styles hold no links. A link to the page itself, an
    empty one, or one whose page has no address gives no row.
    """
    tags = F.regexp_extract_all(
        F.regexp_replace("html", SKIPPED, " "), F.lit(TAG), F.lit(1)
    )
    # most pages have none, which one search tells
    likely = F.col("html").rlike(r"(?i)canonical|refresh")

    def link(tag: Column) -> Column:
        href = F.concat(*[F.regexp_extract(tag, HREF, i) for i in (1, 2, 3)])
        return F.when(tag.rlike(IS_CANONICAL), href).when(
            tag.rlike(IS_REFRESH), F.regexp_extract(tag, REFRESH_URL, 1)
        )

    found = F.explode(F.transform(tags, link)).alias("link")
    return (
        pages.filter(likely)
        .select("url", found)
        .select("url", F.trim(F.replace("link", F.lit("&amp;"), F.lit("&"))).alias("link"))
        .filter("link <> '' AND NOT startswith(link, '#')")
        .select(
            F.col("url").alias("from_url"),
            resolved(F.col("link"), F.col("url")).alias("to_url"),
        )
    )


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    sub = host.endswith(f".{rule.host}")
    return ((host == rule.host) | sub) & path.startswith(rule.path)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The text of the longest rule that fits; NULL for none."""
    found = F.when(F.lit(False), F.lit(""))
    for rule in sorted(rules, key=lambda r: len(r.text), reverse=True):
        found = found.when(_fits(rule, host, path), rule.text)
    return found


def _blocks(rules: Sequence[Rule], rule: Column) -> Column:
    """Whether a rule, given by its text, blocks."""
    return rule.isin([r.text for r in rules if r.verdict == "block"])


def blocked_aliases(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``address`` of every linked address without a rule whose resource has a
    blocked address and no allowed one."""
    edges = (
        stage(links)
        .select(
            address_of(F.col("from_url")).alias("from_"),
            address_of(F.col("to_url")).alias("to_"),
        )
        .filter("from_ <> to_")
        .distinct()
    )
    edges = stage(edges)
    nodes = edges.select(F.explode(F.array("from_", "to_")).alias("address")).distinct()
    rows = edges.count()
    if not rows:
        return nodes
    buckets = max(64, 2 * rows // NODES_A_BUCKET)
    nodes = stage(gapless(nodes, [], ["address"], "node", buckets))
    ends = [
        nodes.select(F.col("address").alias(c), F.col("node").alias(n))
        for c, n in (("from_", "a"), ("to_", "b"))
    ]
    numbered = edges.join(ends[0], "from_").join(ends[1], "to_").select("a", "b")

    url = F.concat(F.lit("://"), "address")
    members = nodes.select(
        "node", "address", rule_of(rules, host_of(url), path_of(url)).alias("rule")
    ).join(components(numbered), "node")
    # of the rules that a resource meets, all block it
    blocked = members.groupBy("root").agg(
        F.coalesce(F.min(_blocks(rules, F.col("rule"))), F.lit(False)).alias("blocked")
    ).filter("blocked")
    return (
        members.filter("rule IS NULL")
        .join(blocked.select("root"), "root", "left_semi")
        .select("address")
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None
) -> DataFrame:
    """A verdict for every page.

    ``pages`` has ``page_id``, ``url`` and ``html`` (other columns are not read);
    ``redirects`` may give further links as ``from_url, to_url``. Returns
    ``page_id, host, path, rule, verdict, reason``, a row for each row of
    ``pages``, repeated ones too.

    The longest rule that fits decides (``reason`` is ``rule``). A page without a
    rule is blocked when a page linked to it, over any number of links, is
    blocked by a rule and none of them is allowed by one (``alias``); else it is
    allowed (``default``). A NULL url, or one without ``://``, has an empty host
    and path, fits no rule and has no links. NULL html has no links. No rows give
    no rows.
    """
    if len(rules) > MAX_RULES or len({rule.text for rule in rules}) < len(rules):
        raise ValueError(f"more than {MAX_RULES} rules, or one given twice")
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    aliases = blocked_aliases(links, rules).select(
        F.col("address").alias("alias_of"), F.lit(True).alias("aliased")
    )
    judged = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        address_of(F.col("url")).alias("address"),
    ).withColumn("rule", rule_of(rules, F.col("host"), F.col("path")))
    # rows that no alias can decide spread by their id; no address has a '#'
    ruled = F.col("rule").isNotNull()
    spread = F.concat(F.lit("#"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    keyed = judged.withColumn(
        "alias_of", F.when(~ruled & F.col("address").isNotNull(), F.col("address")).otherwise(spread)
    )
    blocked = F.when(ruled, _blocks(rules, F.col("rule"))).otherwise(
        F.col("aliased").isNotNull()
    )
    return keyed.join(aliases, "alias_of", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(blocked, "block").otherwise("allow").alias("verdict"),
        F.when(ruled, "rule")
        .when(F.col("aliased"), "alias")
        .otherwise("default")
        .alias("reason"),
    )

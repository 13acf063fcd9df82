"""Block and allow rules for URLs, carried over to aliases.

A rule names a host and a path; it fits the host and its subdomains where the
path begins with the rule's, and the longest fitting rule decides. Pages that redirect to each
other, or name each other as canonical, are one thing under several addresses:
components over those links. An address without a rule of its own is blocked
if an address of its component is, unless another one is explicitly allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.llm.components import connected_components
from ledgerlight.llm.storage import Workspace

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_REFRESH_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""

RULES = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _ADDRESS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def absolute(link: Column, host: Column, path: Column) -> Column:
    """A link on a page as an address with a scheme."""
    folder = F.regexp_replace(path, r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.lit("x:"), link))
        .when(link.startswith("/"), F.concat(F.lit("x://"), host, link))
        .when(link.startswith("?") | link.startswith("#"), F.concat(F.lit("x://"), host, path))
        .otherwise(F.concat(F.lit("x://"), host, folder, link))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Canonical and refresh links of the pages: ``(from_host, from_path, to_host, to_path)``."""
    found = pages.select(
        host_of(F.col(url_col)).alias("from_host"),
        path_of(F.col(url_col)).alias("from_path"),
        F.explode(
            F.array(
                F.regexp_extract(F.regexp_extract(html_col, _CANONICAL, 0), _HREF, 1),
                F.regexp_extract(F.regexp_extract(html_col, _REFRESH, 0), _REFRESH_URL, 1),
            )
        ).alias("link"),
    ).where("link <> ''")
    target = absolute(F.col("link"), F.col("from_host"), F.col("from_path"))
    return found.select("from_host", "from_path", host_of(target).alias("to_host"), path_of(target).alias("to_path"))


def decide(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of each distinct ``(host, path)``; addresses that none fits are left out.

    Of equally long rules the allowing one wins.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    rule = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("rule_path"), F.concat("host", "path").alias("rule"), "verdict"
    )
    fitting = (
        addresses.withColumn("suffix", F.explode(F.array_distinct(suffixes)))
        .join(rule, "suffix")
        .where(F.col("path").startswith(F.col("rule_path")))
    )
    rank = F.struct(F.length("rule").alias("length"), (F.col("verdict") == "allow").alias("allowed"), F.col("rule").alias("rule"))
    best = fitting.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", "best.rule", F.when(F.col("best.allowed"), "allow").otherwise("block").alias("verdict"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Per page: id, host, path, the rule that fits (or null) and the verdict.

    ``rules``: host, path, verdict (allow or block). ``redirects``: further links as ``from_url, to_url``.
    A null url, or one without ``://``, has an empty host and path; no rule but one for an empty host fits it,
    and it takes part in no link. Repeated rows are judged alike; an empty table gives no rows; without links only rules
    decide, and what neither blocks is allowed.
    """
    work = Workspace(pages.sparkSession, "urls")
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        ends = [f(F.col(c)).alias(f"{c.removesuffix('_url')}_{n}") for c in ("from_url", "to_url") for n, f in (("host", host_of), ("path", path_of))]
        links = links.unionByName(redirects.select(*ends))
    links = work.write(links.where("from_host <> '' AND to_host <> ''").distinct(), "links")
    ends = [links.select(F.struct(F.col(f"{e}_host").alias("host"), F.col(f"{e}_path").alias("path")).alias("address")) for e in ("from", "to")]
    # Nodes are host and path with a character that neither holds between them.
    node = lambda e: F.concat_ws("?", f"{e}_host", f"{e}_path")
    members = connected_components(links.select(node("from").alias("a"), node("to").alias("b")), work, "aliases")
    own = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    addresses = own.select("host", "path").unionByName(ends[0].unionByName(ends[1]).select("address.*")).distinct()
    decided = work.write(decide(addresses, rules), "decided")
    verdicts = members.join(decided.withColumn("node", F.concat_ws("?", "host", "path")), "node").groupBy("component").agg(
        F.bool_or(F.col("verdict") == "block").alias("blocked"), F.bool_or(F.col("verdict") == "allow").alias("allowed")
    )
    inherited = members.join(verdicts.where("blocked AND NOT allowed"), "component").select(
        F.substring_index("node", "?", 1).alias("host"), F.substring_index("node", "?", -1).alias("path"), F.lit("block").alias("inherited")
    )
    judged = own.join(decided, ["host", "path"], "left").join(inherited, ["host", "path"], "left")
    return judged.select(id_col, "host", "path", "rule", F.coalesce("verdict", "inherited", F.lit("allow")).alias("verdict"))

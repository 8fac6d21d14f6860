"""URL filter with redirect equivalence.

Rules block or allow a host with its subdomains below a path; the longest fitting rule decides a URL.  URLs tied
by redirects or canonical links are aliases: connected components over these edges carry a block to
every alias that no rule names.  A rule of the URL's own comes first, and an allowed member keeps a
component's unnamed aliases allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import checkpoint, components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for a null or other URL."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def key_of(rest: Column) -> Column:
    """Node of a URL: host, path and query, without scheme and fragment; null if there is no host."""
    key = F.concat(host_of(rest), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))
    return F.when(host_of(rest) != "", key)


def link_targets(html: Column, host: Column, path: Column) -> Column:
    """Keys that a page's canonical links and refresh redirects name, resolved against its own URL."""
    tags = F.when(html.rlike(r"(?i)canonical|http-equiv"), F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0))
    tags = F.coalesce(tags, F.array().cast("array<string>"))
    canonical = F.filter(tags, lambda t: t.rlike(r"""(?is)^<link\b[^>]*\brel\s*=\s*["']?canonical\b"""))
    refresh = F.filter(tags, lambda t: t.rlike(r"""(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b"""))
    named = F.concat(
        F.transform(canonical, lambda t: F.regexp_extract(t, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]*)""", 1)),
        F.transform(refresh, lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?([^"'\s>]*)""", 1)),
    )

    def resolved(t: Column) -> Column:
        t = F.replace(t, F.lit("&amp;"), F.lit("&"))
        rest = (
            F.when(F.instr(t, "://") > 0, after_scheme(t))
            .when(t.startswith("//"), F.substring(t, 3, 1 << 30))
            .when(t.startswith("/"), F.concat(host, t))
            .when(t != "", F.concat(host, F.regexp_replace(path, r"[^/]*$", ""), t))
        )
        return key_of(rest)

    return F.filter(F.transform(named, resolved), lambda k: k.isNotNull())


def with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``host, path``) plus ``rule`` and ``action`` of the longest fitting rule, else null.

    ``rules``: ``rule_host, rule_path, action``.  Only host endings with as many labels as some rule has are tried.
    """
    rules = rules.select("rule_host", "rule_path", "action", F.concat("rule_host", "rule_path").alias("rule"))
    most = rules.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("n")).first()["n"] or 1
    labels = F.slice(F.split("host", r"\."), F.greatest(F.lit(1), F.size(F.split("host", r"\.")) - (most - 1)), F.lit(most))
    endings = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.lit(most)), "."))
    tried = urls.where("host != ''").select("host", "path").distinct().withColumn("labels", labels)
    tried = tried.select("host", "path", F.explode(endings).alias("rule_host")).join(rules, "rule_host")
    fits = tried.where(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "action"), F.struct(F.length("rule"), "rule", "action")).alias("b"))
    return urls.join(best, ["host", "path"], "left").select(*urls.columns, F.col("b.rule").alias("rule"), F.col("b.action").alias("action"))


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, component`` per row of ``pages`` (``page_id, url, html``).

    ``edges`` (``a, b``: URLs) adds further redirects.  A null url, or one without ``://``, has empty host and
    path, no rule and no alias, and is allowed; repeated rows come out repeated; a null html has
    no links; an empty table gives an empty result.  Extra columns are left out.
    """
    rest = after_scheme(F.col("url"))
    urls = pages.select("page_id", "html", host_of(rest).alias("host"), path_of(rest).alias("path"), key_of(rest).alias("key"))
    urls = checkpoint(urls.select("page_id", "host", "path", "key", link_targets(F.col("html"), F.col("host"), F.col("path")).alias("targets")))
    ties = urls.where("size(targets) > 0").select(F.col("key").alias("a"), F.explode("targets").alias("b"))
    if edges is not None:
        ties = ties.union(edges.select(key_of(after_scheme(F.col("a"))), key_of(after_scheme(F.col("b")))))
    alias = checkpoint(components(ties))
    nodes = with_rule(alias.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))}), rules)
    has = lambda action: F.max((F.col("action") == action).cast("int"))
    told = nodes.groupBy("component").agg(F.coalesce((has("block") == 1) & (has("allow") == 0), F.lit(False)).alias("blocked"))
    told = alias.join(told, "component").select(F.col("node").alias("key"), "component", "blocked")
    out = with_rule(urls.select("page_id", "host", "path", "key"), rules).join(told, "key", "left")
    verdict = F.coalesce("action", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")

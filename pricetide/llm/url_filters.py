"""URL filters with redirect equivalence.

Rules name a host with all its subdomains and the start of a path; the longest rule that fits decides.  Pages that no
rule fits take part in an alias graph: edges lead from a page to its canonical link, to the target of its meta refresh
and along a table of redirects, if there is one.  Connected components of that graph carry block decisions to all
aliases.  A page that a rule allows stays allowed, whatever its aliases are; among rules of equal length, allow comes
first.

Only DataFrame functions are used.  The nodes of the graph are addresses without scheme and fragment.

Defined results: a null address, or one without ``://``, has an empty host and path, fits no rule, has no aliases and
is allowed.  Null or empty html has no links.  Repeated rows are judged alike and never merged.  Links without an
address, or to the page itself, do nothing.  Other columns pass through, but for columns with the names of results,
which are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import ascii_lower, free_prefix, read_table, staged
from pricetide.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if nothing does."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def address(url: Column) -> Column:
    """Host, path and query: the same for every scheme and fragment; null if there is no host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)))


def _first_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits; null if none does."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, with or without quotes; empty if it has none."""
    raw = F.regexp_extract(tag, r"(?is)\s" + name + r"\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", 1)
    return F.replace(F.regexp_replace(raw, r"^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&"))


def _absolute(link: Column, host: Column, path: Column) -> Column:
    """A link as an absolute address, seen from a page."""
    folder = F.regexp_extract(path, r"^(.*/)?", 0)
    base = F.concat(F.lit("x://"), host)
    return F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link) \
        .when(link.startswith("//"), F.concat(F.lit("x:"), link)) \
        .when(link.startswith("/"), F.concat(base, link)) \
        .when(link.startswith("?"), F.concat(base, path, link)) \
        .when((link != "") & ~link.startswith("#") & ~link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(
            base, F.when(folder == "", F.lit("/")).otherwise(folder), F.regexp_replace(link, r"^(\./)+", "")))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses that pages name as their canonical link or refresh to."""
    u, h = F.col(url), F.col(html)
    links = F.filter(F.regexp_extract_all(h, F.lit(r"(?is)<link\s[^>]*>"), F.lit(0)),
                     lambda t: F.lower(_attribute(t, "rel")) == "canonical")
    moves = F.filter(F.regexp_extract_all(h, F.lit(r"(?is)<meta\s[^>]*>"), F.lit(0)),
                     lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    targets = F.concat(
        F.transform(links, lambda t: F.trim(_attribute(t, "href"))),
        F.transform(moves, lambda t: F.regexp_extract(_attribute(t, "content"), r"(?is)url\s*=\s*['\"]?([^'\"\s]+)", 1)))
    # The two words tell most pages without links before their tags are looked at.
    likely = pages.where(u.isNotNull() & (F.lower(h).contains("canonical") | F.lower(h).contains("refresh")))
    found = likely.select(u.alias("url"), F.explode(targets).alias("link"))
    placed = found.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn(
        "target", _absolute(F.col("link"), F.col("host"), F.col("path")))
    return placed.select(address(F.col("url")).alias("a"), address(F.col("target")).alias("b")) \
        .where("a is not null and b is not null and a != b").distinct()


def blocked_aliases(edges: DataFrame, rules=RULES) -> DataFrame:
    """(node): all addresses in a component of which a rule blocks a member."""
    parts = staged(connected_components(edges), "aliases")
    placed = parts.withColumn("url", F.concat(F.lit("x://"), F.col("node"))).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    _, verdict = _first_rule(F.col("host"), F.col("path"), rules)
    blocked = placed.where(verdict == "block").select("component").distinct()
    return parts.join(blocked, "component").select("node")


def url_filters(pages: DataFrame, url: str = "url", html: str = "html", rules=RULES,
                redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``via_alias`` (the verdict came over an alias).

    ``redirects`` is a table (a, b) of absolute addresses, the second being where the first leads.
    """
    p = free_prefix(pages)
    edges = alias_edges(pages, url, html)
    if redirects is not None:
        edges = edges.union(redirects.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b")))
    blocked = blocked_aliases(edges, rules).select(F.col("node").alias(p + "node"), F.lit(True).alias(p + "hit"))
    u = F.col(url)
    df = pages.withColumn(p + "host", host_of(u)).withColumn(p + "path", path_of(u))
    text, verdict = _first_rule(F.col(p + "host"), F.col(p + "path"), rules)
    df = df.withColumn(p + "rule", text).withColumn(p + "verdict", verdict).withColumn(
        p + "address", F.when(F.col(p + "rule").isNull(), address(u)))
    df = df.join(blocked, F.col(p + "address") == F.col(p + "node"), "left")
    hit = F.coalesce(F.col(p + "hit"), F.lit(False))
    result = {"host": F.col(p + "host"), "path": F.col(p + "path"), "rule": F.col(p + "rule"),
              "verdict": F.coalesce(F.col(p + "verdict"), F.when(hit, F.lit("block")).otherwise(F.lit("allow"))),
              "via_alias": hit}
    return df.select(*[F.col(c) for c in pages.columns if c.lower() not in result],
                     *[v.alias(k) for k, v in result.items()])


def op10(spark, folder: str) -> DataFrame:
    return url_filters(read_table(spark, folder, "pages")).drop("url", "html")


def _rest_sql(url: str) -> str:
    return f"(case when instr({url}, '://') > 0 then substr({url}, instr({url}, '://') + 3) else '' end)"


def _fold_sql(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _host_sql(url: str) -> str:
    return _fold_sql(f"regexp_extract({_rest_sql(url)}, '^[^/?#]*')")


def _path_sql(url: str) -> str:
    return f"regexp_extract({_rest_sql(url)}, '^[^/?#]*([^?#]*)', 1)"


def url_sql(rules=RULES) -> str:
    """DuckDB SQL for ``op10``; aliases are followed by a recursive query."""
    def attribute(tag, name):
        raw = f"""regexp_extract({tag}, '(?is)\\s{name}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>"'']+)', 1)"""
        return f"""replace(regexp_replace({raw}, '^["'']|["'']$', '', 'g'), '&amp;', '&')"""

    def case(host, path, what):
        arms = " ".join(
            f"when ({host} = '{r.host}' or ends_with({host}, '.{r.host}')) and starts_with({path}, '{r.path}') "
            f"then '{r.text if what == 'rule' else r.verdict}'"
            for r in sorted(rules, key=lambda r: (-len(r.text), r.verdict != "allow")))
        return f"case {arms} end"

    def where(u):
        return (f"nullif({_host_sql(u)}, '') || regexp_extract({_rest_sql(u)}, '^[^/?#]*([^#]*)', 1)")

    return f"""
with recursive tags as (
    select url, unnest(list_concat(
        list_transform(list_filter(regexp_extract_all(html, '(?is)<link\\s[^>]*>'),
            lambda t: lower({attribute('t', 'rel')}) = 'canonical'), lambda t: trim({attribute('t', 'href')})),
        list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\\s[^>]*>'),
            lambda t: lower({attribute('t', 'http-equiv')}) = 'refresh'),
            lambda t: regexp_extract({attribute('t', 'content')}, '(?is)url\\s*=\\s*[''"]?([^''"\\s]+)', 1)))) link
    from pages where url is not null),
full_ as (select url, case when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') then link
    when starts_with(link, '//') then 'x:' || link
    when starts_with(link, '/') then 'x://' || {_host_sql('url')} || link
    when starts_with(link, '?') then 'x://' || {_host_sql('url')} || {_path_sql('url')} || link
    when link <> '' and not starts_with(link, '#') and not regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:')
    then 'x://' || {_host_sql('url')} || case when regexp_extract({_path_sql('url')}, '^(.*/)?') = '' then '/'
        else regexp_extract({_path_sql('url')}, '^(.*/)?') end || regexp_replace(link, '^(\\./)+', '') end link from tags),
one as (select distinct {where('url')} a, {where('link')} b from full_),
edges as (select a, b from one where a <> b union select b, a from one where a <> b),
nodes as (select distinct a node, 'x://' || a u from edges),
reach(node) as (
    select node from nodes where {case(_host_sql('u'), _path_sql('u'), 'verdict')} = 'block'
    union select b from edges join reach on a = node),
judged as (select page_id, url, {_host_sql('url')} host, {_path_sql('url')} path from pages),
ruled as (select *, {case('host', 'path', 'rule')} rule, {case('host', 'path', 'verdict')} verdict from judged)
select page_id, coalesce(host, '') host, coalesce(path, '') path, rule,
    coalesce(verdict, case when reach.node is not null then 'block' else 'allow' end) verdict,
    reach.node is not null via_alias
from ruled left join reach on rule is null and reach.node = {where('url')}"""

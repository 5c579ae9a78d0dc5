"""URL filter by a path-template tree per host, in built-in expressions only.

Variable segments of a path become wildcards: first by form (numbers, long hexadecimal or mixed ones),
then by statistics: where a node of the host's tree has too many different children for the paths below
it, the children become one wildcard. Sibling templates whose labelled pages are blocked at statistically
similar rates are merged, in the order of their rates, so that a node may have several groups. The purity of a group, the
share of blocked pages among its labelled ones, is smoothed towards that of all its siblings, theirs towards the
host's, and the host's towards that of all pages; a template without labels thus has its siblings' or its host's.
A template is rejected if its purity is high enough. Only rows per host and template, or fewer, are ever
compared, so a host with a third of all pages costs what its templates do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from brontide.llm.common import replace_columns
from brontide.session import materialize

ANY = "*"


@dataclass(frozen=True)
class Rule:
    """``prefix`` is a host, then a slash and how the path goes on."""

    prefix: str
    action: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


@dataclass(frozen=True)
class Tree:
    """``fan_out`` children are never too many; above, they are if they exceed ``variety`` of the different paths below the
    node. ``levels`` segments are told apart; what follows them is one wildcard. Templates of ``support`` labelled pages may be
    merged, if a test at ``same`` standard errors does not tell their rates apart. ``smoothing`` counts as so many pages of the
    wider group, and ``purity`` rejects."""

    levels: int = 6
    fan_out: int = 12
    variety: float = 0.3
    same: float = 1.96
    support: int = 5
    smoothing: float = 4.0
    purity: float = 0.8


def split_url(url: str) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path without query and fragment; both empty for null or no ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as ``struct<prefix, action>``, or null. Rules are a short list of a policy.

    A rule fits its host and all subdomains, where the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<prefix:string,action:string>")
    for r in sorted(rules, key=lambda r: (len(r.prefix), r.prefix)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.prefix).alias("prefix"), F.lit(r.action).alias("action"))).otherwise(found)
    return found


def typed_segments(path: Column) -> Column:
    """The segments of a path; those that vary by their form are wildcards, file endings stay."""
    # A number, a long hexadecimal one, and a long mixture of letters with at least two digits.
    forms = [r"\d+", r"(?=[^.]*\d)[0-9A-Fa-f-]{8,}", r"(?=[^.]*\d[^.]*\d)(?=[^.]*[A-Za-z])[^.]{16,}"]

    def generalised(segment: Column) -> Column:
        for form in forms:
            segment = F.regexp_replace(segment, rf"^{form}(\.[A-Za-z]{{1,5}})?$", r"*$1")
        return segment

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), generalised)


def template_tree(pages: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """A row per host and typed path of ``pages`` (``host``, ``typed``, ``blocked``: 1, 0 or null for no label),
    with its ``template``, and the ``labelled``, ``blocked`` and smoothed ``purity`` of the merged group.

    A path without segments has the empty template. Without any labels all purities are 0; an empty table gives no rows.
    """
    paths = pages.groupBy("host", "typed").agg(F.count("*").alias("n"), F.count("blocked").alias("labelled"),
                                              F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"))
    paths = materialize(paths.withColumn("template", F.lit("")), "url-paths")
    deepest = min(tree.levels, paths.agg(F.max(F.size("typed"))).first()[0] or 0)
    for level in range(deepest):
        child = F.get("typed", F.lit(level))
        kids = paths.filter(child.isNotNull()).groupBy("host", "template", child.alias("child")).agg(F.count("*").alias("n"))
        nodes = kids.groupBy("host", "template").agg(F.count("*").alias("kids"), F.sum("n").alias("total"))
        wide = nodes.filter((F.col("kids") > tree.fan_out) & (F.col("kids") > tree.variety * F.col("total")))
        wide = wide.select("host", "template", F.lit(True).alias("wide"))
        step = F.when(child.isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.when(F.col("wide"), F.lit(ANY)).otherwise(child)))
        paths = materialize(paths.join(wide, ["host", "template"], "left").withColumn("template", F.concat("template", step)).drop("wide"), "url-paths")
    more = F.when(F.size("typed") > tree.levels, F.lit("/**")).otherwise("")
    paths = paths.withColumn("template", F.concat("template", more))

    one = paths.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    one = materialize(one.withColumn("parent", F.regexp_replace("template", r"/[^/]*$", "")), "url-templates")
    total = one.agg(F.coalesce(F.sum("b") / F.sum("l"), F.lit(0.0))).first()[0]

    def smoothed(b: str, l: str, prior: Column) -> Column:  # noqa: E741
        return (F.col(b) + tree.smoothing * prior) / (F.col(l) + tree.smoothing)

    # Towards the wider group, from the host down; sums per host and per node are joined.
    hosts = one.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("b").alias("hb"))
    nodes = one.groupBy("host", "parent").agg(F.sum("l").alias("pl"), F.sum("b").alias("pb"))
    nodes = nodes.join(hosts, "host").withColumn("of_node", smoothed("pb", "pl", smoothed("hb", "hl", F.lit(total))))
    groups = materialize(_groups(one, tree), "url-groups")
    sums = groups.groupBy("host", "parent", "group").agg(F.sum(F.col("l") * F.col("templates")).alias("gl"), F.sum(F.col("b") * F.col("templates")).alias("gb"))
    of_pair = groups.join(sums, ["host", "parent", "group"]).select("host", "parent", "l", "b", "gl", "gb")
    one = one.join(of_pair, ["host", "parent", "l", "b"], "left").withColumn("gl", F.coalesce("gl", "l")).withColumn("gb", F.coalesce("gb", "b"))
    one = one.join(nodes.select("host", "parent", "of_node"), ["host", "parent"])
    one = one.select("host", "template", F.col("gl").alias("labelled"), F.col("gb").alias("blocked"), smoothed("gb", "gl", F.col("of_node")).alias("purity"))
    return paths.select("host", "typed", "template").join(one, ["host", "template"])


def _groups(templates: DataFrame, tree: Tree) -> DataFrame:
    """``host, parent, l, b, templates, group``: siblings of enough labels, a row for all that have the same, and the number of their
    group. Along rising rates a group goes on while a test of two proportions does not tell a pair from the one before."""
    pairs = templates.filter(F.col("l") >= tree.support).groupBy("host", "parent", "l", "b").agg(F.count("*").alias("templates"))
    along = Window.partitionBy("host", "parent").orderBy(F.col("b") / F.col("l"), "l")
    before_l, before_b = F.lag("l").over(along), F.lag("b").over(along)
    share = (F.col("b") + before_b) / (F.col("l") + before_l)
    error = F.sqrt(share * (1 - share) * (1 / F.col("l") + 1 / before_l))
    # Without variance only equal rates are alike.
    alike = F.abs(F.col("b") / F.col("l") - before_b / before_l) <= F.lit(tree.same) * error
    return pairs.withColumn("new", (~F.coalesce(alike, F.lit(False))).cast("int")).withColumn("group", F.sum("new").over(along)).drop("new")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", label: str | None = None, tree: Tree = Tree()) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and its ``purity``.

    A rule's verdict stands. Other pages are blocked where their template's smoothed purity reaches ``tree.purity``, else allowed. Labels are the column
    ``label`` (1 for blocked, 0 for not), where it is given and not null, else the verdicts of the rules.
    Null and malformed URLs have an empty host and path, no rule, and are judged as the template of these.
    Equal rows get equal verdicts; columns named like the new ones are replaced. An empty table gives no rows.
    """
    host, path = split_url(url)
    ruled = pages.withColumn("__host", host).withColumn("__path", path)
    ruled = ruled.withColumn("__typed", typed_segments(F.col("__path"))).withColumn("__rule", matching_rule(F.col("__host"), F.col("__path"), rules))
    by_rule = F.when(F.col("__rule.action") == "block", 1).when(F.col("__rule").isNotNull(), 0)
    known = by_rule if label is None else F.coalesce(F.col(label).cast("int"), by_rule)
    templates = template_tree(ruled.select(F.col("__host").alias("host"), F.col("__typed").alias("typed"), known.alias("blocked")), tree)
    templates = materialize(templates, "url-verdicts").select(
        F.col("host").alias("__h"), F.col("typed").alias("__t"), F.col("template").alias("__template"), F.col("purity").alias("__purity"),
        (F.col("purity") >= tree.purity).alias("__rejected"))
    out = ruled.join(templates, (F.col("__host") == F.col("__h")) & (F.col("__typed") == F.col("__t")), "left")
    by_tree = F.when(F.col("__rejected"), F.lit("block")).otherwise("allow")
    out = replace_columns(out, {"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__rule.prefix"),
                                "verdict": F.coalesce("__rule.action", by_tree), "template": F.col("__template"), "purity": F.col("__purity")})
    return out.drop("__host", "__path", "__typed", "__rule", "__h", "__t", "__template", "__purity", "__rejected")

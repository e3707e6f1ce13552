"""URL filtering by a tree of path templates per host.

Fixed rules come first. Their verdicts are also the labels the rest is judged by.
Per host, a path's segments are generalised level by level: a segment with a digit
becomes ``{n}``; rare segments of a node become ``*``, but labelled ones only if more than
LEAST of them are labelled and they do not differ, however many there are besides. Where
they don't, unlabelled ones become ``*`` by themselves if there are more than MOST_CHILDREN, which
shortens the table and decides no verdict. Then templates that differ in one segment are merged if each
has LEAST labels of its own and its share of blocked ones does not differ
significantly from that of the whole group. So no branch inherits the labels of one
sibling. What is left are templates; one whose share of blocked labels, smoothed
towards a prior, reaches REJECT is rejected. The prior comes from the nodes above: each
labelled branch of a node is one vote at most, however many pages it has, so that
one blocked section says little of others and many say much; evidence is discounted per level.

The tree is kept as a table of paths with counts, from which each level takes a
few sums by host and node; nothing gathers a host's pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import materialize, table

#: Rare segments that a node may have apart, and members that a merged segment names.
MOST_CHILDREN = 20
#: Share of blocked pages to expect where nothing is known, and how many labelled pages, or votes, a prior is worth.
PRIOR, STRENGTH = 0.2, 4.0
REJECT = 0.5
#: What is left of a node's departure from PRIOR one level further down.
DISCOUNT = 0.75
#: Parts of a vote, so that votes add up alike in any order.
VOTE = 1_000_000
#: Standard errors by which the shares of what is pooled may differ.
SIGMAS = 1.96
#: From so many pages on, a segment is no rare one; from so many labels on, a template's share can be compared.
LEAST = 10
#: Share of a node's labelled segments that may differ from the rest if those are to speak for unlabelled ones.
OUTLIERS = 0.05

# Verdict, host and path of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From there up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(rules, value) -> Column:
    """Of the longest rule that fits host and path; of two as long, the first."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == rule[1]) | F.endswith("host", F.lit("." + rule[1]))) & F.startswith("path", F.lit(rule[2]))
        out = out.when(fits, F.lit(value(rule)))
    return out


def segments(path: Column) -> Column:
    """Generalised segments of a path."""
    return F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.when(x.rlike("[0-9]"), "{n}").otherwise(x))


def _at(level: int) -> Column:
    return F.get("segs", F.lit(level))


def _put(level: int, value: Column) -> Column:
    return F.transform("segs", lambda x, i: F.when(i == level, value).otherwise(x))


def share_of(labelled: Column, blocked: Column, prior: Column) -> Column:
    return (blocked + prior * STRENGTH) / (labelled + STRENGTH)


def apart(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Whether the shares of two (labelled, blocked) differ significantly: a score test with continuity correction."""
    (n, x), (m, y) = [[c.cast("double") for c in pair] for pair in (a, b)]
    gap = F.abs(x * m - y * n) - (n + m) / 2
    return gap > SIGMAS * F.sqrt((x + y) * (n + m - x - y) * n * m / F.greatest(n + m, F.lit(1.0)))


def varying(df: DataFrame, by: list[str], more_than: int) -> list[int]:
    """The levels at which one of these groups has more different segments than that."""
    each = df.select(*by, F.posexplode("segs").alias("level", "seg")).distinct()
    found = each.groupBy(*by, "level").count().filter(F.col("count") > more_than)
    return sorted(r["level"] for r in found.select("level").distinct().collect())


def generalise(paths: DataFrame, level: int) -> DataFrame:
    """Makes one wildcard of a node's rare segments where enough of them are labelled, or where they are very many.

    Unlabelled ones join then. Labelled ones join, and so speak for the others,
    if there are enough of them and they agree: those that differ from the rest
    stay, and if these are many, or what remains scatters more than chance does, all stay.
    """
    node, seg = F.slice("segs", 1, level).alias("node"), _at(level).alias("seg")
    sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
    below = paths.filter(F.size("segs") > level).filter(_at(level) != "{n}")
    rare = below.groupBy("host", node, seg).agg(*sums).filter(F.col("pages") < LEAST)
    totals = rare.groupBy("host", "node").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("labelled") > 0).alias("n_labelled"),
        F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"),
    )
    judged = totals.filter((F.col("n_labelled") > LEAST) | (F.col("n") > MOST_CHILDREN))
    many = rare.join(judged, ["host", "node"])
    rest = (F.col("all_labelled") - F.col("labelled"), F.col("all_blocked") - F.col("blocked"))
    like = (F.col("labelled") > 0) & (F.col("n_labelled") > LEAST) & ~apart((F.col("labelled"), F.col("blocked")), rest)
    many = many.select("host", "node", "seg", "labelled", "blocked", "n_labelled", like.alias("like"))
    # Chi squared over its degrees of freedom, by how much it exceeds its mean.
    share = F.sum("blocked") / F.sum("labelled")
    between = F.sum(F.col("blocked") * F.col("blocked") / F.col("labelled")) - F.sum("blocked") * share
    bound = F.count(F.lit(1)) - 1 + SIGMAS * F.sqrt(2.0 * (F.count(F.lit(1)) - 1))
    enough = (F.count(F.lit(1)) > LEAST) & (F.count(F.lit(1)) >= F.max("n_labelled") * (1 - OUTLIERS))
    chance = between <= bound * share * (1 - share) + 1e-9
    agree = many.filter("like").groupBy("host", "node").agg((enough & chance).alias("agree"))
    joins = (F.col("labelled") == 0) | (F.col("like") & F.coalesce("agree", F.lit(False)))
    wild = many.join(agree, ["host", "node"], "left").filter(joins).select("host", "node", "seg", F.lit(True).alias("wild"))
    joined = paths.withColumns({"node": node, "seg": seg}).join(wild, ["host", "node", "seg"], "left")
    return joined.withColumn("segs", F.when(F.col("wild"), _put(level, F.lit("*"))).otherwise(F.col("segs"))).drop("node", "seg", "wild")


def groups(stats: Column) -> Column:
    """Where the groups begin in a sorted array of (share, labelled, blocked, n): each is compared with the group before it as a whole."""
    start = F.lit(None).cast("struct<labelled:bigint,blocked:bigint,starts:array<struct<share:double,labelled:bigint,blocked:bigint,n:bigint>>>")

    def step(acc: Column, x: Column) -> Column:
        labelled, blocked = x["labelled"] * x["n"], x["blocked"] * x["n"]
        new = acc.isNull() | apart((acc["labelled"], acc["blocked"]), (x["labelled"], x["blocked"]))
        return F.when(
            new, F.struct(labelled.alias("labelled"), blocked.alias("blocked"), F.concat(F.coalesce(acc["starts"], F.array()), F.array(x)).alias("starts"))
        ).otherwise(
            F.struct((acc["labelled"] + labelled).alias("labelled"), (acc["blocked"] + blocked).alias("blocked"), acc["starts"].alias("starts"))
        )

    return F.aggregate(stats, start, step)["starts"]


def merge(known: DataFrame, level: int) -> DataFrame:
    """Makes one of templates that differ in this segment only and are blocked alike.

    ``known`` has host, old, segs, labelled and blocked of templates with enough
    labels. Branches of equal counts can't be apart, so the array that groups are
    found in holds different counts only. A merged segment names at most
    MOST_CHILDREN of its members, the first ones, and how many more it has.
    """
    place = ["host", "before", "after"]
    parts = {"before": F.slice("segs", 1, level), "after": F.slice("segs", level + 2, F.size("segs")), "seg": _at(level)}
    branches = (
        known.filter((F.size("segs") > level) & ~_at(level).isin("*", "{n}"))
        .groupBy("host", *[c.alias(n) for n, c in parts.items()])
        .agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
        .withColumn("share", F.col("blocked") / F.col("labelled"))
    )
    counts = branches.groupBy(*place, "share", "labelled", "blocked").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("share", "labelled", "blocked", "n")))
    starts = counts.groupBy(*place).agg(groups(listed).alias("starts"))
    mine = F.struct("share", "labelled", "blocked")
    reached = F.filter("starts", lambda x: F.struct(x["share"], x["labelled"], x["blocked"]) <= mine)
    named = branches.join(starts, place).withColumn("group", F.size(reached))
    names = named.groupBy(*place, "group").agg(F.array_sort(F.collect_list("seg")).alias("names")).filter(F.size("names") > 1)
    more = F.when(F.size("names") > MOST_CHILDREN, F.concat(F.lit("|+"), F.size("names") - MOST_CHILDREN)).otherwise("")
    label = F.concat(F.lit("{"), F.array_join(F.slice("names", 1, MOST_CHILDREN), "|"), more, F.lit("}"))
    new = named.join(names.select(*place, "group", label.alias("merged")), [*place, "group"]).select(*place, "seg", "merged")
    joined = known.withColumns(parts).join(new, [*place, "seg"], "left")
    return joined.withColumn("segs", F.when(F.col("merged").isNotNull(), _put(level, F.col("merged"))).otherwise(F.col("segs"))).select(
        *known.columns
    )


def prefix(length: Column) -> Column:
    """A hash that stands for the first segments."""
    return F.xxhash64(F.slice("segs", F.lit(1), length), length)


def priors(paths: DataFrame) -> DataFrame:
    """(host, segs, prior): the share of blocked pages to expect by the votes of the branches of all nodes above.

    ``paths`` has host, segs, labelled and blocked. A branch with n labels votes with weight
    n / (n + STRENGTH). From the host down, a node's share is that of its votes, smoothed towards what the node
    above leaves of its own. All levels are made in one pass over the prefixes of paths; a path above many others is
    taken once, and a node gives sums only.
    """
    depth = F.size("segs")
    sums = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    known = paths.groupBy("host", "segs").agg(*sums).filter((F.col("labelled") > 0) & (depth > 0))
    steps = F.transform(F.sequence(F.lit(1), depth), lambda d: F.struct(prefix(d - 1).alias("above"), prefix(d).alias("node")))
    branches = known.select("host", "labelled", "blocked", F.inline(steps)).groupBy("host", "above", "node").agg(*sums)
    weight = F.col("labelled") / (F.col("labelled") + STRENGTH)
    parts = {"votes": weight, "against": weight * F.col("blocked") / F.col("labelled")}
    votes = branches.groupBy("host", F.col("above").alias("node")).agg(
        *[F.sum(F.floor(part * VOTE)).alias(name) for name, part in parts.items()]
    )
    parent = F.slice("segs", F.lit(1), F.greatest(depth - 1, F.lit(0)))
    parents = paths.select("host", parent.alias("segs")).distinct()
    nodes = F.transform(F.sequence(F.lit(0), depth), lambda d: F.struct(d.alias("level"), prefix(d).alias("node")))
    above = parents.select("host", "segs", F.inline(nodes)).join(votes, ["host", "node"], "left")
    counted = [F.coalesce(F.col(c) / VOTE, F.lit(0.0)).alias(c) for c in parts]
    listed = above.groupBy("host", "segs").agg(F.array_sort(F.collect_list(F.struct("level", *counted))).alias("nodes"))

    def down(prior: Column, x: Column) -> Column:
        return PRIOR + DISCOUNT * (share_of(x["votes"], x["against"], prior) - PRIOR)

    found = listed.select("host", F.col("segs").alias("parent"), F.aggregate("nodes", F.lit(PRIOR), down).alias("prior"))
    each = paths.select("host", "segs").distinct().withColumn("parent", parent)
    return each.join(found, ["host", "parent"]).select("host", "segs", "prior")


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, template, purity, n_pages): each generalised path's template and its smoothed share of blocked pages.

    ``pages`` has host, shape (generalised segments) and label (true: blocked, null: not labelled).
    """
    spark = pages.sparkSession
    paths = pages.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("pages"), F.count("label").alias("labelled"), F.count_if("label").alias("blocked")
    )
    paths = materialize(spark, paths.withColumn("segs", F.col("shape")), "url-paths")
    for level in varying(paths, ["host"], LEAST):  # more than LEAST labelled ones are at least as many segments
        paths = materialize(spark, generalise(paths, level), "url-paths")
    counts = [F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
    known = paths.groupBy("host", "segs").agg(*counts[1:]).filter(F.col("labelled") >= LEAST)
    known = materialize(spark, known.select("host", F.col("segs").alias("old"), "segs", "labelled", "blocked"), "url-templates")
    sized = known.withColumn("depth", F.size("segs"))
    for level in reversed(varying(sized, ["host", "depth"], 1)):
        known = materialize(spark, merge(known, level), "url-templates")
    new = known.select("host", F.col("old").alias("segs"), F.col("segs").alias("merged"))
    # Branches vote before they are merged; a merged template takes the least prior of its parts.
    paths = paths.join(priors(paths), ["host", "segs"]).join(new, ["host", "segs"], "left").withColumn("segs", F.coalesce("merged", "segs")).drop("merged")
    paths = materialize(spark, paths, "url-paths")
    sums = paths.groupBy("host", "segs").agg(*counts, F.min("prior").alias("prior"))
    purity = share_of(F.col("labelled"), F.col("blocked"), F.col("prior")).alias("purity")
    rated = sums.select("host", "segs", purity, F.col("pages").alias("n_pages"))
    template = F.concat(F.lit("/"), F.array_join("segs", "/")).alias("template")
    return paths.select("host", "shape", "segs").join(rated, ["host", "segs"]).select("host", "shape", template, "purity", "n_pages")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), a row per row of ``pages``.

    A page that a rule fits gets the rule's verdict, any other that of its template.
    A null url, or one without ``://``, has an empty host and path, which is a
    template like any other. Repeated rows each get the verdict and count each. An
    empty table gives no rows. Reads page_id and url only.
    """
    url = F.col("url")
    read = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = read.withColumns({"rule": rule_column(rules, lambda r: r[1] + r[2]), "_fixed": rule_column(rules, lambda r: r[0])})
    shaped = ruled.withColumns({"shape": segments(F.col("path")), "label": F.col("_fixed") == "block"})
    learned = templates(shaped.select("host", "shape", "label"))
    verdict = F.coalesce("_fixed", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return shaped.join(learned, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))

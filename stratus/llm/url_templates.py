"""URL filter: a rule list, and for all other URLs a path-template tree.

Rules are (host, path prefix) pairs; the longest that fits decides.  URLs that a
rule decides are also the labelled examples of the tree.

Per host, paths are read segment by segment from the root.  Runs of digits in a
segment become ``#``.  Where a node of the tree has many different children for
its pages, its rare children are *generalised* into the wildcard ``*``.  The
other children with labelled examples are graded by their share of blocked
ones; neighbouring grades of a node that do not differ by a two-proportion test
are *merged*, and the children of such a run share one wildcard ``*1``, ``*2``,
... from the cleanest run on.  The template of a page is its path with these
wildcards (a segment that itself starts with ``*`` or a backslash gets a
backslash before it).  A template is rejected if its smoothed purity,
``(blocked + strength * prior) / (labelled + strength)`` with the blocked share
of all labelled pages as the prior, reaches the threshold; pages of templates
without labelled examples stay.  Children without labelled examples are never
merged with labelled ones unless they are rare: a rule against one language of
a host says nothing of its other languages.

The tree has as many levels as the paths: a round steps over the segments that
all paths of a node share and then over one branching, so the rounds are the
branchings on the deepest way down, not the segments.  All counts are
aggregations by host and template prefix (a host with a third of all pages is
summed up before the shuffle), and a node's runs are found among its at most
``GRADES + 1`` grades, so nothing holds a host in one task.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; repeated rows are judged alike; a null id is
carried; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import LOWER, UPPER, small_bytes, written

#: (verdict, host, path prefix): the contract's rules.
RULES = [("block", "net", ""), ("allow", "example.net", "en/"), ("block", "example.com", "de/"), ("allow", "org", "fr/")]
#: A node with at least so many kinds of children, and on average under so many
#: pages to each, has variable children; those with fewer pages than the latter
#: become a wildcard.
MANY_CHILDREN, FEW_PAGES = 8, 4.0
#: Two-proportion test at 95 per cent; purity threshold and smoothing strength.
SIMILAR_Z, PURITY, STRENGTH = 1.96, 0.8, 2.0
#: Grades of a branch's blocked share.
GRADES = 64
#: Tables up to so many bytes of strings are broadcast.
BROADCAST_BYTES = 16 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host (A-Z lower-cased) and the path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: (len(f"{r[1]}/{r[2]}"), r[1:])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        out = F.when(fits, F.struct(F.lit(f"{name}/{prefix}").alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


NODE = ["host", "template"]
PATH = ["host", "shape", "n", "blocked", "labelled"]


def _plain(seg: Column) -> Column:
    """A segment as it stands in a template, told apart from the wildcards."""
    return F.when(seg.rlike(r"^[*\\]"), F.concat(F.lit("\\"), seg)).otherwise(seg)


def _past_shared(paths: DataFrame) -> DataFrame:
    """``paths`` with the segments that all paths of a node share moved from
    ``rest`` to the template: those that its least and its greatest share."""
    ends = paths.groupBy(*NODE).agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"))
    differ = F.array_position(F.zip_with("lo", "hi", lambda a, b: ~a.eqNullSafe(b)), True)
    shared = F.when(differ > 0, differ - 1).otherwise(F.size("lo")).cast("int")
    ends = small_bytes(written(ends.select(*NODE, shared.alias("shared")), "shared"), NODE, BROADCAST_BYTES)
    steps = F.transform(F.slice("rest", F.lit(1), F.col("shared")), lambda x: F.concat(F.lit("/"), _plain(x)))
    return written(paths.join(ends, NODE).select(
        *PATH, F.concat("template", F.array_join(steps, "")).alias("template"),
        F.slice("rest", F.col("shared") + 1, F.size("rest")).alias("rest")), "shared_paths")


def _runs(children: DataFrame) -> DataFrame:
    """``host template grade run members``: grades of a node's branches in runs
    of neighbours that do not differ."""
    grades = children.where("grade is not null").groupBy(*NODE, "grade").agg(
        F.sum("blocked").alias("b"), F.sum("labelled").alias("l"), F.count(F.lit(1)).alias("kinds"))
    order = Window.partitionBy(*NODE).orderBy("grade")
    b0, l0 = F.lag("b").over(order), F.lag("l").over(order)
    pooled = (F.col("b") + b0) / (F.col("l") + l0)
    spread = F.sqrt(pooled * (1 - pooled) * (F.lit(1) / F.col("l") + F.lit(1) / l0))
    apart = F.abs(F.col("b") / F.col("l") - b0 / l0) > SIMILAR_Z * spread
    runs = grades.withColumn("apart", F.coalesce(apart.cast("int"), F.lit(1))).withColumn("run", F.sum("apart").over(order))
    return runs.select(*NODE, "grade", "run", F.sum("kinds").over(Window.partitionBy(*NODE, "run")).alias("members"))


def _past_branching(paths: DataFrame) -> DataFrame:
    """``paths`` with the first segment of ``rest``, or the wildcard that stands
    for it, moved to the template."""
    paths = paths.withColumn("seg", F.get("rest", F.lit(0)))
    children = written(paths.groupBy(*NODE, "seg").agg(
        *[F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]), "children")
    about = children.groupBy(*NODE).agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all_n"))
    variable = (F.col("kinds") >= MANY_CHILDREN) & (F.col("all_n") < F.col("kinds") * FEW_PAGES) & (F.col("n") < FEW_PAGES)
    grade = F.when(~F.col("variable") & (F.col("labelled") > 0), F.expr(f"blocked * {GRADES} div labelled"))
    children = written(children.join(about, NODE).withColumn("variable", variable).withColumn("grade", grade)
                       .select(*NODE, "seg", "blocked", "labelled", "variable", "grade"), "graded")
    shown = (F.when(F.col("variable"), "*").when(F.col("members") > 1, F.concat(F.lit("*"), F.col("run").cast("string")))
             .otherwise(_plain(F.col("seg"))))
    named = written(children.join(_runs(children), [*NODE, "grade"], "left").select(*NODE, "seg", shown.alias("shown")), "named")
    named = small_bytes(named, [*NODE, "seg", "shown"], BROADCAST_BYTES)
    return written(paths.join(named, [*NODE, "seg"]).select(
        *PATH, F.concat("template", F.lit("/"), "shown").alias("template"),
        F.slice("rest", F.lit(2), F.size("rest")).alias("rest")), "branched_paths")


def path_templates(paths: DataFrame) -> DataFrame:
    """``paths(host, shape, n, blocked, labelled)``, one row per host and masked
    path, with the columns template and rejected."""
    segments = F.split(F.regexp_replace("shape", "^/", ""), "/")
    going = paths.select(*PATH, F.lit("").alias("template"),
                         F.when(F.col("shape") != "", segments).otherwise(F.array().cast("array<string>")).alias("rest"))
    open_ = F.size("rest") > 0
    done = [going.where(~open_)]
    going = going.where(open_)
    while not going.isEmpty():
        for step in (_past_shared, _past_branching):
            going = step(going)
            done.append(going.where(~open_))
            going = going.where(open_)
    tree = done[0]
    for part in done[1:]:
        tree = tree.unionByName(part)
    tree = written(tree.drop("rest"), "templates")
    judged = tree.groupBy(*NODE).agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
    prior = tree.agg(F.try_divide(F.sum("blocked"), F.sum("labelled")).alias("p")).first()[0] or 0.0
    purity = (F.col("blocked") + STRENGTH * prior) / (F.col("labelled") + STRENGTH)
    judged = judged.select(*NODE, ((F.col("labelled") > 0) & (purity >= PURITY)).alias("rejected"))
    return tree.join(judged, NODE).select("host", "shape", "template", "rejected")


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and template of every page."""
    host, path = host_and_path(F.col("url"))
    read = pages.select("page_id", host.alias("host"), path.alias("path"))
    read = read.withColumn("hit", longest_rule(F.col("host"), F.col("path"), rules))
    read = read.withColumn("shape", F.regexp_replace("path", "[0-9]+", "#"))
    paths = written(read.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("hit").alias("labelled"),
        F.count(F.when(F.col("hit.verdict") == "block", 1)).alias("blocked")), "paths")
    judged = small_bytes(written(path_templates(paths), "judged"), ["host", "shape", "template"], BROADCAST_BYTES)
    return read.join(judged, ["host", "shape"]).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template")

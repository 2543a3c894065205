"""Filtering of URLs by a tree of path templates per host.

Paths become templates: numbers and hexadecimal names in a segment are wildcards, and so is
a segment that takes too many values below its parent. Labelled siblings that a test of their
counts cannot tell apart are merged into one branch. A template's share of blocked pages is
smoothed towards the branch above and towards what other hosts have on the same shape, so that
templates without a labelled page of their own are judged, too. From which share a template is
rejected is found on hosts whose labels were hidden.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.batches import stored

#: Segments of a path that are levels of the tree; what follows is one level more.
DEPTH = 6
#: A segment is variable if so many values occur below one parent, each on so few pages.
MANY_VALUES, PAGES_PER_VALUE = 20, 3.0
#: Siblings differ if the angles of their shares are so many deviations apart, and how often
#: a group of siblings is tested.
CHANCE, TESTS = 2.0, 2
#: Pages that the share of the branch above, and the labels of one other host, count as.
PRIOR_PAGES = 5.0
#: One host in so many is hidden to choose the bound among these, for a purity of so much.
FOLDS, PURE = 3, 0.9
BOUNDS = [round(0.5 + 0.05 * i, 2) for i in range(10)]
#: The bound where no label can be hidden.
REJECT_FROM = 0.8
#: A template's row in the join is repeated so often; its pages are dealt among them.
SALTS = 16

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and paths that begin like the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower-case A-Z, and the path; both empty without."""
    parts = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), CAPITALS, SMALL)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, ``rule`` and ``given``, the text and verdict of the longest rule
    that fits, else null."""
    host, path = host_and_path(F.col("url"))
    split = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = rule.fits(F.col("host"), F.col("path"))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return split.withColumns({"rule": text, "given": verdict})


def shape(path: Column) -> Column:
    """Segments of a path with numbers and hexadecimal names as wildcards; those beyond
    ``DEPTH`` are one segment."""
    segments = F.split(path, "/")
    folded = F.transform(
        segments,
        lambda s: F.when(s.rlike("^[0-9a-f-]{8,}$"), F.lit("{x}")).otherwise(
            F.regexp_replace(s, "[0-9]+", "{n}")
        ),
    )
    tail = F.array(F.concat_ws("/", F.slice(folded, DEPTH + 1, 1_000_000)))
    long = F.size(folded) > DEPTH
    return F.when(long, F.concat(F.slice(folded, 1, DEPTH), tail)).otherwise(folded)


def _branch(level: Column) -> Column:
    return F.slice("template", F.lit(1), level)


def _to_each(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a frame of one row per key; the rows of one key are dealt among ``SALTS``."""
    copies = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", dealt).join(copies, [*keys, "salt"], how).drop("salt")


def shapes(judged: DataFrame) -> DataFrame:
    """A row per (host, shape): its pages, and how many are labelled and blocked."""
    return judged.select(
        "host", shape(F.col("path")).alias("shape"),
        (F.col("given") == "block").cast("bigint").alias("blocked"),
    ).groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("pages"), F.count("blocked").alias("labelled"),
        F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"),
    )


def shares(counted: DataFrame) -> DataFrame:
    """For each (host, shape) its template and the template's smoothed ``share`` of blocked
    pages, from ``shapes``."""
    return _grown(counted.withColumn("tree", F.lit("whole"))).drop("tree")


def _grown(rows: DataFrame) -> DataFrame:
    """Templates and shares of several trees, told apart by ``tree``: templates one level after
    the other, shares of all levels at once. All paths begin alike, with an empty first segment."""
    totals = rows.groupBy("tree").agg(
        F.sum("blocked").alias("bad"), F.sum("labelled").alias("all"),
        F.max(F.size("shape")).alias("depth"),
    ).collect()  # a row per tree
    base = F.lit(0.0)
    for row in totals:
        base = F.when(F.col("tree") == row.tree, row.bad / row.all if row.all else 0.0).otherwise(base)
    depth = max((row.depth for row in totals), default=0)
    rows = rows.withColumn("template", F.col("shape"))
    for level in range(2, depth + 1):
        rows = stored(_generalised(rows, level), "level")
    return stored(_smoothed(rows, depth, base), "share")


def _both(counted: DataFrame) -> DataFrame:
    """The tree of all labels, and the one made with the labels of one host in ``FOLDS`` hidden;
    ``known`` and ``bad`` are the labelled and blocked pages with nothing hidden."""
    hidden = F.pmod(F.xxhash64("host"), F.lit(FOLDS)) == 0
    twice = counted.withColumns({
        "known": F.col("labelled"), "bad": F.col("blocked"), "hidden": hidden,
        "tree": F.explode(F.array(F.lit("whole"), F.lit("part"))),
    })
    hide = (F.col("tree") == "part") & F.col("hidden")
    return _grown(twice.withColumns({
        name: F.when(hide, F.lit(0)).otherwise(F.col(name)).cast("bigint")
        for name in ("labelled", "blocked")
    }))


def _tested(both: DataFrame) -> DataFrame:
    return both.where("tree = 'part' and hidden and known > 0")


def _bound(both: DataFrame) -> float:
    sums = [F.sum(F.when(F.col("share") >= b, F.col(c))) for b in BOUNDS for c in ("known", "bad")]
    row = _tested(both).agg(F.sum("known"), *sums).first()
    if not row[0]:
        return REJECT_FROM
    for place, least in enumerate(BOUNDS):
        known, bad = row[1 + 2 * place] or 0, row[2 + 2 * place] or 0
        if known and bad >= PURE * (known + 1):
            return least
    return 2.0


def held_out(counted: DataFrame) -> DataFrame:
    """``known`` and ``bad``, labelled and blocked pages, of the labelled shapes of one host in
    ``FOLDS``, with the ``share`` that the tree gives them when these labels are hidden."""
    return _tested(_both(counted))


def bound(counted: DataFrame) -> float:
    """The least share from which templates are rejected: the lowest of ``BOUNDS`` from which
    on at least ``PURE`` of the hidden labels, with one more that does not, say block. If there
    is none, no template is rejected (2.0). Without hidden labels it is ``REJECT_FROM``."""
    return _bound(_both(counted))


def templates(judged: DataFrame) -> DataFrame:
    """For each (host, shape) its template, the template's share, and whether it is rejected."""
    both = _both(stored(shapes(judged), "shapes"))
    return both.where("tree = 'whole'").select(
        "host", "shape", "template", "share", (F.col("share") >= _bound(both)).alias("rejected")
    )


def _angle(blocked: Column, labelled: Column) -> Column:
    return 2 * F.asin(F.sqrt(blocked / labelled))


def _sign(blocked: Column, labelled: Column, all_blocked: Column, all_labelled: Column) -> Column:
    """How a child differs from its labelled siblings together: ``-`` blocked less, ``+`` more
    often than chance allows, ``=`` neither, nothing without such siblings."""
    others = all_labelled - labelled
    apart = (_angle(blocked, labelled) - _angle(all_blocked - blocked, others)) / F.sqrt(
        1 / labelled + 1 / others
    )
    return F.when(others == 0, "").when(apart > CHANCE, "+").when(apart < -CHANCE, "-").otherwise("=")


def _siblings(keyed: DataFrame) -> DataFrame:
    """The children of each parent that are variable or labelled, with their ``group`` after
    the first test. Children are counted before they meet their parent's sums."""
    parent = ["tree", "host", "parent"]
    children = keyed.where("segment is not null").groupBy(*parent, "segment").agg(
        *[F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
    )
    parents = children.groupBy(*parent).agg(
        F.count(F.lit(1)).alias("values"), F.sum("pages").alias("all_pages"),
        F.sum("labelled").alias("all"), F.sum("blocked").alias("bad"),
    )
    variable = (F.col("values") >= MANY_VALUES) & (
        F.col("all_pages") <= PAGES_PER_VALUE * F.col("values")
    )
    sign = _sign(F.col("blocked"), F.col("labelled"), F.col("bad"), F.col("all"))
    return _to_each(children, parents, parent).withColumn("variable", variable).where(
        "variable or labelled > 0"
    ).select(
        *parent, "segment", "labelled", "blocked", "variable",
        F.when(F.col("variable"), "*").otherwise(F.concat(F.lit("*"), sign)).alias("group"),
    )


def _generalised(rows: DataFrame, level: int) -> DataFrame:
    """The segment of one level made a wildcard where it is variable, and a wildcard with a
    sign where labelled siblings are alike: those that differ from all their labelled
    siblings together by chance only (``*=``), and those that are blocked less (``*-``) or more
    often (``*+``) than chance allows. Each of the three is tested within itself again."""
    keyed = rows.withColumns({
        "parent": _branch(F.lit(level - 1)), "segment": F.get("template", F.lit(level - 1))
    })
    group = ["tree", "host", "parent", "group"]
    siblings = stored(_siblings(keyed), "siblings")
    tested = siblings.where("not variable")
    for _ in range(TESTS - 1):
        sums = tested.groupBy(*group).agg(F.sum("labelled").alias("all"), F.sum("blocked").alias("bad"))
        sign = _sign(F.col("blocked"), F.col("labelled"), F.col("bad"), F.col("all"))
        tested = _to_each(tested, sums, group).withColumn("group", F.concat("group", sign)).drop(
            "all", "bad"
        )
    members = tested.groupBy(*group).agg(F.count(F.lit(1)).alias("members"))
    merged = _to_each(tested, members, group).where("members > 1")
    wild = siblings.where("variable").unionByName(merged.drop("members")).select(
        "tree", "host", "parent", "segment", F.col("group").alias("wild")
    )
    found = _to_each(keyed, wild, ["tree", "host", "parent", "segment"], "left")
    changed = F.concat(
        F.slice("template", 1, level - 1), F.array("wild"),
        F.slice("template", level + 1, DEPTH + 2),
    )
    template = F.when(F.col("wild").isNotNull(), changed).otherwise(F.col("template"))
    return found.withColumn("template", template).drop("parent", "segment", "wild")


def _smoothed(rows: DataFrame, depth: int, base: Column) -> DataFrame:
    """``share`` of each row's template, from the root (``base``) down. At each level the share
    of the branch above counts as ``PRIOR_PAGES``; then come the labels that other hosts have on
    the same shape up to this level, each host's as so many pages at most; then the branch's
    own. Shapes of one branch share the others' labels in proportion to their pages.

    What a branch needs but the share above it is summed for all levels together; each row
    then has one entry per level and works down its own path."""
    keyed = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumns({
        "branch": _branch(F.col("level")), "prefix": F.slice("shape", F.lit(1), F.col("level"))
    })
    own = keyed.groupBy("tree", "level", "host", "branch", "prefix").agg(
        *[F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
    ).withColumn("told", F.least(F.col("labelled"), F.lit(PRIOR_PAGES)))
    own = own.withColumn(
        "bad", F.when(F.col("labelled") > 0, F.col("told") * F.col("blocked") / F.col("labelled"))
        .otherwise(F.lit(0.0))
    )
    everywhere = own.groupBy("tree", "level", "prefix").agg(
        F.sum("told").alias("all_told"), F.sum("bad").alias("all_bad")
    )
    branch = ["tree", "level", "host", "branch"]
    branches = _to_each(own, everywhere, ["tree", "level", "prefix"]).groupBy(*branch).agg(
        F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"),
        *[
            (F.sum(F.col("pages") * (F.col(f"all_{c}") - F.col(c))) / F.sum("pages")).alias(c)
            for c in ("told", "bad")
        ],
    ).select(*branch, F.struct("level", "blocked", "labelled", "told", "bad").alias("step"))

    def below(above: Column, step: Column) -> Column:
        prior = (step["bad"] + PRIOR_PAGES * above) / (step["told"] + PRIOR_PAGES)
        return F.round((step["blocked"] + PRIOR_PAGES * prior) / (step["labelled"] + PRIOR_PAGES), 9)

    steps = _to_each(keyed.drop("prefix"), branches, branch).groupBy(*rows.columns).agg(
        F.array_sort(F.collect_list("step")).alias("steps")
    )
    return steps.withColumn("share", F.aggregate("steps", base, below)).drop("steps")


def filtered(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every page's host, path, rule, ``verdict``, template and its share.

    The verdict is the rule's, else ``block`` for pages of rejected templates and ``allow``
    for all others. Pages without a URL or host have an empty host and are judged like the
    others; repeated rows count and are returned each; an empty table gives no rows; other
    columns of the pages are not read. Without any rule that fits, all are allowed.
    """
    judged = stored(ruled(pages, rules).withColumn("shape", shape(F.col("path"))), "ruled")
    joined = _to_each(judged, templates(judged), ["host", "shape"])
    verdict = F.coalesce("given", F.when(F.col("rejected"), "block").otherwise("allow"))
    return joined.select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"),
        F.concat_ws("/", "template").alias("template"), "share",
    )

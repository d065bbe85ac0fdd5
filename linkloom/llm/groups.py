"""Consolidating pairwise matches into groups by low-diameter decomposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import HOT_PARTS, HOT_ROWS, look_up
from ..session import materialize, materialize_with

BETA = 0.05  # rate of the exponential shifts: an edge is cut with about this probability, and clusters grow some log(n) / BETA steps at most
STEPS = 4  # steps of growth between two writes
GROWING = 0.01  # a round ends when no more than this share of the vertices grew in a step


def _shift(vertex: Column | str, level: int, beta: float) -> Column:
    """Exponential shift of a vertex, the same wherever it is computed."""
    v = F.col(vertex) if isinstance(vertex, str) else vertex
    u = (F.pmod(F.xxhash64(v, F.lit(level)), F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(beta)


def connected_groups(pairs: DataFrame, a: str, b: str, beta: float = BETA, steps: int = STEPS, growing: float = GROWING, max_rounds: int = 200) -> DataFrame:
    """Group the records that ``pairs`` link directly or through others.

    Returns (``member``, ``group``): every value that occurs in a pair of two
    different non-null values, with the smallest member of its group. Pairs
    with a null or of a value with itself tie nothing; repeated and reversed
    pairs count once; an empty input gives an empty result. Extra columns are
    ignored. ``a`` and ``b`` need one orderable type.

    Each round is one low-diameter decomposition: vertex v starts a cluster at
    time -shift(v), clusters grow one step at a time until no more than a
    share of ``growing`` of the vertices changes (0: until none does), and a
    vertex joins the cluster that reaches it first, which is the one with the
    largest shift(centre) - distance. Clusters contract to super-vertices,
    edges between clusters go to the next round, and the assignments of all
    rounds are composed at the end. What still grew, as the far ends of a few
    long chains, is left to the next round, where it is shorter. ``steps``
    steps of growth are one job; the data of each are written to the shared
    folder.
    """
    kind = pairs.schema[a].dataType
    edges = pairs.select(F.col(f"`{a}`").alias("u"), F.col(f"`{b}`").cast(kind).alias("v")).where("u <> v")
    edges = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    edges, seen = materialize_with(edges, n=F.count(F.lit(1)))
    levels: list[DataFrame] = []
    while seen["n"]:
        if len(levels) >= max_rounds:
            raise RuntimeError(f"edges are left after {max_rounds} rounds")
        labels, edges, seen = _decompose(edges, seen["n"], len(levels), beta, steps, growing)
        levels.append(labels)
    if not levels:
        return edges.select(F.col("u").alias("member"), F.col("v").alias("group"))
    done = levels[-1]
    for labels in reversed(levels[:-1]):
        up = done.select(F.col("vertex").alias("cluster"), F.col("cluster").alias("__top"))
        done = look_up(labels, "cluster", up).select("vertex", F.coalesce("__top", "cluster").alias("cluster"))
        done = materialize(done)
    least = done.groupBy("cluster").agg(F.min("vertex").alias("group"))
    return look_up(done, "cluster", least, "inner").select(F.col("vertex").alias("member"), "group")


def _decompose(edges: DataFrame, n: int, level: int, beta: float, steps: int, growing: float) -> tuple[DataFrame, DataFrame, dict]:
    """(vertex, cluster) when growth has ended, the edges between clusters, each once, and their number."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # The first step needs no join: the neighbours' shifts follow from their names.
    near, own = _shift("v", level, beta) - 1, _shift("u", level, beta)
    first = both.groupBy("u").agg(F.max_by("v", near).alias("c"), F.max(near).alias("r"), F.count(F.lit(1)).alias("degree"))
    better = F.col("r") > own
    labels = first.select(F.col("u").alias("vertex"), F.when(better, F.col("c")).otherwise(F.col("u")).alias("cluster"), F.greatest("r", own).alias("reach"), "degree")
    labels, seen = materialize_with(labels, most=F.max("degree"), n=F.count(F.lit(1)))
    few = growing * seen["n"]
    # degrees add up to 2 n, so few vertices can be hot
    least = max(HOT_ROWS, 2 * n / HOT_PARTS)
    hot = [r.vertex for r in labels.where(F.col("degree") >= least).select("vertex").collect()] if seen["most"] >= least else []
    around = both.select("u", "v", F.lit(1.0).alias("way")).unionByName(labels.select(F.col("vertex").alias("u"), F.col("vertex").alias("v"), F.lit(0.0).alias("way")))
    grown = few + 1
    while grown > few:  # at each step a vertex looks at its neighbours and itself
        for _ in range(steps):
            near = look_up(around, "v", labels.select(F.col("vertex").alias("v"), "cluster", "reach"), "inner", hot=hot)
            reach = F.col("reach") - F.col("way")
            labels = near.groupBy(F.col("u").alias("vertex")).agg(F.max_by("cluster", reach).alias("cluster"), F.max(reach).alias("reach"), F.max(F.when(F.col("way") == 0, F.col("reach"))).alias("before"))
        labels, seen = materialize_with(labels, grown=F.count_if(F.col("reach") > F.col("before")))
        grown = seen["grown"]  # in the last of the steps
    left = look_up(edges, "u", labels.select(F.col("vertex").alias("u"), F.col("cluster").alias("cu")), "inner", hot=hot)
    right = look_up(left.select("cu", "v"), "v", labels.select(F.col("vertex").alias("v"), F.col("cluster").alias("cv")), "inner", hot=hot)
    between = right.where("cu <> cv").select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v"))
    return labels.select("vertex", "cluster"), *materialize_with(between.distinct(), n=F.count(F.lit(1)))


def title_key(title: Column) -> Column:
    """The name of a title: no fragment, "_" as a space, single spaces, trimmed, first letter upper-cased."""
    s = F.trim(F.regexp_replace(F.translate(F.substring_index(title, "#", 1), "_", " "), " +", " "))
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))


def page_pairs(pages: DataFrame, page_id: str = "page_id", title: str = "title", redirect: str = "redirect") -> DataFrame:
    """(``a``, ``b``): ties between pages through a common title or redirect target.

    All pages that bear or point to one title are tied to the smallest
    ``page_id`` among them, so there are no more ties than pages and redirects.
    Pages with a null title or id are left out.
    """
    pages = pages.where(F.col(title).isNotNull() & F.col(page_id).isNotNull())
    bears = pages.select(F.col(page_id).alias("b"), title_key(F.col(title)).alias("key"))
    points = pages.where(F.trim(F.col(redirect)) != "").select(F.col(page_id).alias("b"), title_key(F.col(redirect)).alias("key"))
    touches = materialize(bears.unionByName(points))
    first = touches.groupBy("key").agg(F.min("b").alias("a"), F.max("b").alias("__last"))
    first = first.where(F.col("a") < F.col("__last")).drop("__last")
    return look_up(touches, "key", first, "inner").where("a < b").select("a", "b")

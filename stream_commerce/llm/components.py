"""Connected components and bucket candidates, both by joins and grouping.

`components` is the alternating large-star / small-star contraction: every node is linked to its
smallest neighbour until only stars are left. A hub with many links is grouped with map-side
combine, so no task holds all its neighbours.

`linked` turns bucket rows (key, node) into verified components without emitting all pairs of a
bucket: members meet a few hubs of the bucket first. Only buckets that still hold several components
are looked at again: those of at most `FEW` members pair by pair (so pairs grow as rows do), the
members of larger ones by an exact prefix filter over their sets.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stream_commerce.llm.shared import saved

FEW = 32
#: So many pairs for each set are confirmed at once.
PART_PAIRS = 2
SALTS = (0, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and all its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("w")).select(
        F.col("u").alias("x"), F.least("u", "w").alias("m")
    )
    return edges.join(least, F.col("u") == F.col("x")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    ).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge points from the larger to the smaller end here.
    rows = _with_least(edges)
    return rows.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        rows.select("u", F.col("m").alias("v"))
    ).filter("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one link and is no smaller end of another."""
    twice = edges.groupBy("u").count().filter("count > 1").select("u")
    inner = edges.select("u").join(edges.select(F.col("v").alias("w")), F.col("u") == F.col("w"), "left_semi")
    return twice.unionByName(inner).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node on an edge (u, v) of longs.

    The component is its smallest node. Loops and repeated or reversed edges count once, edges
    with a null end not at all; no edges give no rows.
    """
    now = saved(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"),
                     (F.col("u") < F.col("v")).isNotNull().alias("whole"))
        .filter("whole and u <> v").select("u", "v").distinct(), "edges")
    while not _stars(now):
        now = saved(_small_star(_large_star(now)), "stars")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def _shared(rows: DataFrame, once: bool) -> DataFrame:
    """The rows (key, node) of buckets with several nodes. Buckets are counted map-side first and joined back, so
    that of a bucket that holds much of the table no task has all rows: Spark splits a join, not a window."""
    counts = [F.count("*").alias("n")] if once else [F.min("node").alias("low"), F.max("node").alias("high")]
    open_keys = rows.groupBy("key").agg(*counts).filter("n > 1" if once else "low <> high").select(F.col("key").alias("k"))
    return rows.join(open_keys, F.col("key") == F.col("k"), "left_semi").select("key", "node")


def _hub_pairs(rows: DataFrame, salts: tuple[int, ...]) -> DataFrame:
    """Every member of a bucket with the bucket's hubs, the smallest nodes after a bit flip each."""
    least = [F.min(F.col("node").bitwiseXOR(F.lit(x))).bitwiseXOR(F.lit(x)) for x in salts]
    hubs = rows.groupBy("key").agg(F.array_distinct(F.array(*least)).alias("hubs")).withColumnRenamed("key", "k")
    met = rows.join(hubs, F.col("key") == F.col("k")).select("node", F.explode("hubs").alias("hub"))
    return met.filter("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Bucket rows with their component, a node without links being its own."""
    names = found.withColumnRenamed("node", "x")
    return rows.join(names, F.col("node") == F.col("x"), "left").select(
        "key", "node", F.coalesce("component", "node").alias("own"))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links (a, b): only components that a link joins are contracted anew."""
    ends = links.select(F.col("a").alias("node"), "b")
    for _ in range(2):  # first a, then b gets the name of its component
        names = found.withColumnRenamed("node", "x")
        ends = ends.join(names, F.col("node") == F.col("x"), "left").select(
            F.col("b").alias("node"), F.coalesce("component", "node").alias("b"))
    joined = components(ends.select(F.col("node").alias("u"), F.col("b").alias("v")))
    known = found.join(joined.withColumnRenamed("node", "x").withColumnRenamed("component", "c"),
                       F.col("component") == F.col("x"), "left").select("node", F.coalesce("c", "component").alias("component"))
    fresh = joined.join(found.select(F.col("node").alias("x")), F.col("node") == F.col("x"), "left_anti")
    return saved(known.unionByName(fresh), "components")


def linked(
    rows: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, more_edges: DataFrame | None = None,
    hashes: Callable[[Column], Column] = lambda held: held, once: bool = False,
) -> DataFrame:
    """(node, component) from bucket rows (key, node), all longs.

    `sets` gives (node, held) of the nodes it gets, which are those of any shared bucket, and `hashes` makes the set,
    an array<long>, of a `held`: where that is smaller than the set, less is written and shuffled. With `once` a node
    comes once in a bucket, and buckets are told by counts, which shuffle smaller.
    `percent` is the least Jaccard similarity of a link, held against full sets. `more_edges` (u, v) are
    links known beforehand. A pair of one bucket goes unverified only if its ends are already in one
    component or `prefix_pairs` rules it out.
    """
    rows = saved(_shared(rows, once), "buckets")
    held = saved(sets(rows.select("node").distinct()).withColumn("n", F.size(hashes(F.col("held")))), "sets")
    tried = saved(_hub_pairs(rows, SALTS), "pairs")
    edges = _verified(tried, held, percent, hashes).select(F.col("a").alias("u"), F.col("b").alias("v"))
    if more_edges is not None:
        edges = edges.unionByName(more_edges.select("u", "v"))
    found = saved(components(edges), "components")
    named = _named(rows, found)
    open_keys = named.groupBy("key").agg(
        F.min("own").alias("low"), F.max("own").alias("high"), F.count("*").alias("n")
    ).filter("low <> high").select(F.col("key").alias("k"), "n")
    left = saved(named.join(open_keys, F.col("key") == F.col("k")).select("key", "node", "own", "n"), "open")
    if left.isEmpty():
        return found
    few, many = left.filter(F.col("n") <= FEW), left.filter(F.col("n") > FEW).select("node", "own").distinct()
    own = many.select(F.col("node").alias("x"))
    other = few.select(F.col("key").alias("k"), F.col("node").alias("b"), F.col("own").alias("o"))
    direct = few.join(other, (F.col("key") == F.col("k")) & (F.col("node") < F.col("b")) & (F.col("own") != F.col("o"))).select(
        F.col("node").alias("a"), "b").distinct()
    own_sets = held.join(own, F.col("node") == F.col("x"), "left_semi").select("node", hashes(F.col("held")).alias("hashes"))
    fresh = direct.unionByName(prefix_pairs(many, own_sets, percent))
    fresh = saved(fresh.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    if fresh.isEmpty():
        return found
    more = saved(_verified(fresh, held, percent, hashes), "links")
    return found if more.isEmpty() else _merged(found, more)


def _verified(pairs: DataFrame, held: DataFrame, percent: int, hashes: Callable[[Column], Column]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; a node may have several sets."""
    # Sets of too different sizes cannot be similar; that takes only their sizes. Both sides of a join have columns
    # of the same form, so that Spark shuffles them once.
    sizes = held.select("node", F.col("n").alias("size"))
    sized = pairs.join(sizes.select(F.col("node").alias("x"), F.col("size").alias("m")), F.col("a") == F.col("x")).join(
        sizes.select(F.col("node").alias("y"), F.col("size").alias("n")), F.col("b") == F.col("y"))
    pairs = saved(sized.filter(F.least("m", "n") * 100 >= F.greatest("m", "n") * percent).select("a", "b").distinct(), "sized")
    one = held.select(F.col("node").alias("x"), F.col("held").alias("p"), F.col("n").alias("m"))
    two = held.select(F.col("node").alias("y"), F.col("held").alias("q"), F.col("n").alias("k"))
    # Each pair takes what a node holds along, so many pairs are looked at one part after the other.
    parts = max(1, -(-pairs.count() // max(1, PART_PAIRS * held.count())))
    found = []
    for part in range(parts):
        some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == part) if parts > 1 else pairs
        full = some.join(one, F.col("a") == F.col("x")).join(two, F.col("b") == F.col("y"))
        counted = full.select(
            "a", "b", F.size(F.array_intersect(hashes(F.col("p")), hashes(F.col("q")))).alias("common"), (F.col("m") + F.col("k")).alias("both"))
        linked_ = counted.filter(F.col("common") * 100 >= (F.col("both") - F.col("common")) * percent).select("a", "b").distinct()
        found.append(saved(linked_, "confirmed") if parts > 1 else linked_)
    return reduce(DataFrame.unionByName, found)


def prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of different components that may be linked.

    Two sets of similarity p share at least one of their rarest n - ceil(p n) + 1 elements, if both are
    sorted by one global order, and the first shared one leaves room for enough others behind it.
    Elements of one set only are rarest, so a set with many of its own meets nobody. `nodes` has
    (node, own): its component.
    """
    items = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    often = items.groupBy("h").agg(F.count("*").alias("df"), F.max("n"), F.max("node")).filter("df > 1").select(
        F.col("h").alias("g"), "df")
    met = items.join(often, F.col("h") == F.col("g"))
    one = Window.partitionBy("node")
    place = F.col("n") - F.count("*").over(one) + F.row_number().over(one.orderBy("df", "h"))
    least = F.ceil(F.col("n") * percent / 100)
    front = met.withColumn("place", place).filter(F.col("place") <= F.col("n") - least + 1).select("node", "n", "h", "place")
    named = nodes.select(F.col("node").alias("x"), "own")
    front = saved(front.join(named, F.col("node") == F.col("x")).select("node", "n", "h", "place", "own"), "prefixes")
    # Of a pair of components at least one is not the largest at this element.
    parts = front.groupBy("h", "own").agg(F.count("*").alias("size"))
    top = parts.groupBy("h").agg(F.count("*").alias("parts"), F.max(F.struct("size", "own")).alias("top")).filter(
        "parts > 1").select(F.col("h").alias("g"), F.col("top.own").alias("largest"))
    small = front.join(top, F.col("h") == F.col("g")).filter("own <> largest").select(
        F.col("node").alias("p"), F.col("n").alias("m"), F.col("h").alias("g"), F.col("place").alias("at"), F.col("own").alias("o"))
    # At the first element both have, all others they share come later in either.
    most = 1 + F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at"))
    close = most * (100 + percent) >= percent * (F.col("n") + F.col("m"))
    met = small.join(front, (F.col("h") == F.col("g")) & (F.col("own") != F.col("o")) & close)
    return met.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()

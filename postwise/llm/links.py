"""Candidate pairs of key groups, and connected components, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postwise.llm.common import discard, materialise, sweep
#: Members of a group that its central member is not linked to: up to FEW are compared with
#: all others of the group at once; of more, PIVOTS are first, then all that is left unconnected.
FEW, PIVOTS = 8, 2


def shared_keys(rows: DataFrame) -> DataFrame:
    """The rows (key, id), two numbers each, whose key several ids share, with n (group size).

    Counted with partial aggregation; the join back has one row per key on one
    side, so a hot key can be split.
    """
    groups = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(groups, "key")


def leader_pairs(shared: DataFrame, carry: tuple[str, ...] = (), whole_groups: bool = False) -> DataFrame:
    """Each member (id, carry) with its group's central member (_id, _carry).

    With ``whole_groups`` a group's members are sent to one task, once, instead of once for the centre and once for
    the pairs: for groups that are many and small.

    The central member is the one with the most fellows over all of its groups (at
    equal numbers by a hash): in a group of copies of one original, the original.
    """
    fellows = shared.groupBy("id").agg(F.sum("n").alias("f"))
    rank = F.col("f") * (1 << 20) + F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    if whole_groups:
        members = shared.join(fellows, "id").select("key", "id", *carry, rank.alias("f"))
        members = members.withColumn("c", F.max(F.struct("f", "id", *carry)).over(Window.partitionBy("key"))).filter("id <> c.id")
        return members.select(*[x for c in ("id", *carry) for x in (c, F.col(f"c.{c}").alias(f"_{c}"))])
    centre = shared.join(fellows, "id").withColumn("f", rank).groupBy("key").agg(
        *[F.max_by(c, "f").alias(f"_{c}") for c in ("id", *carry)])
    return shared.join(centre, "key").filter("id <> _id").select(
        *[x for c in ("id", *carry) for x in (c, f"_{c}")])


def unlinked_pairs(shared: DataFrame, roots: DataFrame, close: Column, carry: tuple[str, ...] = (),
                   few: int | None = FEW, whole_groups: bool = False) -> DataFrame:
    """(a, b): close pairs of a group that are not connected yet by ``roots`` (id, root).

    A group's members outside its largest component meet all members of other components if
    they are at most ``few`` or that is None; of more, PIVOTS of them do (the least of each
    hash class, so that the bands of one group choose alike). So a group of n copies of one
    original costs a multiple of n, and only pairs that may add a link are put out. With ``whole_groups``
    the members are sent by key once, for counting and for the join with the counts.
    """
    cols = ("id", *carry)
    m = shared.select("key", *cols).join(roots.select("id", "root"), "id", "left").withColumn("r", F.coalesce("root", "id"))
    if whole_groups:
        m = m.select("key", "r", *cols).repartition("key")
    sizes = m.groupBy("key", "r").agg(F.count("*").alias("c"))
    main = sizes.groupBy("key").agg(F.max_by("r", F.struct("c", "r")).alias("main"),
                                    (F.sum("c") - F.max("c")).alias("rest")).filter("rest > 0")
    m = materialise(m.select("key", "r", *cols).join(main, "key"), "parts")
    sweep(shared.sparkSession)
    rest = m.filter("r <> main")
    if few is None:
        pairs = rest.select("key", "r", *cols).join(m.select("key", "main", F.col("r").alias("_r"), *[
            F.col(c).alias(f"_{c}") for c in cols]), "key").filter("r <> _r AND (id < _id OR _r = main)")
        return _put_out(pairs.filter(close), m)
    small = rest.filter(F.col("rest") <= few).select("key", "main", "r", *cols)
    many = rest.filter(F.col("rest") > few).groupBy("key", "main", F.pmod(F.xxhash64("id"), F.lit(PIVOTS)).alias("h")).agg(
        *[F.min_by(c, "id").alias(c) for c in ("r", *cols)]).drop("h")
    fellow = m.select("key", "rest", F.col("r").alias("_r"), *[F.col(c).alias(f"_{c}") for c in cols])
    pairs = small.unionByName(many).join(fellow, "key").filter(
        f"r <> _r AND (id < _id OR _r = main OR rest > {few})").filter(close)
    return _put_out(pairs, m)


def _put_out(members: DataFrame, parts: DataFrame) -> DataFrame:
    """The distinct pairs, written, so that the table of the groups' parts can go."""
    out = materialise(distinct_pairs(members), "unlinked")
    discard(parts)
    return out


def distinct_pairs(members: DataFrame) -> DataFrame:
    """(a, b), a < b, each once."""
    return members.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (id, root) of the nodes of links (a, b): root is the least id of the component.

    Alternates the large-star and small-star steps: every node points its
    neighbours to the least node it knows. Each round is two aggregates and two
    joins, written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain.
    """
    edges = materialise(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        # large has u > v: point u and its smaller neighbours to the least of them.
        large = large.filter("u <> v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("b"), F.col("m").alias("a")), F.struct(F.col("v").alias("b"), F.col("m").alias("a"))
        )).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        old, edges = edges, materialise(small, "links")
        discard(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("root"))).distinct()


def linked(shared: DataFrame, close: Column, verify: Callable[[DataFrame], DataFrame], carry: tuple[str, ...] = (),
           unlinked: Callable[[DataFrame], DataFrame] | None = None, whole_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """(links, roots): verified links and connected components (id, root) of the members of key groups.

    First every member is compared with its groups' central members, then those of a group
    that this did not connect with a few of them (:func:`unlinked_pairs`), then, whatever the
    size of the group, every pair that is still unconnected and was not compared. So two
    members of one group are in different components only if all pairs between their
    components in that group were compared and refused. ``close`` is a cheap test of a pair's
    carried columns (x and _x), ``verify`` returns the pairs (a, b) that are similar. ``unlinked``
    may put out the last step's pairs for the roots so far: at least all similar pairs (a, b) of a group that they do not connect.
    """
    pairs = materialise(distinct_pairs(leader_pairs(shared, carry, whole_groups).filter(close)), "near")
    sweep(shared.sparkSession)
    compared, links = [pairs], materialise(verify(pairs), "near")
    roots = components(links)
    for few in (FEW, None):
        pairs = unlinked(roots) if unlinked and few is None else unlinked_pairs(shared, roots, close, carry, few, whole_groups)
        for done in compared:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        compared.append(pairs := materialise(pairs, "near"))
        sweep(shared.sparkSession)
        if pairs.isEmpty():
            continue
        more = materialise(verify(pairs), "near")
        links = links.unionByName(more)
        if not more.isEmpty():
            # The groups so far, as links to their roots, and the new links.
            stars = roots.filter("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))
            roots = components(stars.unionByName(more.select("a", "b")))
    discard(*compared)
    return links, roots

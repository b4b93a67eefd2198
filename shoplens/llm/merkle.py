"""Merkle dataset manifest by nested-interval labels.

Every document is a leaf; the leaves of a group, in order of their ids, and
then the roots of the groups, are joined in runs of ``fanout`` under parents
until one node remains. A node is labelled with the interval [lo, hi) of the
leaf ranks that it covers, so that ancestry is containment of intervals: the
node over rank r at height k lies in bucket r div fanout^k of its height. A
descent from the root joins each height with the one above by that bucket and
the containment, and what a parent covers beyond a node's own interval are
its siblings. All of it is DataFrame functions; the driver sees the number
of heights alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Run, col, ranked

#: Children of a node.
FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, lower-cased."""
    return F.translate(text, UPPER, LOWER)


def digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields in order, each as ``-`` if null, else its
    number of UTF-8 bytes, ``:`` and its text, so that no two rows read alike."""
    parts = []
    for f in fields:
        s = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _parents(nodes: DataFrame, width: int, payload: Sequence[str] = ()) -> DataFrame:
    """Nodes (grp, size, lo, hi, digest) → their parents of ``width`` ranks,
    with the children as ``kids``; a group's only leaf is its own parent."""
    kid = F.struct("lo", "hi", "digest", *payload)
    alone = F.col("size") == 1
    joined = F.array_join(F.transform("kids", lambda k: k["digest"]), "")
    return (nodes.groupBy("grp", "size", F.floor(F.col("lo") / width).alias("bucket"))
            .agg(F.array_sort(F.collect_list(kid)).alias("kids"))
            .select("grp", "size", "bucket", (F.col("bucket") * width).alias("lo"),
                    F.least("size", (F.col("bucket") + 1) * width).alias("hi"),
                    F.when(alone, F.col("kids")[0]["digest"]).otherwise(F.sha2(joined, 256)).alias("digest"), "kids"))


def tree(leaves: DataFrame, run: Run, name: str, fanout: int = FANOUT, payload: Sequence[str] = ()) -> list[DataFrame]:
    """Ranked leaves (grp, rank, size, digest and ``payload``) → the nodes of
    each height, from 1, staged: grp, size, lo, hi, digest, kids. A group ends
    at the height where one node covers it. One shuffle of the leaves, then
    of an eighth, and so on; no group of rows is larger than ``fanout``."""
    nodes = leaves.withColumnsRenamed({"rank": "lo"}).withColumn("hi", F.col("lo") + 1)
    levels = [run.stage(_parents(nodes, fanout, payload), f"{name}-1")]
    largest = leaves.agg(F.max("size")).first()[0] or 0
    width = fanout
    while largest > width:
        open_ = levels[-1].filter(F.col("size") > width).select("grp", "size", "lo", "hi", "digest")
        width *= fanout
        levels.append(run.stage(_parents(open_, width), f"{name}-{len(levels) + 1}"))
    return levels


def _is_root() -> Column:
    return (F.col("lo") == 0) & (F.col("hi") == F.col("size"))


def _step(kids: Column, lo: Column, hi: Column) -> Column:
    """What the parent covers before and after [lo, hi): the siblings' digests."""
    def text(keep):
        return F.array_join(F.transform(F.filter(kids, keep), lambda k: k["digest"]), "")
    return F.struct(text(lambda k: k["hi"] <= lo).alias("left"), text(lambda k: k["lo"] >= hi).alias("right"))


def paths(levels: list[DataFrame], roots: DataFrame, run: Run, name: str, fanout: int = FANOUT) -> DataFrame:
    """Nodes of height 1 with the path from them to the top: an array of
    (left, right), the siblings of the node, of its parent and so on, then
    the path that ``roots`` (grp, path, and columns to carry) gives for the
    node over the whole group. Heights above 1 are staged."""
    carried = [c for c in roots.columns if c not in ("grp", "path")]
    r = roots.select(F.col("grp").alias("_grp"), "path", *carried)
    done = None
    for k in range(len(levels), 0, -1):
        nodes = levels[k - 1]
        own = nodes.filter(_is_root()).join(r, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
        if done is not None:
            up = done.select(F.col("grp").alias("_grp"), F.col("bucket").alias("_bucket"), F.col("lo").alias("_lo"),
                             F.col("hi").alias("_hi"), F.col("kids").alias("_kids"), F.col("path").alias("_path"), *carried)
            above = (nodes.filter(~_is_root())
                     .join(up, F.col("grp").eqNullSafe(F.col("_grp"))
                           & (F.floor(F.col("lo") / fanout ** (k + 1)) == F.col("_bucket"))
                           & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))))
            step = F.array(_step(F.col("_kids"), F.col("lo"), F.col("hi")))
            own = own.unionByName(above.select(*nodes.columns, F.concat(step, F.col("_path")).alias("path"), *carried))
        done = run.stage(own, f"{name}-path-{k}") if k > 1 else own
    return done


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof(path: Column) -> Column:
    """Hex SHA-256 of all siblings of a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, fields: Sequence[str], group: str, id_col: str = "doc_id", fanout: int = FANOUT,
             presented: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, grp, rank (in its group), leaf,
    subroot (of its group), root, path (array of left, right: the siblings'
    digests before and after, from the leaf up), and shown, the leaf of the
    document as ``presented`` now: expressions that replace some of the
    ``fields`` (none: as it is).

    ``verify`` folds ``shown`` with the path. Leaves are ordered by id, then
    by digest; a null id stands first, repeated rows are leaves of their own
    (equal ones in any order, which changes no node). Groups are ordered by
    value, null first, as one of them. A null field differs from an empty
    one. Texts are hashed whole in the JVM, whatever their length. Empty
    table: no rows. Extra columns are ignored."""
    run = Run(docs.sparkSession, "merkle")
    now = dict(presented or {})
    base = docs.select(
        col(id_col).alias("doc_id"), col(group).alias("grp"), digest([col(f) for f in fields]).alias("digest"),
        (digest([now.get(f, col(f)) for f in fields]) if now else F.lit(None).cast("string")).alias("shown"))
    leaves = run.stage(base.withColumn("row", F.monotonically_increasing_id()), "leaves")
    # Sixty bits of the digest order rows that repeat an id.
    tie = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    leaves = ranked(leaves, ["grp"], [F.col("doc_id").asc_nulls_first(), tie.asc(), F.col("row").asc()], run, "leaves")
    levels = tree(leaves.drop("row"), run, "group", fanout, ["doc_id", "shown"])
    run.drop("leaves")

    # The groups' roots are the leaves of one more tree.
    tops = [nodes.filter(_is_root()).select("grp", "digest") for nodes in levels]
    subroots = tops[0]
    for t in tops[1:]:
        subroots = subroots.unionByName(t)
    subroots = run.stage(subroots, "subroots")
    top = ranked(subroots.select(F.lit(0).alias("all"), F.col("grp").alias("of"), "digest"), ["all"],
                 [F.col("of").asc_nulls_first()], run, "groups").withColumnRenamed("all", "grp")
    upper = tree(top, run, "top", fanout, ["of"])
    root = run.spark.createDataFrame([], "digest string")
    for nodes in upper:
        root = root.unionByName(nodes.filter(_is_root()).select("digest"))
    roots = root.select(F.lit(0).alias("grp"), F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                        F.col("digest").alias("root"))
    above = _leaf_paths(paths(upper, roots, run, "top", fanout), ["of", "root"])
    above = run.stage(above.select(F.col("of").alias("grp"), F.col("leaf").alias("subroot"), "root", "path"), "roots")
    out = _leaf_paths(paths(levels, above, run, "group", fanout), ["grp", "doc_id", "shown", "subroot", "root"])
    return out.select("doc_id", "grp", "rank", "leaf", F.coalesce("shown", "leaf").alias("shown"), "subroot", "root", "path")


def _leaf_paths(first: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nodes of height 1 with their path → one row per leaf: rank, leaf, path
    and ``columns`` (of the node, or of the leaf). An only leaf has no siblings."""
    kid = F.explode("kids").alias("kid")
    kids = {f.name for f in first.schema["kids"].dataType.elementType.fields}
    t = first.select("*", kid)
    step = F.array(_step(F.col("kids"), F.col("kid.lo"), F.col("kid.hi")))
    path = F.when(F.col("size") > 1, F.concat(step, F.col("path"))).otherwise(F.col("path"))
    return t.select(F.col("kid.lo").alias("rank"), F.col("kid.digest").alias("leaf"), path.alias("path"),
                    *[F.col(f"kid.{c}").alias(c) if c in kids else F.col(c) for c in columns])


def verify(rows: DataFrame) -> DataFrame:
    """Rows of ``manifest`` with proof_sha256, folded_root (of the document
    as presented) and verified: whether that is the root."""
    t = rows.withColumn("proof_sha256", proof(F.col("path"))).withColumn("folded_root", fold(F.col("shown"), F.col("path")))
    return t.withColumn("verified", F.col("folded_root") == F.col("root"))

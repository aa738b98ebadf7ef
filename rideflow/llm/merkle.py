"""Merkle manifest of a dataset: a tree per source, a tree over the sources, and a proof per document.

Every node is labelled with the interval of leaf ranks that it covers. ``BAND`` levels are one band:
the nodes of a band below one node of the next are a bucket, found by the level and the start of
their interval, so ancestors are attached by one containment join a band. Within a bucket the
siblings of a node are the interval of its parent less its own. Texts are read once and never
shuffled; leaves are sorted in ranges, so a source may hold any share of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.llm.common import written
from rideflow.operators.lookup import lookup_join

#: Consecutive nodes that make one of the next level, and levels of a band.
FANOUT, BAND = 3, 4
_WIDTH = FANOUT**BAND
_LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: each value with its length in bytes before it, ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def _numbered(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, int]:
    """The rows with ``rank``, their place from 0 in their tree by ``order``, and ``size``, the rows of the tree; and the largest size.

    Ranges are sorted and written; a rank is the rows of the tree in the ranges before and the
    place within its own. Of those there is one row per range and tree in it.
    """
    place = F.monotonically_increasing_id()
    ranges = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    ranges = written(ranges.withColumn("row", place), "ranges").withColumn("range", F.shiftright("row", 33))
    spans = ranges.groupBy(tree, "range").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(tree).orderBy("range")) - F.col("rows")
    spans = written(spans.select(tree, "range", (before - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy(tree)).alias("size")), "spans")
    largest = spans.agg(F.max("size")).first()[0] or 0
    ranked = lookup_join(ranges, spans, {tree: tree, "range": "range"})
    return ranked.withColumn("rank", F.col("row") + F.col("shift")).drop("row", "range", "shift"), largest


def _levels(nodes: Column, size: Column) -> Column:
    """The digests of each level of a bucket, its own nodes first; ``size`` is the number of nodes of the tree on that first level.

    Where the tree has one node left, it stays as it is.
    """

    def above(levels: Column, level: Column) -> Column:
        below = F.element_at(levels, -1)
        parents = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FANOUT).cast("int"))
        joined = F.transform(parents, lambda p: digest(F.array_join(F.slice(below, p * FANOUT + 1, F.lit(FANOUT)), "")))
        return F.concat(levels, F.array(F.when(size > F.pow(F.lit(FANOUT), level), joined).otherwise(below)))

    return F.reduce(F.sequence(F.lit(0), F.lit(BAND - 1)), F.array(nodes), above)


def _bands(leaves: DataFrame, payload: list[str], largest: int) -> list[DataFrame]:
    """The buckets of each band, from the leaves up: ``tree, lo, hi, size, nodes, levels``.

    ``leaves`` has ``tree, rank, size, digest`` and the payload. ``lo`` and ``hi`` bound the leaf
    ranks that a bucket covers; ``nodes`` are its nodes on the band's first level.
    """
    width, bands = 1, []
    nodes = leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "size", F.struct("rank", "digest", *payload).alias("node"))
    while True:
        size = F.ceil(F.col("size") / width)
        buckets = nodes.groupBy("tree", F.floor(F.col("lo") / (width * _WIDTH)).alias("bucket"), "size").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array_sort(F.collect_list("node")).alias("nodes")
        )
        bands.append(written(buckets.select("tree", "lo", "hi", "size", "nodes", _levels(F.col("nodes.digest"), size).alias("levels")), "band"))
        width *= _WIDTH
        if largest <= width:
            return bands
        top = F.element_at(F.element_at("levels", -1), 1)
        nodes = bands[-1].where(F.col("size") > width).select("tree", "lo", "hi", "size", F.struct(F.col("lo").alias("rank"), top.alias("digest")).alias("node"))


def _roots(bands: list[DataFrame]) -> DataFrame:
    """``tree, root``: what remains of each tree, in the band whose one bucket covers all of it."""
    top = F.element_at(F.element_at("levels", -1), 1)
    roots = [b.where((F.col("lo") == 0) & (F.col("hi") == F.col("size"))).select("tree", top.alias("root")) for b in bands]
    out = roots[0]
    for more in roots[1:]:
        out = out.union(more)
    return out


def _siblings(levels: Column, size: Column, place: Column) -> Column:
    """By level what stands left and right of the node's ancestor below their parent, from the node up to the bucket's top."""

    def step(level: Column) -> Column:
        own, of_parent = F.pow(F.lit(FANOUT), level).cast("int"), F.pow(F.lit(FANOUT), level + 1).cast("int")
        lo, first = place - place % own, place - place % of_parent
        digests = F.element_at(levels, level + 1)

        def between(start: Column, end: Column) -> Column:
            """Digests of the nodes of this level that cover the ranks from start to end."""
            return F.array_join(F.slice(digests, F.floor(start / own).cast("int") + 1, F.floor((end - start) / own).cast("int")), "")

        # The parent's interval less the node's own is one interval on each side.
        return F.struct(between(first, lo).alias("left"), between(lo + own, first + of_parent).alias("right"))

    steps = F.filter(F.sequence(F.lit(0), F.lit(BAND - 1)), lambda level: size > F.pow(F.lit(FANOUT), level))
    return F.transform(steps, step)


def _proved(bands: list[DataFrame], above: DataFrame) -> DataFrame:
    """``tree, node, path, upper``: each leaf with all siblings of its ancestors, from the leaf up.

    ``above`` has for each ``tree`` the ``path`` from its root on, and any column ``upper``. A band's
    nodes and the buckets of the band below are joined by tree and level where the intervals contain
    each other; each bucket continues the path of its own top node.
    """
    paths, upper = None, above.columns[1:]
    for number in reversed(range(len(bands))):
        width = _WIDTH**number
        covers_all = F.col("size") <= width * _WIDTH
        buckets = bands[number].where(F.size("nodes") > 0)
        tops = lookup_join(buckets.where(covers_all), above.withColumnsRenamed({"path": "upper_path"}), {"tree": "tree"})
        if paths is not None:
            inner = buckets.where(~covers_all)
            held = inner["tree"].eqNullSafe(paths["_tree"]) & (inner["lo"] == paths["_lo"]) & (inner["hi"] <= paths["_hi"])
            tops = tops.unionByName(inner.join(paths, held).drop("_tree", "_lo", "_hi"))
        size = F.ceil(F.col("size") / width)
        nodes = F.transform(
            "nodes",
            lambda node, i: F.struct(node.alias("node"), F.concat(_siblings(F.col("levels"), size, i), F.col("upper_path")).alias("path")),  # noqa: B023
        )
        found = tops.select("tree", "lo", "hi", "size", *[c for c in upper if c != "path"], nodes.alias("nodes"))
        if not number:
            return found
        each = found.select("tree", "size", *[c for c in upper if c != "path"], F.inline("nodes"))
        paths = written(
            each.select(
                F.col("tree").alias("_tree"), F.col("node.rank").alias("_lo"), F.least(F.col("node.rank") + width, "size").alias("_hi"),
                *[c for c in upper if c != "path"], F.col("path").alias("upper_path"),
            ),
            "paths",
        )
    raise AssertionError("a tree has a band")


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, path, folded_root``: the tree over all documents, with a proof per document.

    A leaf is the digest of the row's ``doc_id, source, lang, n_chars, text``. Leaves of a source
    ascend by ``doc_id`` (null first, equal ones by leaf); three nodes in a row make one, down to the
    source's ``subroot``; these, by source (null first), make the ``root`` likewise. ``path`` lists
    from the leaf up what stands left and right of it below each ancestor. ``folded_root`` goes up that
    path from the leaf again, or, where ``changed`` gives a text, from the leaf with this text.

    Null texts and empty ones are different leaves. Repeated rows are leaves of their own. Without documents there is no row.
    """
    label = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    fields = [F.col(c) for c in _LEAF_FIELDS]
    now = F.col("digest") if changed is None else F.when(changed.isNotNull(), leaf_digest(*fields[:-1], changed)).otherwise(F.col("digest"))
    leaves = docs.select(*_LEAF_FIELDS, leaf_digest(*fields).alias("digest"))
    leaves = leaves.select(label.alias("tree"), "doc_id", "digest", now.alias("now"), F.monotonically_increasing_id().alias("at"))
    ranked, largest = _numbered(written(leaves, "leaves"), "tree", ["doc_id", "digest", "at"])
    bands = _bands(ranked, ["doc_id", "now"], largest)
    subroots = written(_roots(bands), "subroots")
    sources, sources_largest = _numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("digest")), "tree", ["source"])
    top = _bands(sources, ["source"], sources_largest)
    root = _roots(top).first()
    nothing = docs.sparkSession.range(1).select(F.lit("").alias("tree"), F.array().cast(_STEP).alias("path"))
    source_paths = _proved(top, nothing).select(F.inline("nodes")).select(F.col("node.source").alias("tree"), "path", F.col("node.digest").alias("subroot"))
    found = _proved(bands, written(source_paths, "paths"))
    fold = lambda leaf, path: F.reduce(path, leaf, lambda below, step: digest(step["left"], below, step["right"]))
    rows = F.transform(
        "nodes",
        lambda n: F.struct(
            n["node"]["doc_id"].alias("doc_id"), n["node"]["digest"].alias("leaf"), n["path"].alias("path"), fold(n["node"]["now"], n["path"]).alias("folded_root")
        ),
    )
    return found.select("subroot", F.inline(rows)).select(
        "doc_id", "leaf", "subroot", F.lit(root["root"] if root else None).cast("string").alias("root"), "path", "folded_root"
    )


def manifest_report(docs: DataFrame) -> DataFrame:
    """One row per document with its proof's digest and the root folded again; every second document, by the hash of its id, lost its line breaks before.

    Documents without an id keep theirs.
    """
    rows = docs.select(*_LEAF_FIELDS)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    tampered = F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    proof = digest(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""))
    return manifest(rows, tampered).select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )

"""Merkle manifest of a dataset: a tree of hashes for each source, a tree over the sources' roots, and proofs by parent preimages.

A parent is stored as its preimage, the concatenated hashes of its children, which are 64 characters each. A leaf's path is the list of
its ancestors' preimages with its own slot in each: what is left when the slot is cut out are the siblings, and a hash put in its place
gives the preimage that folds to the parent. Preimages of five levels stand in one row, for a block of 243 nodes at most, so a tree
over any number of leaves takes a few joins, no group is larger than a block, and a hot source is many blocks.

Leaves are numbered without a window: rows are dealt by ranges of (source, doc_id, leaf, place in the input), sorted in their range, and
counts of the ranges before are added. Only a row for each range and source meets in windows.

Defined cases: a null value of any column is written as ``-``; a null source is a source, before all others; null doc_ids come first
in their source. Equal doc_ids go by their leaf's hash; equal rows take places side by side and differ in their proofs alone.
A null doc_id is never tampered with. A source of one row is its own root, so is a single source; the proof of a lone row has no siblings.
Other columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.llm._work import drop_stored, stored

FAN, LEVELS, HEX = 3, 5, 64
BLOCK = FAN**LEVELS
_POWERS = [FAN**k for k in range(40)]


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of values: each ``-`` if null, else its bytes in UTF-8, a colon, and itself."""
    said = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (x.cast("string") for x in values)]
    return F.sha2(F.concat(*said), 256)


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """The rows, stored, with ``part`` and ``local``: their range by ``order``, and their place in it."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    out = stored(placed, "ranges")
    return out.withColumns({"part": F.shiftright("_id", 33), "local": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")


def _numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (k, doc_id, leaf, ...) with g, the number of their source, at, their place in it, and n, its rows; and the sources (g, n)."""
    dealt = _dealt(leaves.withColumn("_in", F.monotonically_increasing_id()), "k", "doc_id", "leaf", "_in")
    here = stored(dealt.groupBy("part", "k").agg(F.count("*").alias("here"), F.min("local").alias("first")), "counts")
    sources = here.groupBy("k").agg(F.sum("here").alias("n"), F.min(F.struct("part", "first")).alias("begins"))
    sources = _dealt(sources.select("k", "n", "begins"), "begins")
    ranges = sources.groupBy("part").agg(F.count("*").alias("rows"))
    ranges = ranges.select("part", (F.sum("rows").over(W.orderBy("part")) - F.col("rows")).alias("before"))
    sources = stored(sources.join(F.broadcast(ranges), "part").select("k", "n", (F.col("before") + F.col("local")).alias("g")), "sources")
    by_part = W.partitionBy("k").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = here.select("part", "k", "first", F.coalesce(F.sum("here").over(by_part), F.lit(0)).alias("before")).join(sources, "k")
    rows = dealt.join(offsets, ["part", "k"]).withColumn("at", F.col("before") + F.col("local") - F.col("first"))
    return rows.drop("part", "local", "first", "before", "k", "_in"), sources.select("g", "n")


def _over(x: Column, by: Column | int) -> Column:
    return F.floor((x - F.pmod(x, F.lit(by) if isinstance(by, int) else by)) / by).cast("long")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (g, at, n, h) to (g, block, n, parents, top): preimages of the parents on each level above a block, and its topmost node's hash."""
    one = nodes.groupBy("g", _over(F.col("at"), BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "h"))).alias("h"), F.max("n").alias("n"))
    one = one.withColumn("h", F.transform("h", lambda x: x["h"]))
    levels = F.size(F.filter(F.array(*map(F.lit, _POWERS)), lambda p: p < F.col("n")))
    for level in range(LEVELS):
        runs = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("h") / FAN).cast("int") - 1))
        put = F.transform(runs, lambda i: F.array_join(F.slice("h", i * FAN + 1, FAN), ""))
        one = one.withColumn(f"p{level}", F.when(levels > level, put))
        one = one.withColumn("h", F.coalesce(F.transform(f"p{level}", lambda p: F.sha2(p, 256)), F.col("h")))
    parents = F.filter(F.array(*[f"p{i}" for i in range(LEVELS)]), lambda p: p.isNotNull())
    return one.select("g", "block", "n", parents.alias("parents"), F.get("h", F.lit(0)).alias("top"))


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of nodes, blocks of their topmost nodes, and so on up to one block for each g."""
    tiers = []
    while True:
        tiers.append(stored(_blocks(nodes), "preimages"))
        if not tiers[-1].where(F.col("n") > BLOCK).limit(1).count():
            return tiers
        nodes = tiers[-1].select("g", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("h"))


def _ancestors(parents: Column, at: Column) -> Column:
    """The preimages above the node with this place in a block, each with the node's slot in it."""
    powers = F.array(*map(F.lit, _POWERS[: LEVELS + 1]))
    return F.transform(parents, lambda level, i: F.struct(F.get(level, _over(at, F.get(powers, i + 1)).cast("int")).alias("pre"), F.pmod(_over(at, F.get(powers, i)), F.lit(FAN)).cast("int").alias("slot")))


def _joined(nodes: DataFrame, blocks: DataFrame, at: str) -> DataFrame:
    """Nodes (g, at) with their path: what stands above them in their block, and above that. They get the block's subroot too."""
    above = blocks.select(F.col("g").alias("_g"), F.col("block").alias("_block"), F.col("parents").alias("_parents"), F.col("path").alias("_path"), "subroot")
    met = nodes.join(above, (F.col("g") == F.col("_g")) & (_over(F.col(at), BLOCK) == F.col("_block")))
    return met.withColumn("path", F.concat(_ancestors(F.col("_parents"), F.pmod(F.col(at), F.lit(BLOCK))), "_path")).drop("_g", "_block", "_parents", "_path")


def _with_paths(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest tier's blocks with the path above each; tops: (g, path, subroot) of each tree's root."""
    blocks = tiers[-1].join(tops, "g")
    for tier in reversed(tiers[:-1]):
        blocks = _joined(tier, blocks, "block")
    return blocks


def siblings(path: Column) -> Column:
    """The hashes beside a node on each level of its path, left to right: each preimage without the node's own slot."""
    cut = lambda x: F.concat(F.substring(x["pre"], F.lit(1), x["slot"] * HEX), F.substring(x["pre"], x["slot"] * HEX + HEX + 1, F.lit(FAN * HEX)))
    return F.array_join(F.transform(path, cut), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to: its hash is put in its slot of the first preimage, whose hash goes into the next."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.overlay(x["pre"], h, x["slot"] * HEX + 1, F.lit(HEX)), 256))


def merkle_paths(leaves: DataFrame, source: Column) -> DataFrame:
    """Leaves (doc_id, leaf, and other columns) with subroot, root and path. What is stored on the way stays until the session ends."""
    rows = leaves.withColumn("k", F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source))).drop("source")
    rows, sources = _numbered(rows)
    rows = stored(rows, "leaves")
    trees = _tiers(rows.select("g", "at", "n", F.col("leaf").alias("h")))
    subroots = stored(trees[-1].select(F.lit(0).alias("g"), F.col("g").alias("at"), F.lit(sources.count()).alias("n"), F.col("top").alias("h")), "subroots")
    over = _tiers(subroots)
    root = over[-1].select("top").first()
    start = F.array().cast("array<struct<pre:string,slot:int>>")
    top = _with_paths(over, over[-1].select("g", start.alias("path"), F.lit("").alias("subroot")))
    of_source = _joined(subroots, top.drop("n"), "at").select(F.col("at").alias("g"), "path", F.col("h").alias("subroot"))
    met = _joined(rows, _with_paths(trees, of_source), "at").drop("g", "at", "n")
    return met.withColumn("root", F.lit(root.top if root else None).cast("string"))


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, where: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of docs. tampered: what a check finds in the place of
    the text, where the condition ``where`` holds; without it every row verifies."""
    leaf = lambda text: leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    found = F.lit(None).cast("string") if tampered is None else F.when(where & (tampered != F.col("text")), leaf(tampered))
    hashed = stored(docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), found.alias("found")), "hashed")
    met = merkle_paths(hashed, F.col("source"))
    drop_stored(hashed)
    out = met.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded(F.coalesce("found", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

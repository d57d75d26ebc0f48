"""Merkle manifest of a dataset, with proofs by content-addressed descent.

A row is a leaf: the digest of its fields. Each source has a tree over its leaves in the order
of their ids: FAN_OUT consecutive nodes become the digest of their joined digests until one is
left, the subroot. The subroots in the order of their sources are the leaves of the top tree,
whose root stands for the dataset. Each inner node is stored as a record from its digest to its
children, so equal subtrees are one record.

A request for a leaf descends from the root: its rank in digits of base FAN_OUT names the child
to take at each record, which is found by its digest alone; the children not taken are collected,
and the segments are reversed at the end, so that the proof reads from the leaf up. Requests
that go through the same node descend as one row until they part: no record has more than one
row per place of its node, and the root, which all requests go through, is one row.

Ranks come from a range shuffle, so a source may hold most rows. Nothing but the largest leaf
count is taken to the driver. Tables: `leaves` (tree, n, rank, doc_id, leaf, claimed), `trees`
(tree, source, n, subroot), `records-<tree kind>-<height>` (digest, children).

Defined results: a NULL field is `-` in its leaf; a NULL source is a source of its own, the
first; NULL ids come first in their source, and rows of equal id are in the order of their leaf
digests, so repeated rows are leaves of their own and get proofs of their own. A lone leaf is
its subroot, a lone subroot the root. An empty table has no root and gives no row. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators import number_rows
from terrace.llm.common import stored

FAN_OUT = 16
DIGIT_BITS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PATH = "CAST(array() AS array<struct<left: string, right: string>>)"


def joined_digest(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of the fields: `-` for NULL, else the bytes of the text, a colon and the text."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def height_of(n: Column) -> Column:
    """Levels above the leaves: as many as the last rank has digits, none for a lone leaf."""
    return F.when(n > 1, F.length(F.hex(n - 1))).otherwise(0)


@dataclass(frozen=True)
class Manifest:
    """The stored tables. `subtrees` and `top` hold the records by height."""

    leaves: DataFrame
    trees: DataFrame
    roots: DataFrame
    subtrees: Mapping[int, DataFrame]
    top: Mapping[int, DataFrame]


def grown(nodes: DataFrame, label: str) -> tuple[dict[int, DataFrame], DataFrame]:
    """Records by height and the roots (tree, n, digest) over `nodes` (tree, n, rank, digest);
    a tree has n nodes, ranked from 0. Each level is one shuffle of a sixteenth of the rows of
    the one below."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    records: dict[int, DataFrame] = {}
    level, roots = nodes, nodes.filter("n = 1").select("tree", "n", "digest")
    height = 0
    while FAN_OUT**height < most:
        unfinished = level.filter(F.col("n") > FAN_OUT**height)
        height += 1
        runs = unfinished.groupBy("tree", "n", F.shiftright("rank", DIGIT_BITS).alias("rank"))
        kids = runs.agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("kids"))
        level = stored(kids.select("tree", "n", "rank", F.col("kids.digest").alias("children")).withColumn("digest", joined_digest(F.col("children"))), f"{label}-level")
        records[height] = stored(level.groupBy("digest").agg(F.first("children").alias("children")), f"{label}-records")
        roots = roots.unionByName(level.filter(F.col("n") <= FAN_OUT**height).select("tree", "n", "digest"))
    return records, roots


def build(docs: DataFrame, claims: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of `docs`. `claims` gives fields as a holder of the data has them now; the
    digest of the row with these fields is kept as `claimed` beside the leaf."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    rows = docs.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in FIELDS])
    own = [F.col(c) for c in FIELDS]
    held = [(claims or {}).get(c, F.col(c)) for c in FIELDS]
    leaves = stored(rows.select("source", "doc_id", leaf_digest(own).alias("leaf"), leaf_digest(held).alias("claimed")), "merkle-leaves")
    ranked = number_rows(leaves, ["source"], [F.col(c).asc_nulls_first() for c in ("doc_id", "leaf", "claimed")])
    sizes = stored(leaves.groupBy("source").agg(F.count("*").alias("n")), "merkle-sizes")
    places = number_rows(sizes, [], [F.col("source").asc_nulls_first()])
    places = stored(places.select("source", "n", (F.col("rank") - 1).alias("tree")), "merkle-places")
    same = F.col("r.source").eqNullSafe(F.col("p.source"))
    placed = ranked.alias("r").join(places.alias("p"), same)
    placed = stored(placed.select("tree", "n", (F.col("r.rank") - 1).alias("rank"), "doc_id", "leaf", "claimed"), "merkle-ranked")
    subtrees, subroots = grown(placed.select("tree", "n", "rank", F.col("leaf").alias("digest")), "merkle")
    trees = places.join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    trees = stored(trees.select("tree", "source", "n", "subroot"), "merkle-trees")
    n_trees = trees.count()
    nodes = trees.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("rank"), F.col("subroot").alias("digest"))
    top, roots = grown(nodes, "merkle-top")
    return Manifest(placed, trees, roots, subtrees, top)


def _segment(children: Column, digit: Column) -> Column:
    """The children not taken, before and after the one taken."""
    left = F.array_join(F.slice(children, 1, digit), "")
    right = F.array_join(F.slice(children, digit + 2, FAN_OUT), "")
    return F.struct(left.alias("left"), right.alias("right"))


def descend(records: Mapping[int, DataFrame], roots: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests (tree, rank, ...) with `path`, from the root down, and `found`, the digest
    that the descent ends at. `roots` (tree, n, digest, path) starts each tree with a path."""
    roots = roots.withColumn("height", height_of(F.col("n")))
    here = None
    lone = roots.filter("height = 0").select("tree", F.lit(0).cast("long").alias("prefix"), "path", F.array("digest").alias("children"), F.lit(False).alias("inner"))
    opened = lone
    for height in range(max(records, default=0), 0, -1):
        start = roots.filter(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("prefix"), "digest", "path")
        here = start if here is None else here.unionByName(start)
        # Only nodes that a request goes through.
        wanted = requests.select("tree", F.shiftright("rank", DIGIT_BITS * height).alias("prefix")).distinct()
        taken = here.join(wanted, ["tree", "prefix"], "left_semi").join(records[height], "digest")
        if height == 1:
            opened = opened.unionByName(taken.select("tree", "prefix", "path", "children", F.lit(True).alias("inner")))
            break
        each = taken.select("tree", "prefix", "path", "children", F.posexplode("children").alias("digit", "digest"))
        here = each.select("tree", (F.col("prefix") * FAN_OUT + F.col("digit")).alias("prefix"), "digest", F.array_append("path", _segment(F.col("children"), F.col("digit"))).alias("path"))
    asked = requests.withColumn("prefix", F.shiftright("rank", DIGIT_BITS))
    met = asked.join(opened, ["tree", "prefix"])
    digit = F.col("rank").bitwiseAND(F.lit(FAN_OUT - 1)).cast("int")
    path = F.when(F.col("inner"), F.array_append("path", _segment(F.col("children"), digit))).otherwise(F.col("path"))
    return met.select(*requests.columns, path.alias("path"), F.element_at("children", digit + 1).alias("found"))


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """The requested leaves (tree, rank, ...) with `subroot`, `root`, `found` and `proof`, the
    siblings before and after each node from the leaf up."""
    tops = manifest.roots.withColumn("path", F.expr(NO_PATH))
    trees = manifest.trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "n", "subroot")
    root = manifest.roots.select("digest").scalar()
    above = descend(manifest.top, tops, trees).withColumn("root", root)
    above = stored(above.select(F.col("rank").alias("tree"), "n", F.col("found").alias("digest"), "path", "root"), "merkle-top-paths")
    below = descend(manifest.subtrees, above.drop("root"), requests)
    known = above.select("tree", F.col("digest").alias("subroot"), "root")
    return below.join(known, "tree").withColumn("proof", F.reverse("path")).drop("path")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level from the leaf up, left to right."""
    return joined_digest(F.transform(proof, lambda step: F.concat(step["left"], step["right"])))


def verified(docs: DataFrame, claims: Mapping[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, claimed, subroot, root, proof, folded_root and whether the claimed row
    gives the root, for every row."""
    manifest = build(docs, claims)
    rows = proofs(manifest, manifest.leaves.drop("n"))
    rows = rows.withColumn("folded_root", folded(F.col("claimed"), F.col("proof")))
    return rows.select("doc_id", "leaf", "claimed", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered_text(doc_id: str = "doc_id", text: str = "text", every: int = 5) -> Column:
    """The text with A-Z lower-cased where `every` divides the crc32 of the decimal id."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col(doc_id).cast("string")) % every == 0
    return F.when(hit, F.translate(text, upper, upper.lower())).otherwise(F.col(text))


"""Shards by a weighted hash tree: region, then rack, then shard, each chosen by a weighted hash draw.

A row draws a number for every child of the node it is in, ``-ln(u) / weight`` with ``u`` hashed from the row's key and
the child's path, and descends to the child with the least. A draw depends on nothing but key, path and weight, so a
changed weight moves rows into or out of the subtree that bears it and leaves all others in place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from watchtide.llm.prefix import KEY_BITS, attached, hash_key, running_total, with_rows


@dataclass(frozen=True)
class Leaf:
    """One shard, where it stands, and its share of the rows."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


def planned(shards: int = 16, racks: int = 2, per_rack: int = 4) -> tuple[Leaf, ...]:
    """Equal shards, ``per_rack`` to a rack and ``racks`` to a region."""
    return tuple(Leaf(s, f"r{s // (racks * per_rack)}", f"k{s // per_rack % racks}") for s in range(shards))


def grown(tree: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """The tree with one more shard, which opens a region of its own.

    No weight of another subtree changes, so the new shard takes rows and no other shard does.
    """
    shard = max(leaf.shard for leaf in tree) + 1
    return (*tree, Leaf(shard, f"r+{shard}", "k0", weight))


def _children(tree: tuple[Leaf, ...]) -> dict[str, dict[str, float]]:
    """Weight of each child path below each node path; the root is the empty path."""
    if not tree or any(not (leaf.weight >= 0 and math.isfinite(leaf.weight)) for leaf in tree):
        raise ValueError("a tree needs leaves, with finite weights of 0 or more")
    below: dict[str, dict[str, float]] = {}
    for leaf in tree:
        rack = f"{leaf.region}/{leaf.rack}"
        for parent, child in (("", leaf.region), (leaf.region, rack), (rack, f"{rack}/{leaf.shard}")):
            node = below.setdefault(parent, {})
            node[child] = node.get(child, 0.0) + leaf.weight
    kept = {p: {c: w for c, w in sorted(n.items()) if w > 0} for p, n in below.items()}
    if not kept[""]:
        raise ValueError("all weights are 0")
    return {p: n for p, n in kept.items() if n}


def _draw(key: Column, children: Column) -> Column:
    """Path of the child with the least draw; ties go to the path that sorts first."""

    def draw(child: Column) -> Column:
        u = (hash_key(key, child["path"]).cast("double") + 0.5) / float(2**KEY_BITS)
        return F.struct((-F.ln(u) / child["weight"]).alias("at"), child["path"].alias("path"))

    return F.array_min(F.transform(children, draw))["path"]


def shard_of(key: Column, tree: tuple[Leaf, ...]) -> Column:
    """The shard of a key. A null key draws like an empty text."""
    nodes = _children(tree)

    def children(node: dict[str, float]) -> Column:
        return F.array(*[F.struct(F.lit(p).alias("path"), F.lit(float(w)).alias("weight")) for p, w in node.items()])

    def level(depth: int) -> Column:
        pairs = [x for p, n in nodes.items() if p and p.count("/") == depth for x in (F.lit(p), children(n))]
        return F.create_map(*pairs)

    region = _draw(key, children(nodes[""]))
    rack = _draw(key, F.element_at(level(0), region))
    return F.element_at(F.split(_draw(key, F.element_at(level(1), rack)), "/"), -1).cast("int")


def with_shards(docs: DataFrame, tree: tuple[Leaf, ...], bigger: tuple[Leaf, ...] | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law``, ``shard`` and ``grown_shard``; columns of those names give way.

    ``size`` is the text's UTF-8 bytes and 1 more. The law is ``key``: nothing but the id and the tree decides, so
    repeated rows go together and equal texts of different ids need not. Null texts are empty, null ids are a key of
    their own. No shuffle.
    """
    data = F.coalesce(docs[text], F.lit("")).cast("binary")
    key = docs[id].cast("string")
    return docs.withColumns(
        {
            "size": F.octet_length(data).cast("bigint") + 1,
            "text_crc32": F.crc32(data),
            "law": F.lit("key"),
            "shard": shard_of(key, tree),
            "grown_shard": shard_of(key, bigger) if bigger else F.lit(None).cast("int"),
        }
    )


def with_slots(sharded: DataFrame, id: str = "doc_id") -> DataFrame:
    """Rows of ``with_shards`` with ``slot``: their gapless number in the shard, from 0, in hash order.

    Ties of the hash go by id, size and checksum. Only these columns are sorted; where there are others, such as texts,
    the slots are joined to them. An empty table gives no rows.
    """
    columns = [c for c in sharded.columns if c != "slot"]
    needed = {"size", "text_crc32", "law", "shard", "grown_shard", id}
    if set(columns) <= needed:
        return _numbered(sharded.select(F.struct(*columns).alias("_all")), id).select("_all.*", "slot")
    rows = with_rows(sharded.select(*columns), "sharded")
    keys = rows.select(F.struct(*[F.col("_all")[c].alias(c) for c in ("size", "text_crc32", "shard", id)]).alias("_all"), "_row")
    return attached(rows, _numbered(keys, id).select("_row", "slot")).select("_all.*", "slot")


def _numbered(rows: DataFrame, id: str) -> DataFrame:
    """``rows`` of narrow structs ``_all`` with ``slot``."""
    keyed = rows.withColumns(
        {
            **{f"_{c}": F.col("_all")[c] for c in ("shard", "size", "text_crc32")},
            "_id": F.col("_all")[id],
            "_key": hash_key(F.col("_all")[id]),
            "_one": F.lit(1).cast("bigint"),
        }
    )
    return running_total(keyed, "_shard", "_key", ["_id", "_size", "_text_crc32"], "_one", "slot", rows.count())

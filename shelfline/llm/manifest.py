"""Merkle manifest of a document table, its leaves placed by ranks in bitmaps.

Every row is a leaf: the SHA-256 of its fields. The leaves of a source stand in ascending order of
``doc_id``. No leaves are sorted for that: the ids of a source are merged into 64-bit words of a bitmap, of which
only words with a bit are kept, under a directory of counts whose levels each hold the sums of up to ``1 << _STEP``
entries of the level below. A leaf's place is the count before its word, read down the directory, plus the
bits of the word below its own. Rows are then keyed by (source, place div ``fan_out``), and the slot
array of each key gives one node of the next level, up to the source's root; the roots of the
sources, in order of their names, go the same way to the root of the table.

Going down again, each node hands its path (the siblings left and right of it at every level) to its run.

Results for special rows: rows that share a ``doc_id`` within a source stand in order of their leaf hash, copies of one row
side by side; rows without ``doc_id`` stand before all others of their source in the same way; rows without source are a source of their own, the first.
An empty table has no rows and no root. Texts of any length are hashed whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.llm.common import Scratch, prepare
from shelfline.operators.slices import in_slices, starts as slice_starts, with_before

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_OUT = 16

_BITS = 6
_STEP = 10
#: Hexadecimal digits of a hash that make a non-negative long.
_HEAD = 15


def field(value: Column) -> Column:
    """``-`` for a missing value, else its UTF-8 length in bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(values[name]) for name in FIELDS]), 256)


def group_of(source: Column) -> Column:
    """A key that is never NULL and sorts as the sources do: NULL first, then by bytes."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source))


def manifest(docs: DataFrame, tampered: Callable[[dict[str, Column]], tuple[Column, dict[str, Column]]] | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """One row per row of ``docs``: its leaf, the roots above, its path and what checking it gives.

    ``tampered`` maps the columns to (whether a row is tampered with, its columns then). Columns of the result: doc_id,
    source, place (in the source), leaf, subroot, root, path (array of the hashes left and right of the node, leaf level
    first), folded_root (the root recomputed from the tampered or else original leaf and the path).
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "manifest")
    values = {name: F.col(name) for name in FIELDS}
    leaf = leaf_hash(values)
    if tampered is not None:
        condition, changed = tampered(values)
        shown = F.when(condition, leaf_hash(values | changed))
    else:
        shown = F.lit(None).cast("string")
    leaves = scratch.write(
        docs.select(group_of(F.col("source")).alias("family"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("hash"), shown.alias("shown")), "leaves"
    )
    placed = place_leaves(scratch, leaves)
    below = climb(scratch, placed, fan_out, ["doc_id", "shown"], "source")
    tops = scratch.write(_top_of(below).select("family", F.col("hash").alias("subroot")), "subroots")

    # One row per source; their order is that of their names.
    sliced = in_slices(tops.withColumn("copies", F.lit(1).cast("long")), [F.col("family")], "sources")
    beginnings = scratch.write(slice_starts(sliced, []), "source-starts")
    ordered = with_before(sliced, beginnings, [], [F.col("family")])
    above = climb(scratch, ordered.select(F.lit("").alias("family"), F.col("before").alias("place"), F.col("subroot").alias("hash"), F.col("family").alias("of")), fan_out, ["of"], "table")
    root = _top_of(above).select("hash").scalar()

    subroots = scratch.write(descend(scratch, above, None, fan_out, "table").select(F.col("of").alias("family"), F.col("hash").alias("subroot"), F.col("path").alias("above")), "subroot-paths")
    found = descend(scratch, below, subroots, fan_out, "source")
    path = F.concat("path", "above")
    step = lambda node, level: F.sha2(F.concat(level["before"], node, level["after"]), 256)
    return found.select(
        "doc_id",
        F.when(F.col("family") != "", F.expr("substring(family, 2)")).alias("source"),
        "place",
        F.col("hash").alias("leaf"),
        "subroot",
        root.alias("root"),
        path.alias("path"),
        F.aggregate(path, F.coalesce("shown", "hash"), step).alias("folded_root"),
    )


def proof(path: Column) -> Column:
    """Hash of all siblings on a path, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), ""), 256)


# ---------------------------------------------------------------- places


def count_before(scratch: Scratch, counts: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds ``before``: the ``n`` of all rows of the group with a smaller ``value`` (a distinct long per group).

    A directory of sums: level k holds the sums over ranges of ``1 << _STEP * k`` values. A level's window
    holds the entries of one range of the next, so no group is ever in one task.
    """
    ends = counts.agg(F.min(value), F.max(value)).first()
    if ends[0] is None:
        return counts.withColumn("before", F.lit(0).cast("long"))
    levels = 1
    while (ends[1] - ends[0]) >> (_STEP * levels):
        levels += 1
    sums = [counts.withColumn("node", F.col(value) - F.lit(ends[0]))]
    for level in range(1, levels):
        sums.append(scratch.write(sums[-1].groupBy(*keys, F.shiftright("node", _STEP).alias("node")).agg(F.sum("n").alias("n")), f"{name}-sums-{level}"))
    within = Window.partitionBy(*keys, "parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    upper = None
    for level in reversed(range(levels)):
        entries = sums[level].withColumn("parent", F.shiftright("node", _STEP)).withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        if upper is not None:
            entries = entries.join(upper, [*keys, "parent"]).withColumn("before", F.col("before") + F.col("begin"))
        if level:
            upper = scratch.write(entries.select(*keys, F.col("node").alias("parent"), F.col("before").alias("begin")), f"{name}-directory-{level}")
        else:
            return entries.drop("node", "parent", "begin")
    raise AssertionError


def place_leaves(scratch: Scratch, leaves: DataFrame) -> DataFrame:
    """family, place, hash, shown and doc_id of every leaf."""
    # Rows without an id get the word before all others and bit 0 of it.
    word = F.coalesce(F.shiftright("doc_id", _BITS), F.lit(-(1 << (63 - _BITS)) - 1))
    bit = F.coalesce(F.col("doc_id").bitwiseAND((1 << _BITS) - 1), F.lit(0)).cast("int")
    keyed = leaves.withColumn("word", word).withColumn("bit", bit)
    own = F.expr("shiftleft(1L, bit)")
    merged = keyed.groupBy("family", "word").agg(F.bit_or(own).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = scratch.write(merged, "words")
    # Words of a source are counted per word, not per bit: a word with more rows than bits holds repeated ids.
    directory = scratch.write(count_before(scratch, words, ["family"], "word", "words"), "bitmap")
    found = keyed.join(directory, ["family", "word"])
    single = F.col("n") == F.bit_count("bits")
    rank = F.col("before") + F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.expr("shiftleft(-1L, bit)"))))
    columns = ["family", "hash", "shown", "doc_id"]
    placed = found.filter(single).select(*columns, rank.alias("place"))
    if directory.filter(~single).isEmpty():
        return placed
    return placed.unionByName(_place_repeated(scratch, found.filter(~single).select(*columns, "word", "bit", "before")))


def _place_repeated(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Places of the rows of words in which ids repeat: by id, then by hash; equal rows take the places one after another."""
    head = F.conv(F.substring("hash", 1, _HEAD), 16, 10).cast("long")
    distinct = scratch.write(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("head", head), "repeated")
    ids = ["family", "word", "bit"]
    in_word = Window.partitionBy("family", "word").orderBy("bit").rowsBetween(Window.unboundedPreceding, -1)
    per_id = distinct.groupBy(*ids).agg(F.sum("n").alias("n"))
    id_start = per_id.select(*ids, F.coalesce(F.sum("n").over(in_word), F.lit(0)).alias("id_start"))
    heads = scratch.write(distinct.groupBy(*ids, "head").agg(F.sum("n").alias("n")), "repeated-heads")
    head_start = count_before(scratch, heads, ids, "head", "heads").select(*ids, "head", F.col("before").alias("head_start"))
    # Other hashes with the same first digits: one or none.
    in_head = Window.partitionBy(*ids, "head").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    within = distinct.withColumn("within", F.coalesce(F.sum("n").over(in_head), F.lit(0)))
    first = F.col("before") + F.col("id_start") + F.col("head_start") + F.col("within")
    known = scratch.write(within.join(id_start, ids).join(head_start, [*ids, "head"]).withColumn("first", first), "repeated-places")
    columns = ["family", "hash", "shown", "doc_id"]
    block = 1 << 16
    blocks = known.withColumn("block", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / block).cast("long"))))
    dealt = blocks.select(*columns, (F.col("first") + F.col("block") * block).alias("from"), F.least(F.lit(block), F.col("n") - F.col("block") * block).alias("size")).repartition("hash", "from")
    return dealt.select(*columns, F.explode(F.sequence("from", F.col("from") + F.col("size") - 1)).alias("place"))


# ---------------------------------------------------------------- levels


def climb(scratch: Scratch, nodes: DataFrame, fan_out: int, carry: list[str], name: str) -> list[DataFrame]:
    """Runs of every level: (family, run, slots), slots being up to ``fan_out`` nodes in order. The last run of a family with one slot is its root."""
    slot = F.struct(F.pmod("place", F.lit(fan_out)).cast("int").alias("slot"), "hash", *carry)
    levels = [_runs(scratch, nodes, slot, fan_out, f"{name}-0")]
    while True:
        # Only a family's sole node is alone in its first run.
        open_runs = levels[-1].filter((F.col("run") > 0) | (F.size("slots") > 1))
        if open_runs.isEmpty():
            return levels
        parents = open_runs.select("family", F.col("run").alias("place"), F.sha2(_joined(F.col("slots")), 256).alias("hash"))
        levels.append(_runs(scratch, parents, F.struct(F.pmod("place", F.lit(fan_out)).cast("int").alias("slot"), "hash"), fan_out, f"{name}-{len(levels)}"))


def _runs(scratch: Scratch, nodes: DataFrame, slot: Column, fan_out: int, name: str) -> DataFrame:
    return scratch.write(nodes.groupBy("family", F.expr(f"place div {fan_out}").alias("run")).agg(F.sort_array(F.collect_list(slot)).alias("slots")), name)


def _alone() -> Column:
    return (F.col("run") == 0) & (F.size("slots") == 1)


def _top_of(levels: list[DataFrame]) -> DataFrame:
    """The node of every family that has no sibling left: (family, hash)."""
    tops = [runs.filter(_alone()).select("family", F.col("slots")[0]["hash"].alias("hash")) for runs in levels]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def descend(scratch: Scratch, levels: list[DataFrame], roots: DataFrame | None, fan_out: int, name: str) -> DataFrame:
    """Nodes of the lowest level with ``place`` and ``path``; the columns of ``roots`` (by family) are handed down too."""
    handed = [c for c in roots.columns if c != "family"] if roots is not None else []
    own_place = (F.col("run") * fan_out + F.col("node.slot")).alias("place")
    siblings = F.struct(
        _joined(F.slice("slots", F.lit(1), F.col("at"))).alias("before"),
        _joined(F.slice("slots", F.col("at") + 2, F.size("slots"))).alias("after"),
    )
    path = F.when(_alone(), F.col("path_above")).otherwise(F.concat(F.array(siblings), "path_above"))
    upper = None
    for level in reversed(range(len(levels))):
        runs = levels[level]
        known = runs.filter(_alone()).withColumn("path_above", F.array().cast("array<struct<before:string,after:string>>"))
        if roots is not None:
            known = known.join(roots, "family")
        if upper is not None:
            known = known.unionByName(runs.filter(~_alone()).join(upper, ["family", "run"]))
        nodes = known.select("*", F.posexplode("slots").alias("at", "node"))
        if level:
            upper = scratch.write(nodes.select("family", own_place.alias("run"), path.alias("path_above"), *handed), f"{name}-paths-{level}")
    return nodes.select("family", "node.*", own_place, path.alias("path"), *handed)


def _joined(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda s: s["hash"]), "")

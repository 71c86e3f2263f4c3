"""Near-duplicate groups by bottom-k sketches, with exact confirmation.

A text's set is its distinct word shingles as 64-bit hashes; its sketch is the k
smallest, from the one hash function the shingles already have. Texts with equal sets
form a class with one representative; only representatives are compared.

Candidates come from inverted lists of retained values. Two sets of similarity t share
at least ``need`` of their k values but for a chance below ``MISS``, so after ordering
each sketch by how common its values are, rarest first, they share one of the first
``k - need + 1``; only those are listed. (Sets of k or fewer are complete, and the bound is exact.)

A short list (``SHORT``) gives all its pairs. A longer one (copies of one text
with changes, or a very common passage) is never paired out. Its texts are compared
with a leader, the text with the most common values. Let D be the largest symmetric
difference two linked sets can have. From their differences from the leader alone the similarity of any two of its texts
follows exactly, so a family of up to ``FAMILY`` texts is settled in one task without
making pairs, and a larger one by comparing blocks of it with each other, if its differences fill no more than ``BLOCKS``
blocks. In a still larger one, a text that differs from the leader in more than D hashes
can only be linked to texts that share more than half of *their* difference with it, so
the family is listed again by the rarest part of the differences, and the same steps are
applied to these lists (of lists with the same members to one), unless a text stands in more of them than the family has blocks. Texts
linked to the leader are in one group already and need nothing among themselves. No link is lost.

Pairs are dropped if the union of their sketches contradicts the threshold, the rest
is confirmed on the full sets, and groups are the connected components of the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import ceil, comb, floor

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import Scratch, map_arrow, may_be_among, prepare
from shelfline.llm.text import NON_BLANK, chunks, mix, texts_of, words_of

#: Retained values per text. More of them would make fewer false candidates, but every one is shuffled.
K = 32
MISS = 1e-9
#: Most texts of a first list that is paired out, and of a family that one task settles.
SHORT, FAMILY = 12, 1024
#: Bytes of differences in a block of a larger family, and most blocks of a family that is not listed again.
BLOCK, BLOCKS = 4 << 20, 16
#: Looking two differences through for common hashes takes as long as counting so many texts that hold one.
_PAIR = 4096
_COUNTER_BITS = 20
_COUNTER_BLOCK = 1 << 12


def shared_at_least(k: int, threshold: float) -> int:
    """Values two sketches of size k share, but for a chance below MISS, if the sets have that similarity."""
    need, tail = k, threshold**k
    while need > 1 and 1 - tail > MISS:
        need -= 1
        tail += comb(k, need) * threshold**need * (1 - threshold) ** (k - need)
    return need


def sets_of(texts: list[bytes | None], shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    out = []
    for _, run in chunks(texts):
        words = words_of(run, NON_BLANK, lower=True)
        hashes, _ = words.shingles(shingle)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if b - a >= shingle:
                out.append(np.unique(hashes[a : b - shingle + 1]))
            elif b > a:
                factor = [pow(0xD6E8FEB86659FD93, j, 1 << 64) for j in range(b - a)]
                out.append(mix((words.hash[a:b] * np.array(factor, np.uint64)).sum(keepdims=True)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def sketch_table(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n (set size), set_id (128 bits, null for an empty set), sketch (K smallest hashes)."""

    def sketch(batch: pa.RecordBatch) -> dict:
        sets = sets_of(texts_of(batch.column(1)), shingle)
        return {
            "doc_id": batch.column(0),
            "n": np.array([len(s) for s in sets], np.int64),
            "set_id": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            "sketch": pa.array([s[:K].tobytes() for s in sets], pa.binary()),
        }

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), sketch, "doc_id long, n long, set_id binary, sketch binary")


def _values(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint64) for v in column.to_pylist()]


def value_counters(values: DataFrame) -> np.ndarray:
    """How common the values in the one column are, in a fixed number of counters that share values by hash.

    Any order of the values is right as long as all texts use the same; the counters
    put common values last. 2 ** _COUNTER_BITS numbers reach the driver at any size.
    """
    size = 1 << _COUNTER_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            values = np.concatenate(_values(batch.column(0)))
            total += np.bincount((values & np.uint64(size - 1)).astype(np.int64), minlength=size)
        blocks = range(size // _COUNTER_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(blocks), pa.int64()), pa.array([total[b * _COUNTER_BLOCK :][:_COUNTER_BLOCK].astype("<i8").tobytes() for b in blocks])],
            ["block", "counts"],
        )

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_COUNTER_BLOCK, np.int64)
        for part in parts:
            for c in part.column("counts").to_pylist():
                total += np.frombuffer(c, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([total.tobytes()])], ["block", "counts"])

    summed = values.mapInArrow(count, "block long, counts binary").groupBy("block").applyInArrow(add, "block long, counts binary")
    out = np.zeros(size, np.int64)
    for row in summed.collect():
        out[row["block"] * _COUNTER_BLOCK :][:_COUNTER_BLOCK] = np.frombuffer(row["counts"], "<i8")
    return out


def _first_lists(reps: DataFrame, counters: np.ndarray, threshold: float) -> DataFrame:
    """lead (0), value, node, n, heat, open: each representative under its rarest sketch values."""
    need = shared_at_least(K, threshold)
    shared = reps.sparkSession.sparkContext.broadcast(counters)

    def prefix(batch: pa.RecordBatch) -> dict:
        ids, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        value, owner, size, heat = [], [], [], []
        for doc, n, sketch in zip(ids, sizes, _values(batch.column(2)), strict=True):
            common = shared.value[(sketch & np.uint64(len(shared.value) - 1)).astype(np.int64)]
            if n > K:
                length = K - need + 1
            else:
                lost = max(0, floor(n / threshold + 1e-9) - K)
                length = n - max(1, ceil(threshold * n - 1e-9) - lost) + 1
            chosen = sketch[np.lexsort((sketch, common))[:length]]
            value.append(chosen)
            owner.append(np.full(len(chosen), doc))
            size.append(np.full(len(chosen), n))
            heat.append(np.full(len(chosen), int(common.sum())))
        return {
            "lead": np.zeros(sum(map(len, value)), np.int64), "value": np.concatenate(value).view(np.int64), "node": np.concatenate(owner),
            "n": np.concatenate(size), "heat": np.concatenate(heat), "open": np.ones(sum(map(len, value)), bool),
        }

    return map_arrow(reps.select("node", "n", "sketch"), prefix, "lead long, value long, node long, n long, heat long, open boolean")


def _members(lists: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of lists that can still hold a link between texts, with the list's size and leader.

    Most values stand in one text alone; those are told by a count, before anything else is sent. Of lists with the
    same members (told by 128 bits of their hashes) one is kept: what texts share comes with many values.
    """
    keys = ["lead", "value"]
    names = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"name_{i}") for i in range(2)]
    sizes = lists.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.max(F.col("open").cast("int")).alias("any_open"), *names)
    told = sizes.where("size > 1 and any_open = 1").groupBy("lead", "size", "name_0", "name_1").agg(F.min("value").alias("value"))
    shared = scratch.write(lists.join(told.select(*keys, "size"), keys), "shared")
    # Written, so that the join is one of two tables, in which Spark can split the rows of a long list.
    leaders = scratch.write(shared.groupBy(*keys).agg(F.max_by("node", F.struct("heat", "node")).alias("leader")), "leaders")
    return shared.join(leaders, keys)


def _near_size(a: str, b: str, threshold: float) -> F.Column:
    return F.least(a, b) >= F.greatest(a, b) * threshold - 1e-6


def _short_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs of short lists that their sizes and groups leave open."""
    short = members.where(F.col("size") <= SHORT)
    one = short.select("lead", "value", F.col("node").alias("a"), F.col("n").alias("na"), F.col("open").alias("oa"))
    two = short.select("lead", "value", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("open").alias("ob"))
    pairs = one.join(two, ["lead", "value"]).where("a < b and (oa or ob)").where(_near_size("na", "nb", threshold))
    return pairs.select("a", "b").distinct()


def _star_pairs(members: DataFrame, most: int) -> DataFrame:
    """(leader, other) for every text of a long list."""
    long = members.where((F.col("size") > most) & (F.col("node") != F.col("leader")))
    return long.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()


def _sketches_agree(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose union sketch allows the threshold."""
    need = shared_at_least(K, threshold)
    one = reps.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    two = reps.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))

    def estimate(batch: pa.RecordBatch) -> dict:
        keep = []
        for a, b in zip(_values(batch.column(2)), _values(batch.column(3)), strict=True):
            union = np.union1d(a, b)[:K]
            both = int((np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)).sum())
            keep.append(both >= need if len(union) == K else both >= threshold * len(union) - 1e-9)
        return {"a": batch.column(0), "b": batch.column(1), "keep": keep}

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb")
    return map_arrow(joined, estimate, "a long, b long, keep boolean").where("keep").drop("keep")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "star", "sa", "sb")


def _linked(common: int, na: int, nb: int, percent: int) -> bool:
    return 100 * common >= percent * (na + nb - common)


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, star, linked, n, added, removed: exact verdict on each pair (a, b, star).

    For a star (a is a leader) also b's size and its differences from a.
    """

    def compare(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("linked", "n", "added", "removed")}
        for star, a, b in zip(batch.column(2).to_pylist(), _values(batch.column(3)), _values(batch.column(4)), strict=True):
            common = len(np.intersect1d(a, b, assume_unique=True))
            out["linked"].append(_linked(common, len(a), len(b), percent))
            out["n"].append(len(b))
            out["added"].append(np.setdiff1d(b, a, assume_unique=True).tobytes() if star else None)
            out["removed"].append(np.setdiff1d(a, b, assume_unique=True).tobytes() if star else None)
        out["added"], out["removed"] = (pa.array(out[k], pa.binary()) for k in ("added", "removed"))
        return {"a": batch.column(0), "b": batch.column(1), "star": batch.column(2)} | out

    return map_arrow(
        _with_sets(pairs, sets), compare, "a long, b long, star boolean, linked boolean, n long, added binary, removed binary"
    )


def _families(compared: DataFrame) -> DataFrame:
    """lead, node, n, open, delta, length, size, bytes: texts around leaders that have unlinked ones.

    delta holds the hashes added to and removed from the leader's set (of different
    kinds, so an added one never equals a removed one). With c = (1 - t) / (1 + t), linked
    sets x, y differ in at most D = c (|x| + |y|) hashes, so their deltas share at least
    (dx + dy - D) / 2. An unlinked y has dy > c (|y| + |leader|): a linked x shares more
    than (dx - c (|x| - |leader|)) / 2 with it, an unlinked one at least dy - D and one at
    all. ``length`` is how many of the rarest hashes of delta must be listed for that.
    size and bytes are those of the leader's texts and of their deltas.
    """

    def describe(batch: pa.RecordBatch) -> dict:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        delta, length = [], []
        for _, _, linked, n, added, removed, t in zip(*columns, strict=True):
            plus, minus = np.frombuffer(added, np.uint64), np.frombuffer(removed, np.uint64)
            both = np.sort(np.concatenate((plus, mix(minus ^ np.uint64(0x5555555555555555)))))
            c = (1 - t) / (1 + t)
            if linked:
                length.append(len(both) - floor((len(both) - c * max(0, len(plus) - len(minus))) / 2 - 1e-9))
            else:
                length.append(floor(c * (n + n / t) + 1e-9) + 1)
            delta.append(both.tobytes())
        return {
            "lead": batch.column(0), "node": batch.column(1), "n": batch.column(3),
            "open": pa.compute.invert(batch.column(2)), "delta": delta, "length": length,
        }

    sizes = (
        compared.groupBy("a")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.sum(F.octet_length("added") + F.octet_length("removed")).alias("bytes"),
            F.max((~F.col("linked")).cast("int")).alias("any_open"),
        )
        .where("any_open = 1")
    )
    around = compared.join(sizes.select("a"), "a")
    described = map_arrow(around, describe, "lead long, node long, n long, open boolean, delta binary, length long")
    return described.join(sizes.select(F.col("a").alias("lead"), "size", "bytes"), "lead")


def _block_count() -> F.Column:
    return F.when(F.col("size") > FAMILY, F.greatest(F.ceil(F.col("bytes") / BLOCK), F.lit(1))).otherwise(1)


def _too_large() -> F.Column:
    """Families that are listed again."""
    return (F.col("size") > FAMILY) & (F.col("bytes") > BLOCK * BLOCKS)


def _blocks(families: DataFrame) -> DataFrame:
    """lead, one, two, side, ...: two blocks of a family each time, every pair of them once, and each alone; small families are one block."""
    dealt = families.withColumn("side", F.pmod(F.xxhash64("node"), _block_count()))
    beside = dealt.withColumn("beside", F.explode(F.sequence(F.lit(0).cast("long"), _block_count() - 1)))
    return beside.withColumn("one", F.least("side", "beside")).withColumn("two", F.greatest("side", "beside"))


def _crowded(members: DataFrame, families: DataFrame) -> DataFrame:
    """lead: families whose texts stand in more lists on average than the family has blocks."""
    sizes = families.groupBy("lead").agg(F.first("size").alias("size"), F.first("bytes").alias("bytes"))
    listed = members.groupBy("lead").agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(sizes, "lead").where(F.col("rows") > F.col("size") * _block_count()).select("lead")


def _lists(large: DataFrame) -> DataFrame:
    """Families listed by the rarest hashes of their differences; leaders are texts that differ by what many share.

    As for the first lists, counters of fixed number say how common a hash is, and only the hashes listed leave a task, without the differences.
    """
    shared = large.sparkSession.sparkContext.broadcast(value_counters(large.select("delta")))

    def rarest(batch: pa.RecordBatch) -> dict:
        value, times, heat = [], [], []
        for delta, length in zip(_values(batch.column(4)), batch.column(5).to_pylist(), strict=True):
            common = shared.value[(delta & np.uint64(len(shared.value) - 1)).astype(np.int64)]
            chosen = delta[np.lexsort((delta, common))[:length]]
            value.append(chosen)
            times.append(len(chosen))
            heat.append(int(1000 * common.mean()) if len(common) else 0)
        rows = pa.array(np.repeat(np.arange(len(times)), times))
        out = {k: batch.column(i).take(rows) for i, k in enumerate(("lead", "node", "n", "open"))}
        return out | {"heat": np.repeat(heat, times), "value": np.concatenate(value).view(np.int64)}

    return map_arrow(large.select("lead", "node", "n", "open", "delta", "length"), rarest, "lead long, value long, node long, n long, heat long, open boolean")


def _settle(groups: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links of bounded groups (columns node, n, open, delta, length, side) with an open text; enough of them to join what is linked.

    An open text is compared with those that hold one of the ``length`` rarest hashes of its difference, which all texts linked with it do.
    Where a group has two sides, texts of one side are compared in a group of their own.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        columns = ("node", "n", "open", "length", "side")
        node, n, is_open, length, side = (np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in columns)
        deltas = [d for p in parts for d in _values(p.column("delta"))]
        size = np.array([len(d) for d in deltas])
        starts = np.cumsum(size) - size
        _, token, copies = np.unique(np.concatenate(deltas), return_inverse=True, return_counts=True)
        order = np.argsort(token, kind="stable")
        bounds = np.concatenate(([0], np.cumsum(copies)))
        by_token = np.repeat(np.arange(len(deltas)), size)[order]
        across = side.min() != side.max()
        group = np.arange(len(deltas))  # texts joined so far share a number
        group[~is_open] = -1  # those linked to the leader are one group already
        found: list[tuple[int, int]] = []

        def holders(tokens: np.ndarray) -> np.ndarray:
            return np.concatenate([by_token[a:b] for a, b in zip(bounds[tokens].tolist(), bounds[tokens + 1].tolist(), strict=True)])

        for i in np.flatnonzero(is_open).tolist():
            mine = token[starts[i] : starts[i] + size[i]]
            rare = mine[np.lexsort((mine, copies[mine]))[: length[i]]]
            rare = rare[copies[rare] > 1]
            if not len(rare):
                continue
            held = np.zeros(len(deltas), bool)
            held[holders(rare)] = True
            held &= group != group[i]
            if across:
                held &= side != side[i]
            near = np.flatnonzero(held)
            if not len(near):
                continue
            if copies[mine].sum() < _PAIR * len(near):
                both = np.bincount(holders(mine), minlength=len(deltas))[near]
            else:
                both = np.array([len(np.intersect1d(deltas[i], deltas[j], assume_unique=True)) for j in near.tolist()])
            twice = n[i] + n[near] - (size[i] + size[near] - 2 * both)  # twice the common hashes
            linked = near[100 * twice >= percent * (2 * (n[i] + n[near]) - twice)]
            for j in linked[np.unique(group[linked], return_index=True)[1]].tolist():
                found.append((int(node[i]), int(node[j])))
                group[group == group[j]] = group[i]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    wanted = groups.select(*keys, "node", "n", "open", "delta", "length", "side")
    return wanted.groupBy(*keys).applyInArrow(lambda table: _whole(settle, table), "a long, b long")


def _whole(function, table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(list(function(iter(table.combine_chunks().to_batches()))))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, component_id for every text in a link: the smallest id it can reach.

    Each round takes the smallest label among neighbours and then follows that label
    to its own label, so long chains shrink quickly. The labels of a round are written,
    so a lost executor costs one round at most.
    """
    edges = scratch.write(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.write(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "doc_id"), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("doc_id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["doc_id"] == near["a"]).select("doc_id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("doc_id").alias("low"), F.col("label").alias("beyond"))
        new = lower.join(jump, "low", "left").select("doc_id", F.col("label").alias("old"), F.least("low", F.coalesce("beyond", "low")).alias("label"))
        after = scratch.write(new, "labels")
        changed = after.where("label <> old").limit(1).count()
        scratch.drop(labels)
        labels = after
        if not changed:
            scratch.drop(edges)
            return labels.select("doc_id", F.col("label").alias("component_id"))


def _representatives(usable: DataFrame, scratch: Scratch) -> DataFrame:
    """node, doc_id, set_id, n, sketch: one row per distinct set, doc_id the smallest that has it.

    node is doc_id, except where one id stands for several sets: then all but the
    first get a number of their own.
    """
    classes = usable.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = scratch.write(classes, "classes")
    repeated = classes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sets"), F.min("set_id").alias("first_set")).where("sets > 1")
    if not repeated.limit(1).count():
        return classes.withColumn("node", F.col("doc_id"))
    other = (F.col("first_set").isNotNull()) & (F.col("set_id") != F.col("first_set"))
    named = classes.join(repeated.drop("sets"), "doc_id", "left")
    return scratch.write(named.withColumn("node", F.when(other, F.xxhash64("set_id", "doc_id")).otherwise(F.col("doc_id"))).drop("first_set"), "nodes")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """node, set: the whole sets of the wanted representatives (node, doc_id, set_id, again).

    Only rows whose id stands again in another row are compared to keep one of each;
    the texts of all others need no shuffle for that.
    """

    def compute(batch: pa.RecordBatch) -> dict:
        sets = [s.tobytes() for s in sets_of(texts_of(batch.column(1)), shingle)]
        same = [hashlib.blake2b(s, digest_size=16).digest() == i for s, i in zip(sets, batch.column(2).to_pylist(), strict=True)]
        return {"node": batch.column(0), "set": pa.array(sets, pa.binary()), "same": same}

    texts = may_be_among(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", wanted.select("doc_id"))

    def sets(chosen: DataFrame, once: bool) -> DataFrame:
        rows = texts.join(chosen.drop("again"), "doc_id").select("node", "text", "set_id")
        found = map_arrow(rows if once else rows.dropDuplicates(), compute, "node long, set binary, same boolean").where("same").drop("same")
        # Different texts with one set are left for the second pass.
        return found if once else found.dropDuplicates(["node"])

    return sets(wanted.where("not again"), True).union(sets(wanted.where("again"), False))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts are linked if 100 * intersection >= percent * union of their shingle sets.
    A null text or one without words has an empty set and is linked with nothing.
    Rows that share a doc_id are one node and each keeps its own row. A row without an
    id takes no part: its component is null and it is kept. Only doc_id and text are read.
    """
    spark = prepare(docs.sparkSession)
    threshold = percent / 100
    scratch = Scratch(spark, "near-dups")
    table = scratch.write(sketch_table(docs, shingle), "sketches")
    usable = table.where("n > 0 and doc_id is not null")
    reps = _representatives(usable, scratch)

    lists = scratch.write(_first_lists(reps, value_counters(reps.select("sketch")), threshold), "lists")
    members = scratch.write(_members(lists, scratch), "members")
    scratch.drop(lists)
    pairs = scratch.write(_sketches_agree(_short_pairs(members, threshold), reps, threshold), "pairs")
    stars = scratch.write(_star_pairs(members, SHORT), "stars")
    scratch.drop(members)
    ends = reduce(DataFrame.union, [t.select(F.col(c).alias("node")) for t in (pairs, stars) for c in "ab"]).distinct()
    repeated = usable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).select("doc_id", (F.col("rows") > 1).alias("again")).where("again")
    found = reps.select("node", "doc_id", "set_id").join(ends, "node").join(scratch.write(repeated, "repeated"), "doc_id", "left")
    wanted = scratch.write(found.withColumn("again", F.coalesce("again", F.lit(False))), "wanted")
    sets = scratch.write(_full_sets(docs, wanted, shingle), "sets")
    # Short pairs and stars are checked together, so that the sets are sent once.
    unsure = pairs.withColumn("star", F.lit(False)).union(stars.withColumn("star", F.lit(True)))
    compared = scratch.write(_compare(unsure, sets, percent), "compared")
    links = compared.where("linked").select("a", "b")
    around = compared.where("star")
    while not around.isEmpty():
        families = scratch.write(_families(around.drop("star").withColumn("t", F.lit(threshold))), "families")
        links = links.union(scratch.write(_settle(_blocks(families.where(~_too_large())), ["lead", "one", "two"], percent), "links"))
        large = families.where(_too_large())
        if large.isEmpty():
            scratch.drop(families)
            break
        listed = scratch.write(_members(_lists(large), scratch), "members")
        crowded = scratch.write(_crowded(listed, large), "crowded")
        links = links.union(scratch.write(_settle(_blocks(large.join(crowded, "lead", "left_semi")), ["lead", "one", "two"], percent), "links"))
        members = listed.join(crowded, "lead", "left_anti")
        inner = members.where(F.col("size") <= FAMILY).select("lead", "value", "node", "n", "open").join(large.select("lead", "node", "delta", "length"), ["lead", "node"])
        links = links.union(scratch.write(_settle(inner.withColumn("side", F.lit(0).cast("long")), ["lead", "value"], percent), "links"))
        stars = scratch.write(_star_pairs(members, FAMILY), "stars")
        scratch.drop(families, listed, crowded)
        if stars.isEmpty():
            break
        around = scratch.write(_compare(stars.withColumn("star", F.lit(True)), sets, percent), "compared")
        links = links.union(around.where("linked").select("a", "b"))
    scratch.drop(sets)
    return _grouped(table, reps, links, scratch)


def _grouped(table: DataFrame, reps: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Give every row the smallest id of its group: its class's, then that of the classes linked with it."""
    doc_of = reps.where("node <> doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("as_doc"))
    ids = links
    for c in "ab":
        ids = ids.join(doc_of.withColumnRenamed("a", c), c, "left").withColumn(c, F.coalesce("as_doc", c)).drop("as_doc")
    # A row's class is stood for by the smallest id with the same text; ids with several texts tie their classes.
    first = reps.select("set_id", F.col("doc_id").alias("class_id"))
    rows = scratch.write(table.select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(first, "set_id", "left").drop("set_id"), "rows")
    several = (
        rows.where("class_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z")).where("a <> z").select("doc_id")
    )
    ties = rows.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    groups = components(ids.union(ties).where("a <> b"), scratch).select(F.col("doc_id").alias("class_id"), "component_id")
    out = rows.join(groups, "class_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "class_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each_group(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that are not kept, all columns as they were.

    Rows that repeat a kept doc_id all stay, as do rows without an id.
    """
    gone = near_duplicates(docs, shingle, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")

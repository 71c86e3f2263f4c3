"""Mixing sources to target weights by hierarchical budgeting.

Documents sit at the leaves of a tree (by default domain, language, source). The
token budget is handed down level by level. Among the children of a node it is
shared by weight; a child that cannot use its share, because all its leaves together
hold no more than ``max_epochs`` times their tokens, is filled, and what is left goes
to its siblings by weight. As a child's capacity counts its whole subtree, a shortage
reaches the siblings of a node first and its ancestors only when the siblings are full.

A leaf reads its documents in epochs, each in a seeded order of its own, and takes the
first tokens up to its budget: whole epochs, then a prefix of the next one.

All amounts are whole tokens; shares are rounded so that they add up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.llm.common import Scratch, prepare

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
_PREFIX = 3  # hexadecimal digits of the order key that make a slice: 4096 slices per leaf


def word_count(text: Column) -> Column:
    """Words between blanks (x20, x09-x0D), the unit of the budget."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """The seeded order of an epoch: the MD5 of "seed:epoch:doc_id"."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def leaf_budgets(leaves: DataFrame, levels: tuple[str, ...], weight: Callable[[str, Column], Column], budget: Column, max_epochs: int) -> DataFrame:
    """Leaves (levels..., tokens) with the tokens each may take (budget).

    ``weight(level, name)`` is a positive whole number. Products of a budget and the
    weights of one node's children must stay below 2 ** 63.
    """
    total = leaves.agg(F.sum("tokens").alias("all")).select(F.least(budget, F.col("all") * max_epochs).cast("long").alias("budget"))
    top = F.lit(total.first()["budget"] or 0).cast("long")
    nodes: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        path, parent = list(levels[:depth]), list(levels[: depth - 1])
        children = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("capacity"))
        children = children.withColumn("budget", top) if nodes is None else children.join(nodes, parent)
        nodes = _shared(children, parent, path[-1], weight)
    return leaves.join(nodes, list(levels))


def _shared(children: DataFrame, parent: list[str], level: str, weight: Callable[[str, Column], Column]) -> DataFrame:
    """Share each parent's budget (column budget) among its children (column capacity) by weight."""
    rows = children.withColumn("weight", weight(level, F.col(level)).cast("long"))
    family = Window.partitionBy(*parent)
    # The children that fill up first come first.
    line = family.orderBy(F.col("capacity") / F.col("weight"), level)
    rows = (
        rows.withColumn("weight_from", F.sum("weight").over(family) - F.sum("weight").over(line) + F.col("weight"))
        .withColumn("budget_from", F.col("budget") - F.sum("capacity").over(line) + F.col("capacity"))
        .withColumn("full", F.col("capacity") * F.col("weight_from") <= F.col("weight") * F.col("budget_from"))
    )
    open_weight = F.when(~F.col("full"), F.col("weight")).otherwise(0)
    rows = (
        rows.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(family))
        .withColumn("open_weight", F.sum(open_weight).over(family))
        .withColumn("upto", F.sum(open_weight).over(line))
    )
    share = F.expr("(rest * upto) div nullif(open_weight, 0) - (rest * (upto - weight)) div nullif(open_weight, 0)")
    return rows.select(*parent, level, F.when(F.col("full"), F.col("capacity")).otherwise(share).alias("budget"))


def _described(domain: Column) -> list[Column]:
    """doc_id, the three levels and n_tokens of a document; a missing name is "(none)"."""
    names = zip(LEVELS, (domain, F.col("lang"), F.col("source")), strict=True)
    levels = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in names]
    return [F.col("doc_id"), *levels, word_count(F.col("text")).alias("n_tokens")]


def _plan(table: DataFrame, weight: Callable[[str, Column], Column], share: float, max_epochs: int, seed: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The leaves with budgets and epochs, and the documents at the end of each leaf's prefix.

    The prefix is found from sums over slices of the seeded order, so only the slice
    that holds its end is sorted document by document.
    """
    levels = list(LEVELS)
    leaves = scratch.write(table.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    budget = F.floor(F.col("all") * F.lit(share)).cast("long")
    planned = leaf_budgets(leaves, LEVELS, weight, budget, max_epochs)
    planned = scratch.write(
        planned.withColumn("epochs", F.coalesce(F.expr("budget div nullif(tokens, 0)"), F.lit(0).cast("long"))).withColumn(
            "rest", F.col("budget") - F.col("epochs") * F.col("tokens")
        ),
        "planned",
    )
    keyed = _keyed(table, planned, seed)
    sums = keyed.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    upto = F.sum("n").over(Window.partitionBy(*levels).orderBy("slice"))
    ends = scratch.write(
        sums.withColumn("before", upto - F.col("n")).where("before < rest and before + n >= rest").select(*levels, F.col("slice").alias("end_slice"), "before"),
        "ends",
    )
    leaves = planned.join(ends, levels, "left")
    last = _keyed(table, leaves, seed).where("slice = end_slice")
    run = Window.partitionBy(*levels).orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("left", F.col("rest") - F.col("before") - F.sum("n_tokens").over(run) + F.col("n_tokens"))
    last = last.withColumn("part", F.greatest(F.lit(0), F.least("n_tokens", "left"))).withColumn("in_prefix", F.col("left") > 0)
    return leaves, scratch.write(last.drop("left"), "last")


def _keyed(table: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    key = order_key(seed, F.col("epochs"), F.col("doc_id"))
    return table.join(leaves, list(LEVELS)).withColumn("key", key).withColumn("slice", F.substring("key", 1, _PREFIX))


def mix_sources(
    docs: DataFrame, domain: Column, weight: Callable[[str, Column], Column], share: float = 0.5, max_epochs: int = 2, seed: int = 7
) -> DataFrame:
    """One row per chosen document: doc_id, domain, lang, source, n_tokens, copies, tokens.

    The budget is ``share`` of all tokens (words). ``copies`` says in how many epochs
    the document is read, ``tokens`` how many of its tokens are taken in all: the last
    document of a leaf's prefix may be cut. A null text has no tokens, it is copied
    with its epochs. A null level is "(none)". Repeated rows are separate documents;
    equal ids follow each other by length. The levels come from the columns lang and
    source and the expression ``domain``; other columns are not read.
    """
    scratch = Scratch(prepare(docs.sparkSession), "mixing")
    table = scratch.write(docs.select(*_described(domain)), "documents")
    leaves, last = _plan(table, weight, share, max_epochs, seed, scratch)
    rows = _keyed(table, leaves, seed).where("end_slice is null or slice <> end_slice")
    inside = F.coalesce(F.col("slice") < F.col("end_slice"), F.lit(False))
    whole = rows.withColumn("part", F.when(inside, F.col("n_tokens")).otherwise(0)).withColumn("in_prefix", inside)
    columns = ["doc_id", *LEVELS, "n_tokens", "epochs", "part", "in_prefix"]
    chosen = whole.select(*columns).unionByName(last.select(*columns))
    return (
        chosen.withColumn("copies", F.col("epochs") + F.col("in_prefix").cast("long"))
        .where("copies > 0")
        .select("doc_id", *LEVELS, "n_tokens", "copies", (F.col("epochs") * F.col("n_tokens") + F.col("part")).alias("tokens"))
    )


def keep_mixed(
    docs: DataFrame, domain: Column, weight: Callable[[str, Column], Column], share: float = 0.5, max_epochs: int = 1, seed: int = 7
) -> DataFrame:
    """The documents whose leaf's budget reaches them, each once and whole, all columns kept.

    A leaf's cut is the order key of its last document, so documents are only joined
    with the short list of leaves. Rows equal in id and length to the last one stay with it.
    """
    scratch = Scratch(prepare(docs.sparkSession), "mixing")
    table = scratch.write(docs.select(*_described(domain)), "documents")
    leaves, last = _plan(table, weight, share, max_epochs, seed, scratch)
    cut = F.max(F.struct("key", "doc_id", "n_tokens"))
    cuts = last.where("in_prefix").groupBy(*LEVELS).agg(cut.alias("cut"))
    leaves = scratch.write(leaves.join(cuts, list(LEVELS), "left").select(*LEVELS, "epochs", "end_slice", "cut"), "cuts")
    scratch.drop(table)
    rows = _keyed(docs.select(F.struct("*").alias("row"), *_described(domain)), leaves, seed)
    reached = F.coalesce(F.struct("key", "doc_id", "n_tokens") <= F.col("cut"), F.lit(False))
    return rows.where((F.col("epochs") > 0) | reached).select("row.*")

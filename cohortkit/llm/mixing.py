"""Mixing sources to target weights, by budgets that run down a tree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortkit.llm.common import rows_of
from cohortkit.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
# Leading hex digits of the draw that make a range: 16**3 ranges a leaf, and as many more
# of the range that a prefix ends in while it has more draws than RANGE_ROWS.
RANGE_DIGITS = 3
RANGE_ROWS = 1_000_000
BIG = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def _join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Joined where all the named columns are equal; NULL equals NULL."""
    other = {c: f"other_{c}" for c in names}
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(o)) for c, o in other.items()])
    return left.join(right.withColumnsRenamed(other), same, how).drop(*other.values())


def _share(children: DataFrame, parents: DataFrame | None, level: int, total: int | None) -> DataFrame:
    """Budgets of one level: each parent's budget goes to its children by weight; what a
    child cannot use goes to its siblings, by weight again, until all are full."""
    above = [f"level{i}" for i in range(level)]
    if parents is None:
        rows = children.withColumn("pot", F.lit(total).cast(BIG))
    else:
        rows = _join(children, parents.select(*above, F.col("budget").alias("pot")), above)
    # Children that fill up come first; `pot` and weight left before a child decide
    # whether it fills up too.
    order = [(F.col("room").cast("double") / F.col("weight").cast("double")).asc(), F.col(f"level{level}").asc_nulls_first()]
    siblings = Window.partitionBy(*above).orderBy(*order)
    before = siblings.rowsBetween(Window.unboundedPreceding, -1)
    after = siblings.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast(BIG)
    rows = rows.select(
        "*",
        (F.col("pot") - F.coalesce(F.sum("room").over(before), zero)).cast(BIG).alias("pot_left"),
        F.sum("weight").over(after).cast(BIG).alias("weight_left"))
    fills = F.col("room") * F.col("weight_left") <= F.col("pot_left") * F.col("weight")
    rows = rows.withColumn("fills", fills)
    everyone = Window.partitionBy(*above)
    # Where the first child does not fill up, the rest share what is left there.
    rows = rows.select(
        "*",
        F.max(F.when(~F.col("fills"), F.struct("weight_left", "pot_left"))).over(everyone).alias("rest"))
    budget = F.when(F.col("fills"), F.col("room")).otherwise(
        F.expr("(rest.pot_left * weight) div rest.weight_left"))
    names = [*above, f"level{level}"]
    return rows.select(*names, "room", budget.cast(BIG).alias("budget"))


def leaf_budgets(leaves: DataFrame, depth: int, weights: Mapping[tuple, int], total: int, max_epochs: int = 1) -> DataFrame:
    """Token budgets of the leaves (level0.., tokens): level0.., tokens, budget.

    ``weights`` gives positive integers by path, from the root down; a path that is not
    named weighs 1 and weight 0 gets nothing. A leaf's room is its tokens times
    ``max_epochs``, an inner node's the room of its leaves, so a shortage is made good by
    siblings first and reaches an ancestor's siblings only when all siblings are full.
    Budgets are whole tokens, rounded down. The table has one row per leaf; the windows
    run over the children of one node.
    """
    named = [f"level{i}" for i in range(depth)]
    leaves = leaves.withColumn("room", (F.col("tokens") * max_epochs).cast(BIG))
    parents = None
    for level in range(depth):
        path = named[: level + 1]
        weight = F.lit(1)
        for key, value in weights.items():
            if len(key) == level + 1:
                same = F.lit(True)
                for column, part in zip(path, key):
                    same = same & F.col(column).eqNullSafe(F.lit(part))
                weight = F.when(same, F.lit(int(value))).otherwise(weight)
        children = (leaves.groupBy(*path).agg(F.sum("room").cast(BIG).alias("room"))
                    .withColumn("weight", weight.cast(BIG)).where("weight > 0"))
        parents = _share(children, parents, level, total)
    return _join(leaves, parents.select(*named, "budget"), named).select(
        *named, "tokens", F.col("budget").cast("bigint").alias("budget"))


def mixing_plan(rows: DataFrame, names: Sequence[str], weights: Mapping[tuple, int], budget_share: float,
                budget: int | None, max_epochs: int, seed: int) -> DataFrame:
    """One row per leaf: the levels, ``whole`` (full passes) and ``cut`` (in the next pass
    documents with a draw up to it are taken; NULL: none).

    ``rows`` (doc_id, tokens, levels) are read twice. The prefix of a pass needs no sort of
    a leaf: token sums per leaf and 1/4096 of the draws tell in which range it ends, and
    only that range is ordered, so a leaf with a third of all rows is as cheap as others.
    A range of very many draws is narrowed again. Rows of one draw (repeated ids) share their
    fate and are summed in the tasks that read them, so they never meet in one task.
    """
    leaves = materialize(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    if budget is None:
        everything = leaves.agg(F.sum(F.col("tokens").cast(BIG))).first()[0] or 0
        budget = int(everything) * int(round(budget_share * 1_000_000)) // 1_000_000
    budgets = leaf_budgets(leaves, len(names), weights, budget, max_epochs)
    passes = materialize(budgets.select(
        *names,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(max_epochs)).cast("bigint").alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(F.lit(0)).cast("bigint").alias("rest")))
    drawn = _join(rows, passes, names).withColumn("draw", _draw(seed))
    near, digits = drawn.withColumnRenamed("rest", "left"), RANGE_DIGITS
    while True:
        bucket = F.substring("draw", 1, digits)
        sums = near.withColumn("bucket", bucket).groupBy(*names, "bucket").agg(
            F.sum("tokens").alias("size"), F.first("left").alias("left"), F.approx_count_distinct("draw").alias("draws"))
        upto = F.sum("size").over(Window.partitionBy(*names).orderBy("bucket"))
        ends = materialize(  # the range in which the prefix ends: the first that does not fit whole
            sums.withColumn("upto", upto).where("upto > left").groupBy(*names)
            .agg(F.min(F.struct("bucket", (F.col("left") - F.col("upto") + F.col("size")).alias("left"), "draws")).alias("end"))
            .select(*names, F.col("end.bucket").alias("end_bucket"), F.col("end.left").alias("left"), F.col("end.draws").alias("draws")))
        near = _join(near.drop("left"), ends.drop("draws"), names).where(bucket == F.col("end_bucket"))
        if (ends.agg(F.max("draws")).first()[0] or 0) <= RANGE_ROWS or digits >= 30:
            break
        near, digits = materialize(near.drop("end_bucket")), digits + RANGE_DIGITS
    merged = near.groupBy(*names, "draw").agg(
        F.sum("tokens").alias("tokens"), F.first("left").alias("left"), F.first("end_bucket").alias("end_bucket"))
    running = F.sum("tokens").over(Window.partitionBy(*names).orderBy("draw"))
    inside = (merged.withColumn("running", running)
              .groupBy(*names).agg(F.max(F.when(F.col("running") <= F.col("left"), F.col("draw"))).alias("last"),
                                   F.first("end_bucket").alias("end_bucket")))
    # Every draw of an earlier range is smaller than the digits of the last one.
    cuts = inside.select(*names, F.coalesce("last", "end_bucket").alias("cut"))
    return materialize(_join(passes.select(*names, "whole"), cuts, names, "left"))


def _draw(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), "whole", "doc_id").cast("binary"))


def _epochs(seed: int) -> Column:
    return F.col("whole") + F.coalesce((_draw(seed) <= F.col("cut")).cast("bigint"), F.lit(0))


def _rows(docs: DataFrame, levels: Sequence[Column], tokens: Column | None, id_col: str, text_col: str) -> DataFrame:
    count = n_words(F.col(f"`{text_col}`")) if tokens is None else tokens
    return materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), count.cast("bigint").alias("tokens"),
        *[c.cast("string").alias(f"level{i}") for i, c in enumerate(levels)]))


def mix(
    docs: DataFrame, levels: Sequence[Column], weights: Mapping[tuple, int], budget_share: float = 1.0,
    budget: int | None = None, max_epochs: int = 1, seed: int = 0, tokens: Column | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per selected input row: doc_id, level0.., tokens, epochs (times it is taken).

    ``levels`` are the tree from its root down to the source, e.g. domain, language,
    source. The total is ``budget`` tokens or ``budget_share`` of all tokens; tokens are
    words unless a column is given. A leaf with a budget of q whole passes and r tokens
    takes every document q times and, in the order of the hash of (seed, pass q, id), the
    longest prefix whose tokens sum to r or less. NULL levels are nodes of their own; a
    NULL text has no tokens, and in a leaf without any all documents are taken in every
    pass; rows with equal ids are taken or left together. An empty table gives no rows.

    Budgets come from one merged row per leaf, and each document meets its leaf's row.
    """
    names = [f"level{i}" for i in range(len(levels))]
    rows = _rows(docs, levels, tokens, id_col, text_col)
    plan = mixing_plan(rows, names, weights, budget_share, budget, max_epochs, seed)
    return (_join(rows, plan, names).withColumn("epochs", _epochs(seed)).where("epochs > 0")
            .select("doc_id", *names, "tokens", "epochs"))


def mixed_documents(
    docs: DataFrame, levels: Sequence[Column], weights: Mapping[tuple, int], budget_share: float = 1.0,
    budget: int | None = None, max_epochs: int = 1, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows that ``mix`` selects, with all their columns, once for each epoch.

    Texts are not shuffled unless the table of leaves is too large to broadcast.
    """
    names = [f"level{i}" for i in range(len(levels))]
    plan = mixing_plan(_rows(docs, levels, None, id_col, text_col), names, weights, budget_share, budget, max_epochs, seed)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       *[c.cast("string").alias(n) for c, n in zip(levels, names)])
    taken = _join(held, plan, names).withColumn("epochs", _epochs(seed)).where("epochs > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("epoch")).select("row.*")

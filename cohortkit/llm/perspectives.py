"""Chat formatting: a dialogue from the side of each of its speakers (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.llm.common import rows_of
from cohortkit.operators.running import running_totals
from cohortkit.session import materialize

PART_TURNS = 64
# A part with more rows than this (repeated turn numbers, missing ids) comes in chunks.
PART_ROWS = 1024
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>"
# The part of rows without a turn number, before that of any turn.
_LOOSE_PART = -(1 << 63)
# Different rows of over-full parts that one task may number.
_RANGE_ROWS = 1 << 16


def _content(text: Column) -> Column:
    """The text with the template's own marks defused."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("<|_im_"))


def _in_chunks(rows: DataFrame, part_rows: int) -> DataFrame:
    """Adds ``chunk``: 0, or in a part of more than ``part_rows`` rows the row's number in
    the order of turn, speaker and content, divided by ``part_rows``. Equal rows are
    counted first and numbered as one row, so that only different rows are ordered, by
    ranges; a row whose copies reach over several chunks is dealt to each."""
    full = materialize(
        rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_rows)
        .select(F.col("conv_id").alias("full_conv"), F.col("part").alias("full_part"),
                F.monotonically_increasing_id().alias("full_no")))
    if full.isEmpty():
        return rows.withColumn("chunk", F.lit(0).cast("bigint"))
    same = F.col("conv_id").eqNullSafe(F.col("full_conv")) & (F.col("part") == F.col("full_part"))
    rows_ = rows.join(full, same, "left")
    calm = rows_.where("full_no IS NULL").select(*rows.columns, F.lit(0).cast("bigint").alias("chunk"))
    equal = materialize(rows_.where("full_no IS NOT NULL").groupBy(*rows.columns, "full_no").agg(F.count(F.lit(1)).alias("n")))
    placed = running_totals(
        equal.withColumn("place", F.struct("turn", "speaker", "content")), "place", {"upto": "n"}, within=["full_no"],
        single_task_rows=_RANGE_ROWS)
    size, begin = F.lit(part_rows).cast("bigint"), F.col("upto") - F.col("n")
    pieces = placed.withColumn("chunk", F.explode(F.expr(
        f"sequence((upto - n) div {int(part_rows)}, (upto - 1) div {int(part_rows)})")))
    copies = F.least(F.col("upto"), (F.col("chunk") + 1) * size) - F.greatest(begin, F.col("chunk") * size)
    dealt = pieces.select(
        *rows.columns, "chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias("copy")).drop("copy")
    return calm.unionByName(dealt)


def render_perspectives(
    turns: DataFrame, part_turns: int = PART_TURNS, conv_col: str = "conv_id", turn_col: str = "turn",
    speaker_col: str = "role", text_col: str = "text", part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row per dialogue, speaker, part and chunk: conv_id, perspective, part, chunk,
    n_turns, n_own_turns, text, mask.

    For every speaker but ``system`` the whole dialogue is rendered with that speaker as
    the assistant and the others as users with their names; system turns stay system
    turns. ``mask`` lists what to train on, the speaker's own contents with their end
    marks, as start:end in characters of ``text``, joined by commas. A dialogue comes in
    parts of ``part_turns`` turn numbers, so that no row or task holds a dialogue of any
    length; the parts in their order are the whole dialogue. Only where more than
    ``part_rows`` rows share a part (turn numbers that repeat, rows without a dialogue id)
    is it cut into chunks of ``part_rows`` rows, which in their order are the whole part;
    elsewhere chunk is 0.

    Turns with equal numbers follow by speaker and text, repeated rows are all rendered.
    A NULL text is empty; a NULL speaker is a user without a name and has no perspective;
    a NULL dialogue id is a dialogue of its own; rows without a turn number are a part before
    all others, in the order of speaker and text. A dialogue without speakers, like an empty table, gives no
    rows. Marks of the template inside a text are defused; names keep letters, digits,
    _ and -.

    Turns meet in parts first (a few rows per shuffle key); parts then meet the speakers
    of their dialogue in a join that adaptive execution splits at a long dialogue. The result
    is each dialogue once for every speaker in it, so rows without a dialogue id, which are one
    dialogue, come back as often as there are speakers among them.
    """
    rows = rows_of(turns, conv_id=conv_col, turn=turn_col, speaker=speaker_col, text=text_col)
    loose = F.lit(_LOOSE_PART).cast("bigint")
    rows = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "speaker", _content(F.col("text")).alias("content"),
        F.coalesce(F.floor(F.col("turn") / part_turns).cast("bigint"), loose).alias("part"))
    speakers = (rows.where(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM))
                .select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct())
    parts = _in_chunks(rows, part_rows).groupBy("conv_id", "part", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("turn", "speaker", "content"))).alias("turns"))
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))

    def rendered(t: Column) -> Column:
        own = F.coalesce(t["speaker"] == F.col("perspective"), F.lit(False))
        name = F.regexp_replace(t["speaker"], "[^A-Za-z0-9_-]", "_")
        head = F.concat(
            F.lit(START),
            F.when(own, F.lit("assistant")).when(t["speaker"] == SYSTEM, F.lit(SYSTEM))
            .when(t["speaker"].isNull(), F.lit("user")).otherwise(F.concat(F.lit("user name="), name)),
            F.lit("\n"))
        tail = F.concat(t["content"], F.lit(END))
        return F.struct(own.alias("own"), F.length(head).alias("head"), F.length(tail).alias("tail"),
                        F.concat(head, tail, F.lit("\n")).alias("piece"))

    both = both.withColumn("pieces", F.transform("turns", rendered))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + p["head"]
        end = begin + p["tail"]
        span = F.concat(begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(
            (end + 1).alias("at"), F.when(p["own"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate("pieces", start, step, lambda state: state["spans"])
    return both.select(
        "conv_id", "perspective", "part", "chunk", F.size("pieces").cast("bigint").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("bigint").alias("n_own_turns"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"),
        F.array_join(spans, ",").alias("mask"))

"""Maintenance of historic, lastdata and mutable tables.

Change rows have the table's columns, an order column `seq` (a struct that sorts in arrival order) and,
where needed, `change` (`delete`, `ignored` or anything else) and `present` (names of the columns the
row carries). The rows a table already holds count as older than every change. A folded row of a newest-wins table
may have a control column `greatest_time_` too: the greatest time its entity has had since it was last deleted. The row itself
need not carry that time, as a row without one may have replaced it; with that column the state can be folded again at
any point and later rows are judged as if nothing had been folded.

One entity may own a third of all rows. Nothing here gathers an entity in one task: the aggregates
combine on the map side, and the ordered folds work on bounded pieces of an entity's history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one partition offset range that are ordered together; bounds the size of a sort group.
PIECE = 1 << 17

#: Name of the control column with the greatest time of an entity.
HIGH = "greatest_time_"

_SEQ = "struct<partition:int,offset:bigint,pos:int>"


def _columns(current: DataFrame | None, changes: DataFrame, control: Sequence[str]) -> list[str]:
    if current is not None:
        return [c for c in current.columns if c != HIGH]
    return [c for c in changes.columns if c not in control]


def _control(changes: DataFrame) -> list[str]:
    return [c for c in ("seq", "change", "present", HIGH) if c in changes.columns]


def _oldest() -> Column:
    return F.struct(
        F.lit(-1).alias("partition"), F.lit(-1).cast("bigint").alias("offset"), F.lit(0).alias("pos")
    ).cast(_SEQ)


def _with_current(current: DataFrame | None, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Changes and current rows together, with `present` filled for all."""
    present = F.col("present") if "present" in changes.columns else F.array(*[F.lit(c) for c in columns])
    change = F.col("change") if "change" in changes.columns else F.lit("update")
    known = set(changes.columns)
    picked = [F.col(c) if c in known else F.lit(None).alias(c) for c in columns]
    new = changes.select(
        *picked, F.col("seq").cast(_SEQ).alias("seq"), change.alias("change"), present.alias("present"), _high_of(changes)
    )
    if current is None:
        return new
    old = current.select(
        *columns,
        _oldest().alias("seq"),
        F.lit("update").alias("change"),
        F.array(*[F.lit(c) for c in columns]).alias("present"),
        _high_of(current),
    )
    return old.unionByName(new)


def _high_of(rows: DataFrame) -> Column:
    held = F.col(HIGH) if HIGH in rows.columns else F.lit(None)
    return held.cast("timestamp").alias(HIGH)


def apply_historic(
    current: DataFrame | None, changes: DataFrame, pk: Sequence[str] = (), carry: Sequence[str] = (), piece: int = PIECE
) -> tuple[DataFrame, DataFrame]:
    """(rows to append, repeated rows with `reject`). `carry` names columns of changes that only the latter have.

    With a primary key the first row of a key is stored and later ones are refused, as are keys the
    table already holds. Without one every row is stored. The stored rows are an aggregate that combines
    before the shuffle, so a key repeated many times costs no more than any other. The refused rows are
    found in bounded pieces: within a piece of a key all but the first row are repeats, and only the
    first rows of the pieces meet to see which of them was the very first.
    """
    columns = _columns(current, changes, [*_control(changes), *carry])
    told = [*columns, *carry]
    if not pk:
        return changes.select(*columns), _refused(changes.where(F.lit(False)), told)
    first = F.min_by(F.struct(*[F.col(c) for c in columns]), F.col("seq"))
    new = changes.groupBy(*pk).agg(first.alias("_row"))
    if current is not None:
        new = new.join(current.select(*pk), list(pk), "left_anti")
    inserted = new.select("_row.*")

    of_piece = Window.partitionBy(*pk, F.col("seq.partition"), F.floor(F.col("seq.offset") / piece)).orderBy("seq")
    # A flag and not a rank: a limit on the rank would go below the shuffle of one of the two, and they would no
    # longer share it.
    ranked = changes.withColumn("_head", F.lag("seq").over(of_piece).isNull())
    repeats = ranked.where(~F.col("_head"))
    heads = ranked.where("_head").withColumn(
        "_nth", F.row_number().over(Window.partitionBy(*pk).orderBy("seq"))
    )
    if current is None:
        late = heads.where(F.col("_nth") > 1)
    else:
        # A table holds each key once, so this join adds no rows.
        held = current.select(*pk, F.lit(True).alias("_known"))
        late = heads.join(held, list(pk), "left").where((F.col("_nth") > 1) | F.col("_known"))
    again = repeats.select(*told, "seq").unionByName(late.select(*told, "seq"))
    return inserted, _refused(again, told)


def mark_repeats(changes: DataFrame, pk: Sequence[str], held: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """Changes with `repeated`: whether a row's key came earlier, among the changes or the keys that are held.

    The same decisions as `apply_historic` makes, as a column, for callers that want stored and refused rows of one
    evaluation. Keys are ordered in bounded pieces; only the first rows of the pieces of a key meet.
    """
    of_piece = Window.partitionBy(*pk, F.col("seq.partition"), F.floor(F.col("seq.offset") / piece)).orderBy("seq")
    ranked = changes.withColumn("_head", F.lag("seq").over(of_piece).isNull())
    repeats = ranked.where(~F.col("_head")).withColumn("repeated", F.lit(True))
    heads = ranked.where("_head").withColumn("_nth", F.row_number().over(Window.partitionBy(*pk).orderBy("seq")))
    if held is None:
        late = heads.withColumn("repeated", F.col("_nth") > 1)
    else:
        known = held.select(*pk).distinct().withColumn("_known", F.lit(True))
        late = heads.join(known, list(pk), "left").withColumn("repeated", (F.col("_nth") > 1) | F.col("_known").isNotNull())
    columns = [*changes.columns, "repeated"]
    return repeats.select(*columns).unionByName(late.select(*columns))


def repeat_rejection() -> Column:
    """Why a repeated row is refused."""
    return F.struct(
        F.lit("historic").alias("stage"),
        F.lit("DUPLICATE_KEY").alias("code"),
        F.lit("ERROR: duplicate key value violates unique constraint").alias("error"),
    )


def _refused(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select(*columns, "seq", repeat_rejection().alias("reject"))


def apply_mutable(
    current: DataFrame | None, changes: DataFrame, pk: Sequence[str] = ("entityid", "timeinstant"), partial: bool = False
) -> DataFrame:
    """New state of a table where the last write of a key wins.

    With `partial`, a row only writes the columns it carries. One aggregate that combines before the
    shuffle; no sort by key and no window.
    """
    columns = _columns(current, changes, _control(changes))
    rows = _with_current(current, changes, columns)
    values = [c for c in columns if c not in pk]
    if not partial:
        latest = F.max_by(F.struct(*[F.col(c) for c in values]), F.col("seq"))
        return rows.groupBy(*pk).agg(latest.alias("_row")).select(*pk, "_row.*").select(*columns)
    picks = [_latest_present(c).alias(c) for c in values]
    return rows.groupBy(*pk).agg(*picks).select(*columns)


def _latest_present(column: str) -> Column:
    """Last value among the rows that carry the column; a carried NULL counts."""
    order = F.when(F.array_contains("present", column), F.col("seq"))
    return F.max_by(F.col(column), order)


def apply_lastdata_fast(
    current: DataFrame | None, changes: DataFrame, keys: Sequence[str] = ("entityid",), time: str = "timeinstant"
) -> DataFrame:
    """Newest row per key in one aggregate with map-side combine.

    Right when there are no deletes, no missing times and rows replace whole rows; `apply_lastdata`
    handles everything and gives the same result there.
    """
    columns = _columns(current, changes, _control(changes))
    rows = _with_current(current, changes, columns)
    seq = F.col("seq")
    earlier = F.struct(-seq["partition"], -seq["offset"], -seq["pos"])
    newest = F.max_by(F.struct(*[F.col(c) for c in columns]), F.struct(F.col(time), earlier))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select("_row.*")


def apply_lastdata(
    current: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str] = ("entityid",),
    time: str = "timeinstant",
    partial: bool = False,
    ties: str = "keep",
    piece: int = PIECE,
    with_high: bool = False,
) -> DataFrame:
    """New state of a newest-wins table: upserts accepted only when newer, deletes in arrival order.

    Per key, in `seq` order: a delete removes the row whatever its time, later rows may bring it back;
    a row is accepted when it has no time, when the key has no time yet, or when its time is above the
    greatest so far (`ties="replace"`: not below it). Accepted rows replace the whole row, or only the
    columns they carry with `partial`.

    The state alone does not say what the greatest time was. With `with_high` it has the control column `greatest_time_`, which
    this function reads from `current` and from folded rows among the changes: folds in any number of steps then give the
    rows of one.

    The fold runs in two bounded levels. The history of a key is cut into pieces of consecutive
    offsets, and each piece is folded by itself to one summary: whether it deletes, its greatest time,
    and for every column the last accepted value with a time and the last one without. That is enough,
    because times of accepted rows only grow: whatever came before, the last accepted value of a
    column is either that one or none. The summaries of a key, a row or less per piece, are then
    folded the same way. The first level shuffles rows once on (key, piece), so a key that owns a third
    of all rows is spread over as many tasks as it has pieces.
    """
    columns = _columns(current, changes, _control(changes))
    time = time if time in columns else None
    rows = _with_current(current, changes, columns).where(F.col("change") != "ignored")
    seq = F.col("seq")
    is_delete = F.col("change") == "delete"
    ts = F.col(time).cast("timestamp") if time else F.lit(None).cast("timestamp")
    rows = rows.withColumns(
        {
            "_piece": F.struct(
                seq["partition"].alias("partition"), F.floor(seq["offset"] / piece).cast("bigint").alias("range")
            ),
            "_delete": is_delete,
            "_ts": F.when(~is_delete, ts),
            "_mark": F.when(~is_delete, F.greatest(ts, F.col(HIGH))),
        }
    )

    # Level 1: fold each piece of a key.
    of_piece = Window.partitionBy(*keys, "_piece")
    before = of_piece.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    alive = rows.withColumn("_cut", F.max(F.when(F.col("_delete"), seq)).over(of_piece)).where(
        F.col("_cut").isNull() | (seq >= F.col("_cut"))
    )
    marked = alive.withColumn("_high", F.max("_mark").over(before))
    taken = ~F.col("_delete") & _newer(F.col("_ts"), F.col("_high"), ties)
    groups = _groups(columns, keys, partial)
    summaries = marked.groupBy(*keys, "_piece").agg(
        F.max("_delete").alias("_delete"),
        F.max(~F.col("_delete")).alias("_live"),
        F.max("_mark").alias("_high"),
        *[agg for group, value, has in groups for agg in _candidates(group, value, taken & has)],
    )

    # Level 2: fold the pieces of a key.
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    kept = summaries.withColumn("_cut", F.max(F.when(F.col("_delete"), F.col("_piece"))).over(of_key)).where(
        F.col("_cut").isNull() | (F.col("_piece") >= F.col("_cut"))
    )
    ranked = kept.withColumn("_before", F.max("_high").over(earlier))
    picks = [
        F.max_by(F.col(f"_pick_{group}.value"), F.col(f"_pick_{group}.seq")).alias(f"_value_{group}")
        for group, _, _ in groups
    ]
    chosen = ranked.select(
        *keys, "_live", "_high", *[_pick(group, ties).alias(f"_pick_{group}") for group, _, _ in groups]
    )
    state = chosen.groupBy(*keys).agg(F.max("_live").alias("_live"), F.max("_high").alias(HIGH), *picks).where("_live")
    control = [HIGH] if with_high else []
    if not partial:
        return state.select(*keys, HIGH, "_value_row.*").select(*columns, *control)
    values = [c for c in columns if c not in keys]
    return state.select(*keys, HIGH, *[F.col(f"_value_{c}").alias(c) for c in values]).select(*columns, *control)


def _newer(ts: Column, high: Column, ties: str) -> Column:
    if ties not in ("keep", "replace"):
        raise ValueError("ties must be 'keep' or 'replace'")
    above = ts > high if ties == "keep" else ts >= high
    return F.coalesce(above, F.lit(True))


def _groups(columns: Sequence[str], keys: Sequence[str], partial: bool) -> list[tuple[str, Column, Column]]:
    """(name, value, condition that a row carries it) of what is replaced together."""
    values = [c for c in columns if c not in keys]
    if not partial:
        return [("row", F.struct(*[F.col(c) for c in values]), F.lit(True))]
    return [(c, F.col(c), F.array_contains("present", c)) for c in values]


def _candidates(group: str, value: Column, taken: Column) -> list[Column]:
    """Aggregates of a piece: last accepted value with a time, and last accepted one without."""
    timed = F.struct(F.col("seq").alias("seq"), F.col("_ts").alias("ts"), value.alias("value"))
    order = F.col("seq")
    return [
        F.max_by(timed, F.when(taken & F.col("_ts").isNotNull(), order)).alias(f"_timed_{group}"),
        F.max_by(timed, F.when(taken & F.col("_ts").isNull(), order)).alias(f"_untimed_{group}"),
    ]


def _pick(group: str, ties: str) -> Column:
    """Last accepted value of a piece, knowing the greatest time before it."""
    timed, untimed = F.col(f"_timed_{group}"), F.col(f"_untimed_{group}")
    holds = timed.isNotNull() & _newer(timed["ts"], F.col("_before"), ties)
    later = untimed.isNull() | (timed["seq"] > untimed["seq"])
    return F.when(holds & later, timed).otherwise(untimed)

"""Range lookups by equality: boxes lie in few dyadic cells, points look their cells up.

Cell c of level n holds c * 4**n up to (c + 1) * 4**n - 1. A closed range of whole numbers has the level of
the smallest cells that are as long as it is, so it meets one or two cells; a point lies in exactly one
cell per level. "Point in range" is then an equality join on (level, cell) with the range itself as a
condition, and meets each matching pair exactly once. A key with thousands of overlapping ranges costs its
points one lookup per level in use and the candidates of a cell, not a scan of all its ranges.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import BROADCAST_BYTES, lookup_join, row_bytes

# Two bits a level: a cell is at most four times as long as its ranges.
SIZE_BITS = 2
STEP_BITS = 3
# Levels that 32-bit numbers and dates need.
LEVELS = 12
# How many levels beside the one with the most boxes are sent to the tasks.
FEW_LEVELS = 6
# (point column, lower bound, upper bound)
Range = tuple[str, str, str]
Levels = tuple[int, ...]


def _shifted(number: Column, level: Column) -> Column:
    return F.call_function("shiftright", number, level * STEP_BITS)


def _numbers(first: Column, end: Column) -> Column:
    """first, first + 1 and so on before end."""
    return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))


def cells(lo: Column, hi: Column) -> Column:
    """The closed range as a disjoint union of cells, here with steps of 8: array<struct<level, cell>>, at
    most 14 a level; empty for lo > hi and for nulls."""

    def at(n: Column) -> Column:
        # What lower levels have left over, in cells of this level: from first to before end; of it
        # the next level takes from up to before down.
        below = F.call_function("shiftleft", F.lit(1).cast("long"), n * STEP_BITS) - 1
        first, end = _shifted(lo + below, n), _shifted(hi + 1, n)
        step = 1 << STEP_BITS
        up = F.shiftright(first + (step - 1), STEP_BITS) * step
        down = F.shiftright(end, STEP_BITS) * step
        held = F.when(up < down, F.concat(_numbers(first, up), _numbers(down, end)))
        return F.transform(
            held.otherwise(_numbers(first, end)), lambda c: F.struct(n.alias("level"), c.alias("cell"))
        )

    levels = F.array(*[F.lit(n) for n in range(LEVELS)])
    cut = F.flatten(F.transform(levels, at))
    return F.when(lo <= hi, cut).otherwise(F.array().cast("array<struct<level:int,cell:bigint>>"))


def _whole(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.col(name).cast("long")
    raise TypeError(f"{name} is {kind.simpleString()}; cells need dates or 32-bit whole numbers")


def _cell(number: Column, level: Column) -> Column:
    return F.call_function("shiftright", number, level * SIZE_BITS)


def _levels(boxes: DataFrame, ranges: Sequence[Range]) -> dict[str, Column]:
    """__level0 and so on: for each range the level whose cells are as long as it is."""
    out = {}
    for i, (_, lo, hi) in enumerate(ranges):
        beyond = _whole(boxes, hi) - _whole(boxes, lo)
        # Half a number beside every power of two, so that rounding can't change the level.
        out[f"__level{i}"] = F.ceil(F.log2(beyond + F.lit(0.5)) / F.lit(SIZE_BITS)).cast("int")
    return out


def cut_boxes(
    boxes: DataFrame, ranges: Sequence[Range], instead: Mapping[Levels, Levels] | None = None
) -> DataFrame:
    """``boxes`` repeated for every cell that their ranges meet, at most two a range, with __level0,
    __cell0 and so on; without the boxes of empty or unknown ranges. ``instead`` has levels that longer
    cells take the place of."""
    known = reduce(lambda a, b: a & b, [F.col(lo) <= F.col(hi) for _, lo, hi in ranges])
    # Levels are columns of their own before they are used, so that they are worked out once.
    cut = boxes.filter(known).withColumns(_levels(boxes, ranges))
    names = [f"__level{i}" for i in range(len(ranges))]
    for old, new in (instead or {}).items():
        if old != new:
            raised = {name: F.when(_at(names, old), up).otherwise(F.col(name)) for name, up in zip(names, new, strict=True)}
            cut = cut.withColumns(raised)
    for i, (_, lo, hi) in enumerate(ranges):
        level = F.col(f"__level{i}")
        bounds = _cell(_whole(boxes, lo), level), _cell(_whole(boxes, hi), level)
        cut = cut.withColumn(f"__cell{i}", F.explode(F.sequence(*bounds)))
    return cut


def _levels_in_use(boxes: DataFrame, ranges: Sequence[Range]) -> dict[Levels, tuple[int, int]]:
    """For the levels of ``boxes``, which come to the driver, the rows of the cut and their payload."""
    own = _levels(boxes, ranges)
    known, cells = F.lit(True), F.lit(1).cast("long")
    for name, (_, lo, hi) in zip(own, ranges, strict=True):
        first, last = (_cell(_whole(boxes, x), F.col(name)) for x in (lo, hi))
        known, cells = known & (F.col(lo) <= F.col(hi)), cells * (last - first + 1)
    sized = boxes.filter(known).withColumns({**own, "__bytes": row_bytes(boxes) + 32 * len(ranges)})
    found = sized.withColumn("__rows", cells).groupBy(*own).agg(
        F.sum("__rows"), F.sum(F.col("__rows") * F.col("__bytes"))
    ).collect()
    return {tuple(r[:-2]): (r[-2], r[-1]) for r in found}


def _merged(in_use: Iterable[Levels]) -> dict[Levels, Levels]:
    """Levels to those that take their place: where a level one longer in one range stays in use anyway,
    boxes go there, so that points have fewer places to look. Its cells are four times as long."""
    instead: dict[Levels, Levels] = {}
    for levels in sorted(in_use, reverse=True):
        longer = [(*levels[:i], levels[i] + 1, *levels[i + 1:]) for i in reversed(range(len(levels)))]
        instead[levels] = next((up for up in longer if instead.get(up) == up), levels)
    return instead


def match_boxes(
    points: DataFrame, boxes: DataFrame, keys: Sequence[str], ranges: Sequence[Range], how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Points joined with the boxes of their keys that hold them; ``how`` is left or inner.

    Columns are those of ``points``, then those of ``boxes`` without its keys; a null key, place or bound
    matches nothing. Pairs are made by the last join, so what is shuffled grows with points and boxes,
    however many pairs there are. The cells' levels in use come to the driver.

    Points are shuffled once, to the cells of the level with the most boxes, if the boxes of all others,
    ``limit`` bytes at most, can be sent to the tasks. If not, a point goes to all levels at which it has
    a box, which distinct places find out once, and a point without any goes along as it is.
    """
    found = _levels_in_use(boxes, ranges)
    instead = _merged(found)
    in_use = sorted(set(instead.values()))
    rows = {used: sum(found[x][0] for x in found if instead[x] == used) for used in in_use}
    most = max(in_use, key=rows.get, default=None)
    rest = [used for used in in_use if used != most]
    size = sum(found[x][1] for x in found if instead[x] != most)
    cut = cut_boxes(boxes, ranges, instead)
    if most is not None and len(rest) <= FEW_LEVELS and size <= limit:
        return _match_at_one_level(points, boxes, cut, keys, ranges, how, most, rest)
    return _match_at_all_levels(points, boxes, cut, keys, ranges, how, in_use)


def _names(ranges: Sequence[Range]) -> tuple[list[str], list[str]]:
    return [f"__level{i}" for i in range(len(ranges))], [f"__cell{i}" for i in range(len(ranges))]


def _at(levels: Sequence[str], used: Levels) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name) == level for name, level in zip(levels, used, strict=True)])


def _within(ranges: Sequence[Range]) -> Column:
    inside = [F.col(place).between(F.col(lo), F.col(hi)) for place, lo, hi in ranges]
    return reduce(lambda a, b: a & b, inside)


def _cells_at(points: DataFrame, ranges: Sequence[Range], used: Levels) -> list[Column]:
    return [
        _cell(_whole(points, place), F.lit(level)).alias(f"__cell{i}")
        for i, ((place, _, _), level) in enumerate(zip(ranges, used, strict=True))
    ]


def _lookup(points: DataFrame, ranges: Sequence[Range], used: Levels) -> Column:
    levels = [F.lit(level).alias(f"__level{i}") for i, level in enumerate(used)]
    return F.struct(*levels, *_cells_at(points, ranges, used))


def _match_at_one_level(points, boxes, cut, keys, ranges, how, most, rest):
    """Points shuffled once: joined with the boxes of the level ``most`` by their cells there, with those of
    the levels ``rest`` in place. A row that found nothing at ``most`` is left out if one of ``rest`` is
    found for it; rows with a match have no cell to ask with, so the question costs them nothing."""
    levels, cell_names = _names(ranges)
    columns = [*points.columns, *[c for c in boxes.columns if c not in keys]]

    def equal(cells: Sequence[Column]) -> Column:
        # Cells of points are expressions of the condition, so that they are not shuffled as columns.
        return reduce(lambda a, b: a & b, [cell == F.col(c) for cell, c in zip(cells, cell_names, strict=True)])

    def of(used: Levels) -> DataFrame:
        return cut.filter(_at(levels, used)).drop(*levels)

    on = equal(_cells_at(points, ranges, most)) & _within(ranges)
    pairs = lookup_join(points, of(most), keys, how, on).select(*columns)
    if not rest:
        return pairs
    if how == "left":
        empty = F.col(ranges[0][1]).isNull()
        bounds = {name: f"__{name}" for _, lo, hi in ranges for name in (lo, hi)}
        held = _within([(place, bounds[lo], bounds[hi]) for place, lo, hi in ranges])
        for used in rest:
            other = of(used).select(*keys, *cell_names, *bounds).withColumnsRenamed(bounds)
            asking = equal([F.when(empty, cell) for cell in _cells_at(points, ranges, used)])
            pairs = lookup_join(pairs, other, keys, "left_anti", asking & held, small=True)
    lookups = F.array(*[_lookup(points, ranges, used) for used in rest])
    asked, others = points.select("*", F.inline(lookups)), cut.filter(~_at(levels, most))
    on = [*keys, *levels, *cell_names]
    if how == "inner":
        return pairs.unionByName(lookup_join(asked, others, on, how, _within(ranges), small=True).select(*columns))
    # As above no point is left out before the join: what makes the points is then shuffled only once.
    theirs = others.filter(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys]))
    theirs = F.broadcast(theirs.withColumnsRenamed({c: f"__right_{c}" for c in on}))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__right_{c}`")) for c in on]
    more = asked.join(theirs, [*same, F.coalesce(_within(ranges), F.lit(False))])
    return pairs.unionByName(more.select(*columns))


def _match_at_all_levels(points, boxes, cut, keys, ranges, how, in_use):
    """A point is shuffled to every level at which it has a box."""
    levels, cell_names = _names(ranges)
    signature, within = [*keys, *[place for place, _, _ in ranges]], _within(ranges)
    payload = [c for c in boxes.columns if c not in keys]

    def joined(asked: DataFrame) -> DataFrame:
        on = [*keys, *levels, *cell_names]
        return lookup_join(asked, cut, on, how, within).select(*points.columns, *payload)

    # A level that no box has: its number is the place itself, so that such points spread.
    nowhere = F.struct(
        *[F.lit(-1).alias(name) for name in levels],
        *[_whole(points, place).alias(c) for (place, _, _), c in zip(ranges, cell_names, strict=True)],
    )
    lookups = F.array(*[_lookup(points, ranges, used) for used in in_use]) if in_use else F.array(nowhere)
    if how == "inner" or not in_use:
        return joined(points.select("*", F.inline(lookups)))
    asked = points.select(*signature).distinct().select(*signature, F.posexplode(lookups).alias("__nth", "__at"))
    met = lookup_join(
        asked.select(*signature, "__nth", "__at.*"), cut, [*keys, *levels, *cell_names], "left_semi", within
    )
    hits = met.groupBy(*signature).agg(F.collect_set("__nth").alias("__hits"))
    # As many places as points are possible, so broadcasting is not considered.
    tagged = lookup_join(points, hits, signature, "left", small=False)
    chosen = F.when(F.col("__hits").isNull(), F.array(nowhere)).otherwise(
        F.transform("__hits", lambda n: F.get(lookups, n))
    )
    return joined(tagged.select(*points.columns, F.inline(chosen)))

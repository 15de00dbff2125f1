"""Per-key running windows that hold when one key owns a large share of the rows.

A rolling sum over ``(t - w, t]`` is written as a running sum: each row arrives once with ``+v``
at ``t`` and leaves once with ``-v`` at ``t + w``.  A running sum costs O(1) per row (a sliding range
frame recomputes its whole frame per row) and, being a prefix sum, can be cut anywhere.

There is one plan.  Rows are exchanged once, on (key, slice): the slice is the hour for keys with many rows and empty
for the others, so an ordinary key is one slice.  What the slices before an hour add up to, and the last rows before
it, come from two lean tables of one row per (heavy key, hour), joined on the exchange's own columns; without heavy
keys both are empty and their joins disappear at run time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.config import SETTINGS
from pricetide.functions.core import day_number, hour_number
from pricetide.session import cut_lineage

AT, KIND, SLICE = "_at", "_kind", "_slice"


def heavy_keys(df: DataFrame, key: str, rows: int = SETTINGS.heavy_rows) -> DataFrame:
    """All keys with at least ``rows`` rows, as a table that never visits the driver's code.

    The table's rows over ``rows`` bound their number, so the table may be broadcast: 20,000 keys from 10^11 rows.
    A missing key is none of them.
    """
    counts = df.groupBy(key).count()
    return counts.filter((F.col("count") >= rows) & F.col(key).isNotNull()).select(key)


def _known(df: DataFrame, key: str, heavy: DataFrame | None) -> DataFrame:
    return heavy_keys(df, key) if heavy is None else heavy.toDF(key)


def _sliced(df: DataFrame, key: str, at: Column, heavy: DataFrame) -> DataFrame:
    """Add the slice of each row: its hour if the key is heavy, else NULL."""
    marked = F.broadcast(heavy.withColumn("_heavy", F.lit(True)))
    return (df.join(marked, key, "left").withColumn(SLICE, F.when(F.col("_heavy"), hour_number(at)))
            .select(*df.columns, SLICE))


def _names(*columns: str) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _window(key: str, order: list[str], reverse: bool = False, rows: str = "") -> str:
    """A window over the slices of the key, in time order; SQL text, since one plan holds dozens of them."""
    direction = " desc" if reverse else ""
    # the internal time runs in the wanted direction already
    order = ", ".join(f"`{c}`" if c in (AT, KIND) else f"`{c}`{direction}" for c in order)
    return f"over (partition by {_names(key, SLICE)} order by {order}{rows})"


def rolling_sums(df: DataFrame, key: str, us: str, seq: list[str], measures: dict[str, Column],
                 spans: dict[str, int], *, reverse: bool = False, closed: bool = False,
                 heavy: DataFrame | None = None) -> DataFrame:
    """Add ``{measure}_{span}``: the sum over the span of time that ends at the row itself.

    ``us`` is the time in microseconds and ``seq`` breaks its ties: an earlier tie is inside the window,
    a later one is not.  The span is ``(t - w, t]``, with ``closed`` ``[t - w, t]``.  ``reverse`` looks
    forward in time from the row instead.  Measures must be whole numbers, so that leaving rows cancel
    exactly.  Span None (whole past) gives the running sum.  ``heavy`` names the keys to cut into hours (default:
    those that a count finds); the result does not depend on it.
    """
    heavy = _known(df, key, heavy)
    df = drop_internal(df)
    names = {m: f"_m_{m}" for m in measures}
    now = -F.col(us) if reverse else F.col(us)
    base = df.withColumns({**{names[m]: c.cast("long") for m, c in measures.items()}, AT: now})
    extra = 1 if closed else 0
    # kind -1 sorts before the arrivals of the same instant
    leaves = [f"struct(-1 as {KIND}, {AT} + {width + extra}L as {AT}, '{span}' as _span)"
              for span, width in spans.items() if width is not None]
    arrives = f"struct(0 as {KIND}, {AT} as {AT}, '' as _span)"
    event = [f"_e.{c} as {c}" for c in (KIND, AT, "_span")]
    weights = [f"`{n}`" for n in names.values()]

    def lean(steps: list[str]) -> DataFrame:
        """The given steps of rows of heavy keys, with nothing but what sums need."""
        part = base.join(F.broadcast(heavy), key, "left_semi").selectExpr(
            f"`{key}`", *weights, f"explode(array({', '.join(steps)})) as _e")
        return part.selectExpr(f"`{key}`", *weights, *event).withColumn(SLICE, hour_number(AT))

    rows = _sliced(base, key, F.col(AT), heavy).selectExpr("*", f"0 as {KIND}", "'' as _span")
    if leaves:
        # leaving rows of a heavy key belong to another slice and travel there; all others are made behind the exchange
        rows = rows.unionByName(lean(leaves), allowMissingColumns=True)
    rows = rows.repartition(key, SLICE)
    if leaves:
        itself = f"struct({KIND}, {AT}, _span)"
        steps = f"if({SLICE} is null and {KIND} = 0, array({', '.join([arrives, *leaves])}), array({itself}))"
        rows = rows.selectExpr("*", f"explode({steps}) as _e")
        payload = [f"`{c}`" if c in seq else f"if(_e.{KIND} = 0, `{c}`, null) as `{c}`" for c in df.columns if c != key]
        rows = rows.selectExpr(f"`{key}`", SLICE, *payload, *weights, *event)
    delta = {f"{m}_{span}": f"coalesce(case when {KIND} = 0 then `{names[m]}`"
                            + (f" when _span = '{span}' then -`{names[m]}`" if width is not None else "") + " end, 0)"
             for span, width in spans.items() for m in measures}
    to_here = _window(key, [AT, KIND, *seq], reverse, " rows between unbounded preceding and current row")
    rows = rows.selectExpr("*", *[f"sum({d}) {to_here} as `{c}`" for c, d in delta.items()]).filter(f"{KIND} = 0")

    before = f"over (partition by `{key}` order by {SLICE} rows between unbounded preceding and 1 preceding)"
    totals = lean([arrives, *leaves]).groupBy(key, SLICE).agg(*[F.expr(f"sum({d})").alias(c) for c, d in delta.items()])
    offsets = totals.selectExpr(f"`{key}`", SLICE, *[f"sum(`{c}`) {before} as `_o_{c}`" for c in delta])
    return rows.join(offsets, [key, SLICE], "left").selectExpr(
        *[f"`{c}`" for c in df.columns], *[f"`{c}` + coalesce(`_o_{c}`, 0) as `{c}`" for c in delta], AT, KIND, SLICE)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(AT, KIND, SLICE)


def shift_rows(df: DataFrame, key: str, us: str, seq: list[str], shifts: dict[str, tuple[str, int]], *,
               reverse: bool = False, heavy: DataFrame | None = None) -> DataFrame:
    """Add ``out: (column, n)``, the value ``n`` rows earlier (``reverse``: later) within the key.

    After ``rolling_sums`` in the same direction and with the same ``heavy`` the rows are already in this order, and
    neither an exchange nor a sort is added.  The first rows of a heavy key's hour take their values from the last
    rows before it, which are carried over as one short array per slice.
    """
    heavy = _known(df, key, heavy)
    if SLICE in df.columns:
        order, rows = [AT, KIND, *seq], df
    else:
        order, rows = [us, *seq], _sliced(df, key, -F.col(us) if reverse else F.col(us), heavy)
    reach = max(n for _, n in shifts.values())
    inside = _window(key, order, reverse)
    place = f"row_number() {inside} as _rn"

    # at most reach + 1 rows per slice: all that a look-back across slices can touch
    ends = (rows.join(F.broadcast(heavy), key, "left_semi").filter(f"{SLICE} is not null")
            .selectExpr("*", place, f"count(1) over (partition by {_names(key, SLICE)}) as _n")
            .filter(f"_rn = 1 or _n - _rn < {reach}"))
    values = f"struct({_names(*sorted({c for c, _ in shifts.values()}))})"
    # slices follow each other in the direction of time that the rows have within them
    back = f"over (partition by `{key}` order by {SLICE}, _rn rows between {reach} preceding and 1 preceding)"
    carried = ends.selectExpr(f"`{key}`", SLICE, "_rn", f"collect_list({values}) {back} as _carry").filter("_rn = 1")

    rows = rows.selectExpr("*", place, *[f"lag(`{c}`, {n}) {inside} as `{out}`" for out, (c, n) in shifts.items()])
    rows = rows.join(carried.drop("_rn"), [key, SLICE], "left")
    return rows.selectExpr(*[f"`{c}`" for c in df.columns], *[
        f"if({SLICE} is not null and _rn <= {n}, get(_carry, size(_carry) + _rn - {n + 1}).`{c}`, `{out}`) as `{out}`"
        for out, (c, n) in shifts.items()])


def numbered(df: DataFrame, order: list[str], out: str, purpose: str, within: str | None = None) -> DataFrame:
    """``df`` with the 0-based place of each row in ``order`` (within the groups of ``within``).

    Rows are cut into range slices and written once, so that a lost executor cannot move a row to another slice; slices
    are counted and numbered apart.  One row per slice is ordered in one task.
    """
    keys = [within] if within else []
    sliced = cut_lineage(df.repartitionByRange(*keys, *order).withColumn(SLICE, F.spark_partition_id()), purpose)
    below = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_size")).select(
        *keys, SLICE, F.coalesce(F.sum("_size").over(below), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*order)) - 1
    return sliced.withColumn("_i", place).join(starts, [*keys, SLICE]).select(
        *df.columns, (F.col("_i") + F.col("_start")).alias(out))


def position_cuts(df: DataFrame, us: str, seq: list[str], positions: Callable[[Column], list[Column]]) -> DataFrame:
    """One row ``cuts``: for each wanted 0-based position in time order, the order key found there.

    Counts per day locate the days of the positions and only rows of those days are numbered, in range slices, so
    nothing sorts the table.
    """
    keyed = df.select(day_number(us).alias("_day"), F.struct(us, *seq).alias("_row"))
    days = keyed.groupBy("_day").count()  # one row per calendar day
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_day", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
                       F.sum("count").over(Window.partitionBy()).alias("n"))
    wanted = days.select("*", F.explode(F.array(*[p.cast("long") for p in positions(F.col("n"))])).alias("_p"))
    wanted = wanted.filter((F.col("_p") >= F.col("_before")) & (F.col("_p") < F.col("_before") + F.col("count")))
    spots = wanted.select("_day", (F.col("_p") - F.col("_before")).alias("rank")).collect()  # one per position
    near = keyed.filter(F.col("_day").isin(sorted({s["_day"] for s in spots})))
    ranked = numbered(near, ["_row"], "_r", "cuts", "_day")
    hit = F.lit(False)
    for s in spots:
        hit = hit | ((F.col("_day") == s["_day"]) & (F.col("_r") == s["rank"]))
    return ranked.filter(hit).agg(F.array_sort(F.collect_list("_row")).alias("cuts"))


def cut_index(df: DataFrame, us: str, seq: list[str], positions, out: str, among: DataFrame | None = None) -> DataFrame:
    """Add how many of the wanted positions lie at or before each row; the table is not shuffled.

    The positions are looked for in ``among``, a stored table of the same rows (default: ``df``, which is then read
    three times).
    """
    cuts = position_cuts(df if among is None else among, us, seq, positions).scalar()
    # one comparison per position, which Spark compiles; a lambda over the array would be interpreted row by row
    passed = [F.coalesce((F.get("_cuts", F.lit(i)) <= F.struct(us, *seq)).cast("int"), F.lit(0))
              for i in range(len(positions(F.lit(0))))]
    return df.withColumn("_cuts", cuts).withColumn(out, sum(passed[1:], passed[0])).drop("_cuts")

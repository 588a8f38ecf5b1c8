"""Ordered scans over groups of any size: numbers, running sums, fills, ranks. One lazy plan, whatever the size.

A Spark window sends all rows of a group to one task. Here the rows are first cut into consecutive *pieces* of their whole order
(group, then order inside it), so a large group spans many pieces and a task gets pieces, not groups:

0. *Large groups.* The rows of each group are counted. Only a group with more rows than a shuffle partition holds on average is cut; there
   are fewer such groups than partitions. All other groups stay whole, as in a plain window, and need no bounds.
1. *Bounds.* Of the distinct keys of large groups, those whose hash falls on a stride are kept, about ``_SAMPLE`` per piece; the stride comes
   from a distinct count by sketch. The kept keys, sorted, are cut at equal distances. Bounds are a scalar sub-query and a pure function
   of the rows: recomputed tasks and pruned branches of a plan place every row alike. They only balance, they decide no result.
2. *Windows* run inside each piece and group.
3. *Carried state.* Totals are summed up per piece and group with partial sums on the map side. A group that spans pieces is the
   first or the last one of each of its pieces, so two rows per piece are left; a window over these gives what
   each piece takes over from earlier (or later) pieces. That table is broadcast; its size is bounded by the number of pieces.

No job starts while a plan is built. Row counts and bounds only decide where rows are put.

An order is a list of column names; a leading ``-`` means descending. Nulls sort last. Rows with equal keys stay in one piece; where
keys cover all columns, so that equal rows are copies, copies are counted first and written out in chunks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PIECE = "_piece"
#: The piece of rows whose group stays whole.
_WHOLE = -1
#: Pieces per shuffle partition, and sampled keys per piece.
_PIECES, _SAMPLE = 2, 50
#: Characters of a last text that a bound holds; texts that begin alike so far stay in one piece, where they are sorted in full.
_PREFIX = 256
#: 7-byte words by which descending texts are placed.
_TEXT_WORDS = 4
#: Copies of one row that a task writes out at once.
_CHUNK = 1_000_000


def sort_columns(order: list[str]) -> list[Column]:
    """Sort expressions for an order list, nulls last in both directions."""
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order
    ]


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on equally named columns in which null matches null, keeping one copy of the keys.

    The right keys get names of their own first, so a table may be joined with one made from it.
    """
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    match = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on))
    joined = left.join(renamed, match, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        joined = joined.withColumns({c: F.coalesce(c, f"_right_{c}") for c in on})
    return joined.drop(*[f"_right_{c}" for c in on])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _descending(c: str, kind: T.DataType) -> list[str]:
    """SQL of ascending values that fall as the column rises, or of coarser ones."""
    if isinstance(kind, T.StringType):
        words = [f"rpad(hex(substring(encode({c}, 'utf-8'), {1 + 7 * i}, 7)), 14, '0')" for i in range(_TEXT_WORDS)]
        return [f"~CAST(conv({w}, 16, 10) AS BIGINT)" for w in words]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return [f"NOT isnan({c})", f"-{c}"]
    if isinstance(kind, T.DateType):
        return [f"-unix_date({c})"]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [f"-unix_micros(CAST({c} AS TIMESTAMP))"]
    return [f"~{c}" if isinstance(kind, T.IntegralType) else f"-{c}" if isinstance(kind, T.DecimalType) else f"NOT {c}"]


def ordered_key(df: DataFrame, order: list[str], cut: bool = True) -> str:
    """SQL of a struct that sorts as the order does.

    A long text is cut where it is the last column, and a descending text ends the key, so that the key may tie where the order
    does not; it never contradicts the order.
    """
    parts = []
    for i, name in enumerate(order):
        column, kind = quoted(name.removeprefix("-")), df.schema[name.removeprefix("-")].dataType
        text = isinstance(kind, T.StringType)
        parts.append(f"{column} IS NULL")
        if name.startswith("-"):
            parts += _descending(column, kind)
            if text:
                break
        else:
            parts.append(f"left({column}, {_PREFIX})" if text and cut and i == len(order) - 1 else column)
    return "struct(" + ", ".join(f"{part} AS k{i}" for i, part in enumerate(parts)) + ")"


def piece_count(df: DataFrame) -> int:
    """Most pieces of a scan; bounds all that is broadcast."""
    return _PIECES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bounds(keys: DataFrame, order: list[str], counted: DataFrame | None = None) -> Column:
    """The keys at which pieces begin, as a scalar sub-query; ``keys`` is any frame with the order's keys, ``counted`` another for their number."""
    n = piece_count(keys)
    key = ordered_key(keys, order)
    hashed = keys.select(F.expr(f"{key} AS _key"), F.expr(f"xxhash64({key}) AS _hash"))
    distinct = (keys if counted is None else counted).select(F.expr(f"approx_count_distinct(xxhash64({key}))")).scalar()
    # Not a filter: it would be pushed below and work out the key's columns anew for every place it names them. Not an argument of the
    # aggregate: over CSV lines the sub-query holds their numbers, which counts as not deterministic.
    kept = F.when(F.col("_hash") % F.greatest(F.lit(1), F.floor(distinct / (n * _SAMPLE))) == 0, F.col("_key"))
    found = hashed.select(kept.alias("_kept")).agg(F.collect_set("_kept").alias("_s")).select(F.array_sort("_s").alias("_s"))
    cut = f"array_distinct(transform(sequence(1, {n - 1}), i -> _s[CAST(floor(i * size(_s) / {n}) AS INT)]))"
    return found.selectExpr(f"CASE WHEN size(_s) > 0 THEN {cut} END AS _b").scalar()


def with_pieces(
    df: DataFrame, order: list[str], keys: DataFrame | None = None, at: Column | None = None, where: str | None = None
) -> DataFrame:
    """The frame with ``_piece``: consecutive pieces of the order, numbered from 0; ``_WHOLE`` for rows on which ``where`` is not true."""
    at = bounds(df if keys is None else keys, order) if at is None else at
    # Count the bounds up to a row's key by halving; a place past the last bound is null, which is never before a row. The key is
    # bound by an array of one, so that it is made once per row.
    steps = ", ".join(str(2**i) for i in reversed(range(piece_count(df).bit_length())))
    before = f"aggregate(array({steps}), 0, (n, step) -> n + IF(get(_bounds, n + step - 1) <= k, step, 0))"
    placed = df.withColumn("_bounds", at)
    piece = f"transform(array({ordered_key(df, order)}), k -> {before})[0]"
    if where is not None:
        piece = f"CASE WHEN {quoted(where)} THEN {piece} ELSE {_WHOLE} END"
    return placed.select(*[quoted(c) for c in df.columns], F.expr(f"{piece} AS {_PIECE}"))


def row_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows of each group as ``_rows``, for the ``counts`` of several scans: their groups are made of these, so the rows are counted once."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))


def large_groups(keys: DataFrame, by: list[str], least: int = 1, counts: DataFrame | None = None) -> DataFrame:
    """The groups with more rows than a shuffle partition holds on average, ``least`` at least; fewer than there are partitions.

    ``counts`` are the ``row_counts`` of the same rows by ``by`` and other columns, if there are any.
    """
    n = row_counts(keys, *by) if counts is None else counts.groupBy(*by).agg(F.sum("_rows").alias("_rows"))
    more = F.col("_rows") * (piece_count(keys) // _PIECES) > n.agg(F.sum("_rows")).scalar()
    return n.where(more & (F.col("_rows") >= least)).select(*by)


def _cut(
    df: DataFrame, by: list[str], order: list[str], source: DataFrame | None = None, counts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The frame with ``_piece``, and the rows of its large groups, or of those of ``source``, with it.

    The rows of other groups have the piece ``_WHOLE``, and take over nothing.
    """
    keys = [*by, *order]
    source = df if source is None else source
    if not by:
        at = bounds(source, keys)
        return with_pieces(df, keys, at=at), with_pieces(source, keys, at=at)
    # Where no group is large, adaptive execution spares the scans for bounds and totals, but not if they share a broadcast that is
    # there already. Least sizes tell their broadcasts apart; bounds may leave out small groups, as they only balance.
    cut, sampled, counted = (null_safe_join(source, F.broadcast(large_groups(source, by, k, counts)), by, "left_semi") for k in (1, 2, 3))
    at = bounds(sampled, keys, counted)
    marked = null_safe_join(df, F.broadcast(large_groups(source, by, counts=counts).withColumn("_cut", F.lit(True))), by, "left")
    return with_pieces(marked, keys, at=at, where="_cut").drop("_cut"), with_pieces(cut, keys, at=at)


def _taken_over(pieces: DataFrame, by: list[str], totals: list[Column], over: Callable) -> DataFrame:
    """(``_piece``, by, carried columns): what the rows of a group in a piece take over from its other pieces."""
    table = pieces.groupBy(_PIECE, *by).agg(*totals)
    if by:
        group = ordered_key(table, by, cut=False)
        row = "struct(" + ", ".join(quoted(c) for c in table.columns) + ")"
        ends = table.groupBy(_PIECE).agg(
            F.expr(f"min_by({row}, {group}) AS _first"), F.expr(f"max_by({row}, {group}) AS _last"), F.expr("count(1) > 1 AS _several")
        )
        table = ends.select(F.expr("inline(IF(_several, array(_first, _last), array(_first)))"))
    before = Window.partitionBy(*by).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(_PIECE).rowsBetween(1, Window.unboundedFollowing)
    return table.select(_PIECE, *by, *over(before, after))


def _with_state(pieces: DataFrame, by: list[str], totals: list[Column], over: Callable, source: DataFrame) -> DataFrame:
    """Rows with the state that their piece takes over, from the pieces of ``source``; at most two rows per piece are broadcast."""
    table = _taken_over(source, by, totals, over)
    return null_safe_join(pieces, F.broadcast(table), [_PIECE, *by], "left")


def _window(by: list[str], order: list[str]):
    return Window.partitionBy(_PIECE, *by).orderBy(*sort_columns(order))


def numbered(
    df: DataFrame, by: list[str], order: list[str], into: str, source: DataFrame | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Number rows 1..n inside each group (all rows if ``by`` is empty) in the given order.

    Bounds and totals read the frame again. Where it is costly, ``source`` names a cheaper one whose rows have the same keys.
    ``counts`` are the ``row_counts`` of its rows by ``by`` and other columns, if several scans share them.
    """
    by = list(by)
    if source is None and {*by, *(c.lstrip("-") for c in order)} == set(df.columns):
        return _numbered_copies(df, by, order, into)
    pieces, totals = _cut(df, by, order, source, counts)
    full = _with_state(
        pieces.withColumn(into, F.row_number().over(_window(by, order)).cast("long")), by, [F.count(F.lit(1)).alias("_n")],
        lambda before, after: [F.sum("_n").over(before).alias("_offset")], source=totals,
    )
    return full.withColumn(into, F.col(into) + F.coalesce("_offset", F.lit(0))).drop(_PIECE, "_offset")


def _numbered_copies(df: DataFrame, by: list[str], order: list[str], into: str) -> DataFrame:
    """Numbering when the keys tell all of a row: count copies, sum the counts up, write the numbers out in chunks."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    last = running_sum(copies, by, order, "_n", "_upto", source=df, count=True)
    begin = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_CHUNK).cast("long"))
    chunks = last.withColumn("_from", F.explode(begin))
    first = F.col("_upto") - F.col("_n") + 1 + F.col("_from")
    final = F.least(first + (_CHUNK - 1), F.col("_upto"))
    return chunks.select(*df.columns, F.explode(F.sequence(first, final)).alias(into))


def running_sum(
    df: DataFrame, by: list[str], order: list[str], value: str, into: str, source: DataFrame | None = None, count: bool = False
) -> DataFrame:
    """Sum of ``value`` over this and all earlier rows of the group; the order must be unique.

    Where ``df`` holds counts of the rows of ``source``, keys and totals can be taken from those rows (``count``), which
    need no shuffle for it.
    """
    by = list(by)
    pieces, rows = _cut(df, by, order, source)
    total = F.sum(value).over(_window(by, order).rowsBetween(Window.unboundedPreceding, 0))
    full = _with_state(
        pieces.withColumn(into, total), by, [(F.count(F.lit(1)) if count else F.sum(value)).alias("_n")],
        lambda before, after: [F.sum("_n").over(before).alias("_offset")], source=rows,
    )
    return full.withColumn(into, F.col(into) + F.coalesce("_offset", F.lit(0))).drop(_PIECE, "_offset")


#: How a running value goes on from what its piece takes over.
_JOINED = {"sum": "{0} + coalesce({1}, 0)", "bit_xor": "{0} ^ coalesce({1}, 0)", "max": "greatest({0}, {1})", "min": "least({0}, {1})"}


def running(df: DataFrame, by: list[str], order: list[str], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Running aggregates over this and all earlier rows of the group: new name -> (``sum``, ``max``, ``min`` or ``bit_xor``, column).

    The order must be unique. All columns share one scan.
    """
    by = list(by)
    pieces, cut = _cut(df, by, order)
    rows = _window(by, order).rowsBetween(Window.unboundedPreceding, 0)
    local = {into: F.expr(f"{kind}({quoted(value)})").over(rows) for into, (kind, value) in columns.items()}
    totals = [F.expr(f"{kind}({quoted(value)}) AS {quoted('_of_' + into)}") for into, (kind, value) in columns.items()]
    full = _with_state(
        pieces.withColumns(local), by, totals,
        lambda before, after: [F.expr(f"{kind}({quoted('_of_' + into)})").over(before).alias(f"_far_{into}") for into, (kind, _) in columns.items()],
        source=cut,
    )
    ends = {into: F.expr(_JOINED[kind].format(quoted(into), quoted(f"_far_{into}"))) for into, (kind, _) in columns.items()}
    return full.withColumns(ends).drop(_PIECE, *[f"_far_{into}" for into in columns])


def carried(
    df: DataFrame, by: list[str], order: list[str], columns: list[str], directions: tuple[str, ...] = ("down",)
) -> DataFrame:
    """Fill nulls from the nearest known row of the group, trying the directions in turn.

    ``down`` looks at earlier rows, ``up`` at later ones. All directions share one shuffle.
    """
    by = list(by)
    pieces, cut = _cut(df, by, order)
    window = _window(by, order)
    earlier = window.rowsBetween(Window.unboundedPreceding, 0)
    later = window.rowsBetween(0, Window.unboundedFollowing)
    near = {
        "down": lambda c: F.last(c, ignorenulls=True).over(earlier),
        "up": lambda c: F.first(c, ignorenulls=True).over(later),
    }
    place = F.expr(ordered_key(df, order))
    pick = {"down": F.max_by, "up": F.min_by}
    edges = [
        pick[d](c, F.when(F.col(c).isNotNull(), place)).alias(f"_{d}_{c}") for d in directions for c in columns
    ]

    def over_pieces(before, after):
        far = {
            "down": lambda x: F.last(x, ignorenulls=True).over(before),
            "up": lambda x: F.first(x, ignorenulls=True).over(after),
        }
        return [far[d](f"_{d}_{c}").alias(f"_far_{d}_{c}") for d in directions for c in columns]

    local = {f"_near_{d}_{c}": near[d](c) for d in directions for c in columns}
    full = _with_state(pieces.withColumns(local), by, edges, over_pieces, source=cut)
    sources = lambda c: [f"_{w}_{d}_{c}" for d in directions for w in ("near", "far")]
    return full.withColumns({c: F.coalesce(*sources(c)) for c in columns}).select(df.columns)


def ranked(df: DataFrame, by: list[str], order: str, into: str) -> DataFrame:
    """SQL ``RANK()`` by one column. Ties share a rank; the next rank skips.

    Equal values are counted, the counts are summed up, and the rank goes back to the rows by a join on the value, whose hot
    values adaptive execution splits.
    """
    column = order.lstrip("-")
    keys = [*by, column]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sums = running_sum(counts, by, [order], "_n", "_upto", source=df.select(*keys), count=True)
    ranks = sums.select(*keys, (F.col("_upto") - F.col("_n") + 1).cast("long").alias(into))
    return null_safe_join(df, ranks, keys, "left")

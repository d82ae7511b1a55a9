"""Best-fit packing by minimum bin slack.

Each bin takes the longest piece left and fills the rest of it with the combination of available lengths that comes
closest to full, found by subset sums over a bitset (bit ``s`` is set when lengths adding up to ``s`` exist). Which
pieces have those lengths does not matter, so bins are planned on the counts of lengths alone: at most ``capacity``
numbers however many pieces there are. As long as the counts allow, the next bin would be filled alike, so a
combination is taken as often as it can be at once; the plan is the one that bin after bin would give.

The pieces of one length are then numbered and dealt to the places that the plan has for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelark.session import staged

#: Pieces of one length that are numbered in one task.
RUN_ROWS = 4096


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The lengths, each at most as often as it is there, whose sum comes closest to ``room`` from below."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        most = min(counts[length], room // length)
        before, left, step = reach, most, 1
        while left:
            step = min(step, left)
            reach |= (reach << (length * step)) & mask
            left -= step
            step *= 2
        if reach != before:
            steps.append((length, most, before))
        if reach >> room & 1:
            break
    target, found = reach.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        times = next(k for k in range(most + 1) if target >= k * length and before >> (target - k * length) & 1)
        if times:
            found[length] = times
            target -= times * length
    return found


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(how often each length is in the bin, number of such bins), for all pieces."""
    left = {n: c for n, c in counts.items() if c > 0}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = []
    while left:
        longest = max(left)
        rest = {n: c - (n == longest) for n, c in left.items()}
        inside = fullest(rest, capacity - longest)
        inside[longest] = inside.get(longest, 0) + 1
        bins = min(left[n] // k for n, k in inside.items())
        plan.append((inside, bins))
        for n, k in inside.items():
            left[n] -= k * bins
            if not left[n]:
                del left[n]
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first piece number, last + 1, pieces of it in a bin, first bin, offset in the bin)."""
    rows, used, first_bin = [], {}, 0
    for inside, bins in plan:
        offset = 0
        for length, k in sorted(inside.items(), reverse=True):
            start = used.get(length, 0)
            rows.append((length, start, start + k * bins, k, first_bin, offset))
            used[length] = start + k * bins
            offset += k * length
        first_bin += bins
    return rows


def pack(pieces: DataFrame, order_by: list[str], capacity: int = 1024, length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (both long) to pieces of 1 to ``capacity``.

    ``order_by`` names columns that tell pieces of one length apart; rows equal in them are interchangeable. Columns
    named ``_*`` are not allowed in ``pieces``. The pieces are written to the shared folder once. What reaches the
    driver is one count per length; what is broadcast is the plan, which is bounded by ``capacity`` as well. A length
    that a third of all pieces have is numbered in runs of about ``RUN_ROWS``. No pieces give no rows; a length of
    null or out of range is an error.
    """
    spark = pieces.sparkSession
    pieces = staged(pieces, "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    if None in counts:
        raise ValueError("a piece has no length")
    plan = places(plan_bins(counts, capacity))
    runs = spark.createDataFrame(
        [(n, max(1, -(-c // RUN_ROWS))) for n, c in counts.items()], "_length long, _runs long"
    )
    slots = spark.createDataFrame(plan, "_of long, _from long, _to long, _k long, _first long, _offset long")

    dealt = pieces.join(F.broadcast(runs), F.col(length) == F.col("_length"))
    dealt = dealt.withColumn("_run", F.pmod(F.xxhash64(*order_by), F.col("_runs"))).drop("_runs")
    earlier = Window.partitionBy("_length").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_length", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        F.col("_length").alias("_l"), F.col("_run").alias("_r"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_b")
    )
    inside = Window.partitionBy("_length", "_run").orderBy(*order_by)
    ranked = dealt.withColumn("_row", F.row_number().over(inside) - 1).join(
        before, (F.col("_length") == F.col("_l")) & (F.col("_run") == F.col("_r"))
    )
    ranked = ranked.withColumn("_rank", F.col("_row") + F.col("_b"))
    put = ranked.join(
        F.broadcast(slots),
        (F.col("_length") == F.col("_of")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    nth = F.col("_rank") - F.col("_from")
    return put.select(
        *pieces.columns,
        (F.col("_first") + F.call_function("div", nth, F.col("_k"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (nth % F.col("_k")) * F.col("_length")).cast("long").alias("offset"),
    )

"""Monthly recurring revenue: one row per subscription and active month, with its movement.

Each subscription is turned into its months by ``sequence`` and ``explode``; no
join with a calendar. Its churn month, if it has one, comes out of the same
explode, so the subscriptions are read once. The months of one user are then
compared in order (month, start date, subscription id).

The shuffle by user happens *before* the months are exploded, so it carries one
row per subscription, not one per month, and its partitioning also serves a
later count of distinct users. A user who owns so many rows that one task could
not hold them (a reseller, a catch-all account) is found by a map-side combined
count and takes a second lane, where the ordered rows are cut into blocks
(month, start date, id prefix) and only the last row of each block travels to
the next one. Both lanes give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.context import RunContext
from ledgerlight.functions.dates import each_month, month_from_text, month_number, month_start, yyyymm
from ledgerlight.functions.keys import surrogate_key

# A user takes the split lane above this many month rows, whatever the size of the data: what one task
# may have to hold stays the same.
HOT_USER_ROWS = 2_000_000
# So many hot users may be broadcast; more are joined by their key.
BROADCAST_USERS = 100_000


# Month rows that a write of the whole fact shuffles at once; beyond so many parts, a part holds more.
PART_ROWS = 8_000_000
MOST_PARTS = 32


MRR_COLUMNS = [
    "sk_mrr_id",
    "subscription_id",
    "sk_subscription_id",
    "user_id",
    "sk_user_id",
    "plan_id",
    "sk_plan_id",
    "mrr_month",
    "cohort_month",
    "billing_cycle",
    "mrr_movement_type",
    "is_spike_churn",
    "mrr",
    "prev_mrr",
    "mrr_delta",
]
_PREVIOUS = ["prev_mrr", "prev_subscription_id", "prev_month_start"]


def counted_subscriptions(subscriptions: DataFrame, ctx: RunContext) -> DataFrame:
    """Paid subscriptions with the first and last month they count in, and their churn month.

    An open subscription runs to ``as_of``; months outside the reporting window
    are cut off, which may leave the last month before the first. The churn month
    follows the end of a cancelled subscription and is not cut. A subscription
    with neither drops out.
    """
    start = month_start(F.col("subscription_start_date"))
    end = month_start(F.coalesce(F.col("subscription_end_date"), ctx.today()))
    ended = F.coalesce("subscription_end_date", "cancelled_date")
    return (
        subscriptions.where(F.col("subscription_start_date").isNotNull())
        .withColumns({
            "first_month": F.greatest(start, ctx.first_month()),
            "last_month": F.least(end, ctx.current_month()),
            "churn_month": F.when(F.col("is_churned"), month_start(F.add_months(ended, 1))),
        })
        .where((F.col("first_month") <= F.col("last_month")) | F.col("churn_month").isNotNull())
    )


def paid_spans(subscriptions: DataFrame, ctx: RunContext) -> DataFrame:
    """The subscriptions that count in at least one month."""
    counted = counted_subscriptions(subscriptions, ctx).drop("churn_month")
    return counted.where(F.col("first_month") <= F.col("last_month"))


def by_user(subscriptions: DataFrame) -> DataFrame:
    """Rows partitioned by user before an explode.

    The partition count is pinned to the session's: left open, it would be
    lowered to suit the small rows that are shuffled, not the many that follow.
    """
    partitions = int(subscriptions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return subscriptions.repartition(partitions, "user_id")


def active_months(spans: DataFrame) -> DataFrame:
    """One row per span and month: adds ``month_start`` and ``mrr_month``.

    Works on any rows that carry ``first_month`` and ``last_month``, so totals
    can be summed per (first, last) pair before they are spread over the months.
    """
    return (
        spans.withColumn("month_start", F.explode(each_month(F.col("first_month"), F.col("last_month"))))
        .withColumn("mrr_month", yyyymm(F.col("month_start")))
        .drop("first_month", "last_month")
    )


def active_in_month(spans: DataFrame, yyyymm_text: Column) -> DataFrame:
    """The month rows of one month only: a filter on the span, no explode."""
    month = month_from_text(yyyymm_text)
    covered = spans.where((F.col("first_month") <= month) & (F.col("last_month") >= month))
    return covered.withColumn("mrr_month", yyyymm_text).drop("first_month", "last_month")


def active_mrr_by_month(subscriptions: DataFrame, ctx: RunContext) -> DataFrame:
    """Live MRR per month from sums per (first, last) month pair.

    Same totals as summing the month rows without churn, but at most
    months x months rows are ever exploded or shuffled.
    """
    per_span = paid_spans(subscriptions, ctx).groupBy("first_month", "last_month").agg(F.sum("mrr").alias("mrr"))
    return active_months(per_span).select("mrr_month", "mrr")


def _month_rows() -> Column:
    """How many rows of the fact a counted subscription makes."""
    live = F.greatest(month_number(F.col("last_month")) - month_number(F.col("first_month")) + 1, F.lit(0))
    return live + F.col("churn_month").isNotNull().cast("int")


def write_parts(subscriptions: DataFrame, ctx: RunContext) -> int:
    """In how many parts the whole fact should be written (``MonthTable.replace``, cut by user); counts its rows without making them."""
    rows = counted_subscriptions(subscriptions, ctx).agg(F.sum(_month_rows())).first()[0] or 0
    return max(1, min(MOST_PARTS, -(-rows // PART_ROWS)))


def find_hot_users(
    subscriptions: DataFrame, ctx: RunContext, *, min_rows: int = HOT_USER_ROWS
) -> DataFrame | None:
    """Users whose month rows need the split lane, or None if there are none.

    Counts the rows per user, combined map-side; the ids are looked at for hot
    users only. Only the number of hot users comes to the driver.
    """
    counted = counted_subscriptions(subscriptions, ctx)
    loads = counted.groupBy("user_id").agg(F.sum(_month_rows()).alias("month_rows"))
    heavy = loads.where(F.col("month_rows") > min_rows).select(F.col("user_id").alias("hot_user_id"))
    number = heavy.count()
    if not number:
        return None
    few = F.broadcast(heavy) if number <= BROADCAST_USERS else heavy
    ids = counted.join(few, F.col("user_id").eqNullSafe(F.col("hot_user_id"))).groupBy("hot_user_id").agg(
        F.min("subscription_id").alias("low_id"), F.max("subscription_id").alias("high_id")
    )
    # All ids of a user lie between the lowest and the highest, so they share the prefix of those two.
    shared = F.expr("size(filter(sequence(1, greatest(length(low_id), 1)), i -> left(low_id, i) = left(high_id, i)))")
    hot = ids.select("hot_user_id", shared.alias("shared_chars"))
    chars = _block_chars(with_hot_users(counted, hot), min_rows)
    return (F.broadcast(hot) if number <= BROADCAST_USERS else hot).withColumn("block_chars", F.lit(chars))


def with_hot_users(rows: DataFrame, hot: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of hot users with their block columns, or (``left_anti``) the rows of all others.

    ``find_hot_users`` has counted them: a list that is short enough is broadcast.
    """
    joined = rows.join(hot, F.col("user_id").eqNullSafe(F.col("hot_user_id")), how)
    return joined if how == "left_anti" else joined.drop("hot_user_id")


def _id_block(chars: Column) -> Column:
    return F.substring(F.col("subscription_id"), F.col("shared_chars") + 1, chars)


def _block_chars(hot_rows: DataFrame, limit: float) -> int:
    """How many characters after the common prefix cut one start date into blocks below the limit.

    A block of one month holds at most the subscriptions of its start date and
    prefix. One character more divides the blocks finely enough not to make too
    many of them; the full id is the end, where every block is one subscription.
    """
    longest = hot_rows.agg(F.max(F.length("subscription_id") - F.col("shared_chars"))).first()[0]
    for chars in range(longest):
        blocks = hot_rows.groupBy("user_id", "subscription_start_date", _id_block(F.lit(chars))).count()
        if blocks.agg(F.max("count")).first()[0] <= limit:
            return chars
    return longest


def _previous_in_order(months: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(*order)
    return months.withColumns({
        "prev_mrr": F.lag("mrr").over(ordered),
        "prev_subscription_id": F.lag("subscription_id").over(ordered),
        "prev_month_start": F.lag("month_start").over(ordered),
    })


def months_by_user(counted: DataFrame) -> DataFrame:
    """Live and churn months with the user's previous live month; one shuffle, one scan."""
    live_months = F.when(
        F.col("first_month") <= F.col("last_month"), each_month(F.col("first_month"), F.col("last_month"))
    ).otherwise(F.array().cast("array<date>"))
    rows = by_user(counted).withColumn("live_months", live_months).select(
        "*",
        F.posexplode(F.concat("live_months", F.array_compact(F.array("churn_month")))).alias("position", "month_start"),
    )
    rows = rows.withColumn("is_churn_month", F.col("position") >= F.size("live_months"))
    # The live months of a user are a group of their own, so no row is compared with a churn month.
    rows = _previous_in_order(
        rows.drop("live_months", "position"),
        ["user_id", "is_churn_month"],
        ["month_start", "subscription_start_date", "subscription_id"],
    )
    return rows.withColumn("mrr_month", yyyymm(F.col("month_start")))


def months_by_block(counted: DataFrame) -> DataFrame:
    """The same for users too large for one task.

    Within a block the previous row comes from a window. The first row of a
    block takes the last row of the block before it, out of a table that holds
    one row per block (and per month, to step over the month edge).
    """
    block_keys = ["user_id", "month_start", "subscription_start_date", "id_block"]
    spans = counted.where(F.col("first_month") <= F.col("last_month"))
    months = active_months(spans).withColumn("id_block", _id_block(F.col("block_chars")))
    inside = _previous_in_order(months, block_keys, ["subscription_id"])

    last_row = F.max(F.struct("subscription_start_date", "subscription_id", "mrr", "month_start"))
    blocks = months.groupBy(*block_keys).agg(last_row.alias("last_row"))
    month_ends = blocks.groupBy("user_id", "month_start").agg(F.max("last_row").alias("month_end"))
    month_ends = month_ends.withColumn(
        "before_month", F.lag("month_end").over(Window.partitionBy("user_id").orderBy("month_start"))
    ).drop("month_end")
    in_month = Window.partitionBy("user_id", "month_start").orderBy("subscription_start_date", "id_block")
    blocks = blocks.withColumn("before_block", F.lag("last_row").over(in_month)).drop("last_row")

    b, m = blocks.alias("b"), month_ends.alias("m")
    edges = b.join(
        m, F.col("b.user_id").eqNullSafe(F.col("m.user_id")) & (F.col("b.month_start") == F.col("m.month_start"))
    ).select("b.*", F.coalesce("b.before_block", "m.before_month").alias("edge"))

    r, e = inside.alias("r"), edges.alias("e")
    same_block = F.col("r.user_id").eqNullSafe(F.col("e.user_id"))
    for key in block_keys[1:]:
        same_block = same_block & (F.col(f"r.{key}") == F.col(f"e.{key}"))
    own = [c for c in inside.columns if c not in _PREVIOUS]
    live = r.join(e, same_block).select(
        *[F.col(f"r.{c}") for c in own],
        F.coalesce("r.prev_mrr", "e.edge.mrr").alias("prev_mrr"),
        F.coalesce("r.prev_subscription_id", "e.edge.subscription_id").alias("prev_subscription_id"),
        F.coalesce("r.prev_month_start", "e.edge.month_start").alias("prev_month_start"),
        F.lit(False).alias("is_churn_month"),
    )
    churned = counted.where(F.col("churn_month").isNotNull()).withColumns({
        "month_start": F.col("churn_month"),
        "mrr_month": yyyymm(F.col("churn_month")),
        "is_churn_month": F.lit(True),
    })
    return live.unionByName(churned, allowMissingColumns=True).drop("id_block", "shared_chars", "block_chars")


def months_with_previous(counted: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Live and churn months with the user's previous live month.

    ``hot`` users (``find_hot_users``) take the split lane.
    """
    if hot is None:
        return months_by_user(counted)
    regular = months_by_user(with_hot_users(counted, hot, "left_anti"))
    return regular.unionByName(months_by_block(with_hot_users(counted, hot)))


def movement_type() -> Column:
    """The class of a month row against the user's previous row; first match wins."""
    return (
        F.when(F.col("is_churn_month"), "churned")
        .when(F.col("prev_month_start").isNull(), "new")
        .when(F.col("month_start") > F.add_months("prev_month_start", 1), "reactivation")
        .when(F.col("mrr") > F.col("prev_mrr"), "expansion")
        .when(F.col("mrr") < F.col("prev_mrr"), "contraction")
        .otherwise("retained")
    )


def movements(months: DataFrame, *, reactivation_delta: str = "change") -> DataFrame:
    """Movement, previous MRR and delta per month row; a churn month loses the whole MRR.

    ``reactivation_delta``: ``change`` books the difference to the last known
    MRR, ``full`` books the whole MRR of a returning user.
    """
    if reactivation_delta not in ("change", "full"):
        raise ValueError("reactivation_delta must be 'change' or 'full'")
    movement, mrr = movement_type(), F.col("mrr")
    change = mrr - F.coalesce("prev_mrr", F.lit(0))
    if reactivation_delta == "full":
        change = F.when(movement == "reactivation", mrr).otherwise(change)
    churn = F.col("is_churn_month")
    return months.withColumns({
        "mrr_movement_type": movement,
        "prev_mrr": F.when(churn, mrr).otherwise(F.col("prev_mrr")),
        "mrr_delta": F.when(churn, -mrr).otherwise(change).cast("decimal(10,2)"),
    })


def fct_mrr(
    subscriptions: DataFrame,
    ctx: RunContext,
    *,
    incremental: bool = False,
    reactivation_delta: str = "change",
    hot: DataFrame | None = None,
) -> DataFrame:
    """The MRR fact over ``fct_subscriptions`` rows.

    ``hot`` are the users that no single task could hold, as ``find_hot_users``
    gives them. ``incremental=True`` returns the rows of the lookback months only.
    The comparison still runs over the full history, because a cut before it
    would turn every first row of the window into ``new``.
    """
    columns = [c for c in MRR_COLUMNS if c != "sk_user_id" or "sk_user_id" in subscriptions.columns]
    months = months_with_previous(counted_subscriptions(subscriptions, ctx), hot)
    rows = movements(months, reactivation_delta=reactivation_delta)
    if incremental:
        rows = rows.where(F.col("mrr_month") >= ctx.oldest_reloaded_month())
    return rows.withColumn("sk_mrr_id", surrogate_key("subscription_id", "mrr_month")).select(columns)


def live_rows(mrr: DataFrame) -> DataFrame:
    """The MRR fact without its synthetic churn rows."""
    return mrr.where(F.col("mrr_movement_type") != "churned")


def latest_month(subscriptions: DataFrame, ctx: RunContext) -> DataFrame:
    """The latest ``mrr_month`` of the fact, read off the subscriptions in one aggregate.

    Churn months count too, and may lie after ``as_of``.
    """
    live = F.when(F.col("first_month") <= F.col("last_month"), F.col("last_month"))
    latest = F.max(F.greatest(live, F.col("churn_month")))
    return counted_subscriptions(subscriptions, ctx).agg(yyyymm(latest).alias("mrr_month"))

"""The five risk detectors.

``large_amount``, ``failed_surge`` and ``ip_sharing`` take batch and streaming events alike. The two that
follow one user through time, ``high_frequency`` and ``continuous_increase``, are batch; their streaming
forms in ``tidewatch.streaming.stateful`` share the alert projections below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions import plain_number, tumbling
from tidewatch.operators.alerts import as_alerts
from tidewatch.settings import DEFAULTS, RiskSettings

# Milliseconds of a slice of a user's time line in which bursts are counted, whatever the burst window.
_BURST_SLICE_MS = 600_000
# Alerts of one user within one millisecond are produced in blocks of this size.
_TIE_BLOCK = 100_000


# --- single events -----------------------------------------------------------------------------------


def large_amount(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """One alert per event above the threshold."""
    limit = settings.large_amount
    return as_alerts(
        events.where(F.col("amount") > F.lit(limit)),
        S.LARGE_AMOUNT,
        user_id=F.col("user_id"),
        transaction_id=F.col("transaction_id"),
        amount=F.col("amount"),
        category=F.col("category"),
        alert_time=F.col("event_time"),
        details=F.format_string(
            f"Transaction %s amount %s exceeds {limit}", "transaction_id", plain_number("amount")
        ),
    )


# --- tumbling windows --------------------------------------------------------------------------------


def failed_surge(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Windows with too many failed transactions. The count is partial before the shuffle, so one window
    that holds most of the data still sends one row per task."""
    seconds = settings.failed_window_seconds
    counted = (
        events.where("result = 'failed'")
        .groupBy(tumbling(seconds).alias("window"))
        .agg(F.count("*").alias("failed"))
        .where(F.col("failed") >= settings.failed_count)
    )
    return as_alerts(
        counted,
        S.FAILED_SURGE,
        user_id=F.lit(S.EVERYBODY),
        transaction_count=F.col("failed"),
        window_start=F.col("window.start"),
        window_end=F.col("window.end"),
        alert_time=F.col("window.end"),
        details=F.format_string(f"%d failed transactions in last {seconds}s", "failed"),
    )


def _with_known_address(events: DataFrame, settings: RiskSettings) -> DataFrame:
    if not settings.excluded_ips:
        return events
    return events.where(F.coalesce(~F.col("ip_address").isin(*settings.excluded_ips), F.lit(True)))


def ip_sharing_users(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Each user of each address once per window, batch or stream: what the alerts are counted from.

    On a stream a row is out when the user is first seen; with the stored alerts of the same windows it tells all
    users behind them.
    """
    pairs = _with_known_address(events, settings).where("user_id IS NOT NULL")
    pairs = pairs.select(tumbling(settings.shared_ip_window_seconds).alias("window"), "ip_address", "user_id")
    return pairs.dropDuplicates(["window", "ip_address", "user_id"])


def _shared_addresses(users: DataFrame, settings: RiskSettings) -> DataFrame:
    """One row per window and address with enough users. Counting is partial before the shuffle, so a busy address
    is one row per task."""
    return (
        users.groupBy("window", "ip_address")
        .agg(F.count("*").alias("user_count"), F.min("user_id").alias("first_user"))
        .where(F.col("user_count") >= settings.shared_ip_users)
    )


def ip_sharing(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Addresses used by several users within one window, batch or stream.

    The alert has their number and belongs to the smallest; every user is a row of ``ip_sharing_members``.
    """
    seconds = settings.shared_ip_window_seconds
    return as_alerts(
        _shared_addresses(ip_sharing_users(events, settings), settings),
        S.IP_SHARING,
        user_id=F.col("first_user"),
        ip_address=F.col("ip_address"),
        user_count=F.col("user_count"),
        window_start=F.col("window.start"),
        window_end=F.col("window.end"),
        alert_time=F.col("window.end"),
        details=F.format_string(f"IP %s has %d distinct users in {seconds}s", "ip_address", "user_count"),
    )


def ip_sharing_members(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """All users behind the shared-address alerts, one row each, however many there are (batch). Adaptive execution
    splits a window and address with very many users where the two sides meet."""
    users = ip_sharing_users(events, settings)
    shared = _shared_addresses(users, settings).select(
        F.col("window").alias("shared_window"), F.col("ip_address").alias("shared_address")
    )
    same = F.col("ip_address").eqNullSafe(F.col("shared_address")) & (F.col("window") == F.col("shared_window"))
    return users.join(shared, same, "left_semi").selectExpr(
        "window.start AS window_start", "window.end AS window_end", "ip_address", "user_id"
    )


# --- bursts of one user ------------------------------------------------------------------------------


def burst_alerts(bursts: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Alert projection of rows (user_id, timestamp, transaction_count)."""
    window = settings.burst_window_ms
    at = F.timestamp_millis("timestamp")
    return as_alerts(
        bursts,
        S.HIGH_FREQUENCY,
        user_id=F.col("user_id"),
        transaction_count=F.col("transaction_count"),
        window_start=F.timestamp_millis(F.col("timestamp") - F.lit(window)),
        window_end=at,
        alert_time=at,
        details=F.format_string(
            f"User %s has %d transactions in last {window / 1000:.0f} seconds",
            "user_id",
            "transaction_count",
        ),
    )


def high_frequency(events: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """One alert per event that is at least the n-th of its user within the window before it, itself
    included. Events of one millisecond count in arrival order: k-th of them sees k - 1 of the others.

    Equal milliseconds are counted together first. An event leaves the window at ``timestamp + window``: a row of +n
    at its arrival and one of -n at its leaving turn "how many are in the window" into a running sum, which is linear,
    where a range frame would rescan its window for every row. Each user's time line is cut into slices of a fixed
    width; a slice sums its own rows, of which there are two a millisecond at most, and starts from the sum of all
    slices before it, one row per user and slice. So no task's share depends on the length of the window.
    """
    window = settings.burst_window_ms
    arrivals = (
        events.where("user_id IS NOT NULL")
        .groupBy("user_id", "timestamp")
        .agg(F.count("*").alias("arrivals"))
    )

    def change(at: Column, arriving: int, by: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(arriving).alias("arriving"), by.alias("change"))

    arriving = change(F.col("timestamp"), 1, F.col("arrivals"))
    leaving = change(F.col("timestamp") + F.lit(window), 0, -F.col("arrivals"))
    changes = (
        arrivals.select("user_id", F.inline(F.array(arriving, leaving)))
        .withColumn("slice", F.floor(F.col("at") / F.lit(_BURST_SLICE_MS)).cast("bigint"))
        .repartition("user_id", "slice")
    )
    before_slice = W.partitionBy("user_id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        changes.groupBy("user_id", "slice")
        .agg(F.sum("change").alias("left_over"))
        .select("user_id", "slice", F.coalesce(F.sum("left_over").over(before_slice), F.lit(0)).alias("carried"))
    )
    so_far = (
        W.partitionBy("user_id", "slice")
        .orderBy("at", "arriving")  # leaving first: the lower bound of the window is exclusive
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    least = F.lit(settings.burst_count).cast("bigint")
    bursts = (
        changes.withColumn("in_slice", F.sum("change").over(so_far))
        .where("arriving = 1")
        .join(carried, ["user_id", "slice"])
        .withColumn("in_window", F.col("in_slice") + F.col("carried"))
        .withColumn("arrivals", F.col("change"))
        .where(F.col("in_window") >= least)
        .withColumn("before", F.col("in_window") - F.col("arrivals"))
        .withColumn("first", F.greatest(F.lit(1).cast("bigint"), least - F.col("before")))
    )
    block = F.lit(_TIE_BLOCK).cast("bigint")
    one_per_event = (
        bursts.withColumn("block", F.explode(F.sequence("first", "arrivals", block)))
        .withColumn(
            "kth", F.explode(F.sequence("block", F.least(F.col("block") + block - 1, F.col("arrivals"))))
        )
        .select(
            "user_id",
            F.col("at").alias("timestamp"),
            (F.col("before") + F.col("kth")).alias("transaction_count"),
        )
    )
    return burst_alerts(one_per_event, settings)


# --- growing amounts of one user ---------------------------------------------------------------------


def growth_alerts(runs: DataFrame, settings: RiskSettings = DEFAULTS) -> DataFrame:
    """Alert projection of rows (user_id, transaction_id, timestamp, amount, amounts)."""
    length = settings.growth_length
    return as_alerts(
        runs,
        S.CONTINUOUS_INCREASE,
        user_id=F.col("user_id"),
        transaction_id=F.col("transaction_id"),
        amount=F.col("amount"),
        sequence_length=F.lit(length),
        amounts=F.col("amounts"),
        alert_time=F.timestamp_millis("timestamp"),
        details=F.format_string(
            f"User %s has {length} consecutive increasing transactions", "user_id"
        ),
    )


def _grows(amount: Column, previous: Column, settings: RiskSettings) -> Column:
    """Whether ``amount`` carries on the run of ``previous``; false after nothing."""
    return F.coalesce(amount >= previous * F.lit(settings.growth_factor), F.lit(False))


def continuous_increase(
    events: DataFrame, settings: RiskSettings = DEFAULTS, slice_ms: int = 3_600_000, slice_rows: int = 100_000
) -> DataFrame:
    """An alert at every ``growth_length``-th event of a run in which each amount of a user is at least
    ``growth_factor`` times the one before. An alert starts the count anew, hence every n-th and not every
    event from the n-th on.

    Each user's time line is cut into slices of about ``slice_ms``, and where a slice would hold more than
    ``slice_rows`` events, into finer ones, so that one user with a third of all events is shared out even if they fall
    within an hour. Runs are counted inside each slice; a run that crosses slices is put right by what each slice
    inherits from the user's slices before it, one row per user and slice.
    """
    events = events.where("user_id IS NOT NULL").select("user_id", *S.EVENT_ORDER, "amount")
    rows = _sliced(events, slice_ms, slice_rows)
    runs = _runs_in_slice(rows, settings)
    counted = runs.join(_inherited(runs, settings), ["user_id", "slice"], "left")
    carried = F.when(F.col("run_start") == 1, F.coalesce("inherited_length", F.lit(0))).otherwise(F.lit(0))
    place = F.col("nth") - F.col("run_start") + 1 + carried
    before = F.coalesce("inherited_amounts", F.array().cast("array<double>"))
    amounts = F.slice(F.concat(before, "recent"), -settings.growth_length, settings.growth_length)
    alerting = counted.where(place % settings.growth_length == 0)
    return growth_alerts(alerting.withColumn("amounts", amounts), settings)


def _sliced(events: DataFrame, slice_ms: int, slice_rows: int) -> DataFrame:
    """``events`` with ``slice``, the start of their piece of their user's time line: a coarse one, or one of its 60
    parts if the coarse one has more than ``slice_rows`` events, or one of 60 parts of that if that still has.

    Events are counted by the finest parts, which partial sums do before the shuffle, and meet the list of parts on
    them, so that no user and no coarse slice meets in one task. The list holds full slices only.
    """
    fine = max(1, slice_ms // 3600)

    def start(width: int) -> Column:
        return F.col("timestamp") - F.pmod("timestamp", F.lit(width).cast("bigint"))

    keys = {"part": start(fine), "middle": start(fine * 60), "coarse": start(fine * 3600)}
    counts = events.groupBy("user_id", *[at.alias(name) for name, at in keys.items()]).agg(F.count("*").alias("events"))
    full = (
        counts.withColumn("in_coarse", F.sum("events").over(W.partitionBy("user_id", "coarse")))
        .withColumn("in_middle", F.sum("events").over(W.partitionBy("user_id", "coarse", "middle")))
        .where(F.col("in_coarse") > slice_rows)
        .select("user_id", "part", F.when(F.col("in_middle") > slice_rows, F.col("part")).otherwise(F.col("middle")).alias("finer"))
    )
    parted = events.withColumns({name: keys[name] for name in ("part", "coarse")})
    return parted.join(full, ["user_id", "part"], "left").select(
        *events.columns, F.coalesce("finer", "coarse").alias("slice")
    )


def _runs_in_slice(rows: DataFrame, settings: RiskSettings) -> DataFrame:
    """Number each user's events inside a slice (``nth``) and say where their run began (``run_start``),
    with the last ``growth_length`` amounts."""
    in_time = W.partitionBy("user_id", "slice").orderBy(*S.EVENT_ORDER, "amount")
    so_far = in_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = [F.lag("amount", k).over(in_time) for k in range(settings.growth_length - 1, 0, -1)]
    return (
        rows.withColumn("nth", F.row_number().over(in_time))
        .withColumn("previous", F.lag("amount").over(in_time))
        .withColumn("recent", F.array_compact(F.array(*earlier, "amount")))
        .withColumn(
            "run_start",
            F.max(F.when(~_grows(F.col("amount"), F.col("previous"), settings), F.col("nth"))).over(so_far),
        )
    )


def _inherited(runs: DataFrame, settings: RiskSettings) -> DataFrame:
    """What the first events of a slice inherit per user: the length of the run they carry on, zero if they
    do not, and the last amounts before them."""
    kept = settings.growth_length - 1
    pieces = (
        runs.groupBy("user_id", "slice")
        .agg(
            F.max("nth").alias("events"),
            F.max("run_start").alias("last_run"),
            F.min_by("amount", "nth").alias("first_amount"),
            F.max_by("recent", "nth").alias("last_amounts"),
        )
    )
    by_user = W.partitionBy("user_id").orderBy("slice")
    earlier = by_user.rowsBetween(-kept, -1)
    before = F.flatten(F.collect_list("last_amounts").over(earlier))
    joined = pieces.withColumn("before", before).withColumn(
        "joins", _grows(F.col("first_amount"), F.try_element_at("before", F.lit(-1)), settings)
    )
    # The run at the end of a piece goes on from the piece before only if the whole piece is one run.
    lengths = (
        joined.withColumn("goes_through", F.col("joins") & (F.col("last_run") == 1))
        .withColumn("span", F.sum(F.when(~F.col("goes_through"), 1).otherwise(0)).over(by_user))
        .withColumn("own_length", F.col("events") - F.col("last_run") + 1)
        .withColumn(
            "end_length",
            F.sum("own_length").over(W.partitionBy("user_id", "span").orderBy("slice")),
        )
        .withColumn("previous_length", F.lag("end_length").over(by_user))
    )
    return lengths.select(
        "user_id",
        "slice",
        F.when(F.col("joins"), F.col("previous_length")).otherwise(F.lit(0)).alias("inherited_length"),
        F.col("before").alias("inherited_amounts"),
    )

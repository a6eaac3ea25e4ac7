"""Bar sources: read a bar table, enforce its types, derive bars from events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_COLUMNS = ("open", "high", "low", "close")
BAR_COLUMNS = ("ticker", "trade_date", "timestamp", "open", "high", "low", "close", "volume")
KEY_COLUMNS = ("ticker", "trade_date", "timestamp")


def enforce_bar_types(df: DataFrame) -> DataFrame:
    """Cast the eight bar columns to their types; other columns are dropped.

    ticker string, trade_date date, timestamp kept as timestamp or
    timestamp_ntz (cast if it is anything else), prices double, volume kept
    if integral or double, else double. NaN and infinite prices become null so
    they cannot sort above every number in the regime rules.
    """
    missing = [c for c in BAR_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"bar table lacks columns {missing}")
    fields = {f.name: f.dataType for f in df.schema.fields}
    ts = F.col("timestamp")
    if not isinstance(fields["timestamp"], (T.TimestampType, T.TimestampNTZType)):
        ts = ts.cast("timestamp")
    vol = F.col("volume")
    if not isinstance(fields["volume"], (T.LongType, T.IntegerType, T.ShortType, T.DoubleType)):
        vol = vol.cast("double")
    elif isinstance(fields["volume"], (T.IntegerType, T.ShortType)):
        vol = vol.cast("long")

    def price(name: str) -> Column:
        # NaN and infinities become null: Spark orders NaN above every number.
        c = f"CAST(`{name}` AS DOUBLE)"
        return F.expr(f"CASE WHEN isnan({c}) OR abs({c}) = double('Infinity') THEN NULL ELSE {c} END").alias(name)

    return df.select(
        F.col("ticker").cast("string").alias("ticker"),
        F.col("trade_date").cast("date").alias("trade_date"),
        ts.alias("timestamp"),
        *[price(p) for p in PRICE_COLUMNS],
        vol.alias("volume"),
    )


def read_bars(spark: SparkSession, source: str, fmt: str = "parquet",
              drop_null_keys: bool = True, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Read bars from a catalog table name or a path, typed as in the schema.

    ``fmt="table"`` reads a catalog table; any other value is a file format.
    ``mapping`` gives the source's column for a bar column where the names
    differ, e.g. ``{"ticker": "symbol"}``. Rows without ticker, trade_date or timestamp have no place in a daily
    sequence and are left out when ``drop_null_keys`` (count them with
    ``null_key_rows``).
    """
    raw = spark.table(source) if fmt == "table" else spark.read.format(fmt).load(source)
    if mapping:
        unknown = [c for c in mapping if c not in BAR_COLUMNS]
        if unknown:
            raise ValueError(f"not bar columns: {unknown}")
        raw = raw.select(*[F.col(mapping.get(c, c)).alias(c) for c in BAR_COLUMNS])
    bars = enforce_bar_types(raw)
    if drop_null_keys:
        bars = bars.where(~null_key())
    return bars


def write_bar_table(bars: DataFrame, name: str, buckets: int) -> None:
    """Write bars as a catalog table bucketed by (ticker, trade_date) and sorted in time order.

    Every intraday window and daily roll-up is keyed by exactly these columns,
    so over ``read_bars(spark, name, fmt="table")`` none of them shuffles the
    bars. ``buckets`` is the number of tasks that read the table; the bars are
    dealt to the buckets before the write, one file a bucket.
    """
    (bars.repartition(buckets, "ticker", "trade_date").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "ticker", "trade_date").sortBy("ticker", "trade_date", "timestamp").saveAsTable(name))


def null_key() -> Column:
    """Whether a bar lacks a key column."""
    return F.expr(" OR ".join(f"{k} IS NULL" for k in KEY_COLUMNS))


def null_key_rows(raw: DataFrame) -> DataFrame:
    """One row: how many input rows lack a key column."""
    return raw.agg(F.count_if(null_key()).alias("null_key_rows"))


# --- fixed values: the events -> bars test mapping --------------------------
WALK_START_CENTS = 10_000_000   # price walk starts at 100,000.00
WALK_DRIFT_CENTS = 5_000        # subtracted from every step
SURGE_DAY_MODULUS = 5           # every 5th day of the month ...
SURGE_FACTOR = 3                # ... has triple volume


def bars_from_events(events: DataFrame) -> DataFrame:
    """Turn the driver's ``events`` table into minute bars, one per (ticker, minute), over every event.

    Each event type is a ticker. ``value`` in cents is integrated into a
    price walk per ticker: a minute's step is the sum of its events' steps,
    close = running sum over the minutes, open = close before this minute.
    All arithmetic is in integer cents until the final division, so any
    engine gets equal doubles. Events of a Saturday or Sunday belong to the
    following Monday's ``trade_date`` (their timestamps stay), so trading
    days have gaps and no event is lost: those without a type or a time are
    bars with a null key (``read_bars`` counts and drops such bars).

    Events meet in a sum per minute, combined before the shuffle, so a task
    holds at most the 1,440 minutes a calendar day of a ticker, however many
    events it has. Prefix sums then go minute -> day -> history over the
    small tables. The output leaves hash-partitioned by (ticker,
    trade_date), which every daily roll-up and intraday sequence downstream
    reuses without another shuffle.
    """
    minutes = (
        events.select(
            F.expr("event_type AS ticker"),
            F.expr("date_add(CAST(ts AS DATE), CASE dayofweek(ts) WHEN 7 THEN 2 WHEN 1 THEN 1 ELSE 0 END) AS trade_date"),
            F.expr("date_trunc('MINUTE', ts) AS timestamp"),
            F.expr("CAST(ROUND(value * 100) AS BIGINT) AS cents"))
        .groupBy("ticker", "trade_date", "timestamp")
        .agg(F.expr(f"sum(cents - {WALK_DRIFT_CENTS}) AS step"), F.expr("sum(cents) AS cents"))
        .repartition("ticker", "trade_date")
    )
    day_offsets = (
        minutes.groupBy("ticker", "trade_date").agg(F.expr("sum(step) AS day_total"))
        .select(
            F.expr("ticker AS _t"), F.expr("trade_date AS _d"),
            F.expr("coalesce(sum(day_total) OVER (PARTITION BY ticker ORDER BY trade_date "
                   "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offset"),
        )
    )
    # null-safe: an event without a type or a time is a bar of its own key
    walk = minutes.join(day_offsets, F.expr("ticker <=> _t AND trade_date <=> _d"), "inner").select(
        F.expr("ticker"), F.expr("trade_date"), F.expr("timestamp"), F.expr("step"), F.expr("cents"),
        F.expr(f"{WALK_START_CENTS} + offset + sum(step) OVER (PARTITION BY ticker, trade_date "
               "ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c"),
    )
    return walk.select(
        F.expr("ticker"),
        F.expr("trade_date"),
        F.expr("timestamp"),
        F.expr("CAST(c - step AS DOUBLE) / 100.0 AS open"),
        F.expr("GREATEST(CAST(c - step AS DOUBLE), CAST(c AS DOUBLE)) / 100.0 AS high"),
        F.expr("LEAST(CAST(c - step AS DOUBLE), CAST(c AS DOUBLE)) / 100.0 AS low"),
        F.expr("CAST(c AS DOUBLE) / 100.0 AS close"),
        F.expr(f"CAST(cents * CASE WHEN dayofmonth(trade_date) % {SURGE_DAY_MODULUS} = 0 "
               f"THEN {SURGE_FACTOR} ELSE 1 END AS BIGINT) AS volume"),
    )


# Column types of the driver's ``events`` table; passing them skips footer inference.
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
TABLE_SCHEMAS = {"events": EVENTS_SCHEMA}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars derived from ``events`` under a test-data folder."""
    return bars_from_events(load_table(spark, sf_dir, "events"))

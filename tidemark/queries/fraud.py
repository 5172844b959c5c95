"""Example views over the event tables: card transactions, users and merchants."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.aggregates import Aggregate
from tidemark.functions.scalar import card_issuer, flag_above, or_zero
from tidemark.functions.time import midnight
from tidemark.operators.ondemand import OnDemand, on_demand
from tidemark.plans.service import Service
from tidemark.plans.views import View, batch_view, stream_view
from tidemark.session import configure
from tidemark.sources.spine import Request
from tidemark.sources.tables import Source, read_table, stream_table

MINUTE, HOUR, DAY = timedelta(minutes=1), timedelta(hours=1), timedelta(days=1)


def transactions(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("m_"), F.regexp_extract("props", "[0-9]+", 0)).alias("merchant"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amt"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_fraud"),
    )


def users(events: DataFrame) -> DataFrame:
    """Sign-ups; a user who signs up again gets another card."""
    signups = events.filter(F.col("event_type") == "signup")
    leading = (F.lit(3) + F.col("event_id") % 5).cast("long")
    return signups.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        (leading * F.lit(10**12) + F.col("event_id")).alias("cc_num"),
        F.col("ts").alias("signup_timestamp"),
    )


class Fraud:
    """Sources, views and services of the example, over the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    # -- sources ------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        return read_table(self.spark, self.folder, "events")

    @cached_property
    def txn(self) -> DataFrame:
        return transactions(self.events)

    @cached_property
    def txn_source(self) -> Source:
        def stream():
            return transactions(stream_table(self.spark, self.folder, "events"))

        return Source("transactions", self.txn, "timestamp", stream).filter_by_time()

    @cached_property
    def user_source(self) -> Source:
        def stream():
            return users(stream_table(self.spark, self.folder, "events"))

        return Source("users", users(self.events), "signup_timestamp", stream)

    @cached_property
    def spine(self) -> DataFrame:
        """Every transaction with its label."""
        return self.txn.select("event_id", "user_id", "merchant", "timestamp", "amt", "is_fraud")

    @cached_property
    def days(self) -> tuple[datetime, datetime]:
        """First day with transactions and the day after the last."""
        day = midnight(F.col("timestamp"))
        low, high = self.txn.agg(
            F.min(day).cast("timestamp_ntz"), F.max(day).cast("timestamp_ntz")
        ).first()
        return low, high + DAY

    # -- views --------------------------------------------------------------

    @cached_property
    def card(self) -> View:
        @batch_view(
            sources=[self.user_source],
            keys=["user_id"],
            ts="signup_timestamp",
            mode="frame",
            schedule=DAY,
            ttl=10 * DAY,
        )
        def card(users):
            issuer = card_issuer(F.col("cc_num")).alias("issuer")
            return users.select("user_id", "signup_timestamp", issuer)

        return card

    @cached_property
    def card_now(self) -> View:
        """The same feature, visible at once and without an age limit."""

        @stream_view(source=self.user_source, keys=["user_id"], ts="signup_timestamp", mode="frame")
        def card_now(users):
            issuer = card_issuer(F.col("cc_num")).alias("issuer")
            return users.select("user_id", "signup_timestamp", "cc_num", issuer)

        return card_now

    @cached_property
    def over_50(self) -> View:
        """Rows with a 0/1 flag, each event as it comes."""

        @stream_view(source=self.txn_source, keys=["user_id"], ts="timestamp", ttl=HOUR)
        def over_50(transactions):
            return f"""
                SELECT event_id, user_id, timestamp,
                       CAST(coalesce(amt > 50, false) AS INT) AS over_50
                FROM {transactions}
            """

        return over_50

    @cached_property
    def over_50_counts(self) -> View:
        """Transactions over 50: only those have a value to count."""
        windows = (15 * MINUTE, 30 * MINUTE, HOUR)

        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            interval=5 * MINUTE,
            aggregations=[Aggregate("over_50", "count", w) for w in windows],
        )
        def over_50_counts(transactions):
            return f"""
                SELECT user_id, timestamp, nullif(amt > 50, false) AS over_50
                FROM {transactions}
            """

        return over_50_counts

    @cached_property
    def over_50_flags(self) -> View:
        """The count of a 0/1 column, which counts every transaction, beside its sum."""
        windows = (15 * MINUTE, 30 * MINUTE, HOUR)

        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            mode="frame",
            interval=5 * MINUTE,
            aggregations=[
                Aggregate("over_50", f, w) for f in ("count", "sum") for w in windows
            ],
        )
        def over_50_flags(transactions):
            return transactions.select(
                "user_id", "timestamp", flag_above(F.col("amt"), 50).alias("over_50")
            )

        return over_50_flags

    @cached_property
    def amounts(self) -> View:
        windows = (HOUR, 12 * HOUR, DAY, 3 * DAY)

        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            interval=10 * MINUTE,
            aggregations=[Aggregate("amt", f, w) for f in ("mean", "sum") for w in windows],
        )
        def amounts(transactions):
            return f"SELECT user_id, timestamp, amt FROM {transactions}"

        return amounts

    @cached_property
    def txn_counts(self) -> View:
        @batch_view(
            sources=[self.txn_source],
            keys=["user_id"],
            ts="timestamp",
            schedule=DAY,
            aggregations=[Aggregate("event_id", "count", w * DAY) for w in (1, 7, 30)],
        )
        def txn_counts(transactions):
            return f"SELECT user_id, timestamp, event_id FROM {transactions}"

        return txn_counts

    @cached_property
    def merchant_fraud(self) -> View:
        @batch_view(
            sources=[self.txn_source],
            keys=["merchant"],
            ts="timestamp",
            schedule=DAY,
            aggregations=[Aggregate("is_fraud", "mean", w * DAY) for w in (1, 30, 90)],
        )
        def merchant_fraud(transactions):
            return f"SELECT merchant, timestamp, is_fraud FROM {transactions}"

        return merchant_fraud

    @cached_property
    def variety(self) -> View:
        @batch_view(
            sources=[self.txn_source],
            keys=["user_id"],
            ts="timestamp",
            schedule=DAY,
            aggregations=[Aggregate("merchant", "distinct", 30 * DAY)],
        )
        def variety(transactions):
            return f"SELECT user_id, timestamp, merchant FROM {transactions}"

        return variety

    @cached_property
    def last_stores(self) -> View:
        @batch_view(
            sources=[self.txn_source],
            keys=["user_id"],
            ts="timestamp",
            schedule=DAY,
            aggregations=[Aggregate("merchant", "last", 14 * DAY, 10)],
        )
        def last_stores(transactions):
            return f"SELECT user_id, timestamp, merchant FROM {transactions}"

        return last_stores

    @cached_property
    def different_stores(self) -> View:
        """The newest ten different stores of two weeks, each at its newest visit."""

        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            interval=DAY,
            aggregations=[Aggregate("merchant", "last_distinct", 14 * DAY, 10)],
        )
        def different_stores(transactions):
            return f"SELECT user_id, timestamp, merchant FROM {transactions}"

        return different_stores

    @cached_property
    def extremes(self) -> View:
        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            interval=10 * MINUTE,
            aggregations=[Aggregate("amt", f, w) for f in ("min", "max") for w in (HOUR, 3 * DAY)],
        )
        def extremes(transactions):
            return f"SELECT user_id, timestamp, amt FROM {transactions}"

        return extremes

    @cached_property
    def live_extremes(self) -> View:
        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            aggregations=[Aggregate("amt", f, w) for f in ("min", "max") for w in (HOUR, 3 * DAY)],
        )
        def live_extremes(transactions):
            return f"SELECT user_id, timestamp, amt FROM {transactions}"

        return live_extremes

    @cached_property
    def rough_variety(self) -> View:
        """Users per merchant, counted exactly and by sketches."""

        @stream_view(
            source=self.txn_source,
            keys=["merchant"],
            ts="timestamp",
            interval=DAY,
            aggregations=[Aggregate("user_id", f, w * DAY) for w in (7, 30) for f in ("distinct", "approx_distinct")],
        )
        def rough_variety(transactions):
            return f"SELECT merchant, timestamp, user_id FROM {transactions}"

        return rough_variety

    @cached_property
    def live(self) -> View:
        """Without an interval: every window ends at the very moment asked about."""

        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            aggregations=[
                Aggregate("amt", "count", HOUR),
                Aggregate("amt", "sum", HOUR),
                Aggregate("amt", "mean", 3 * DAY),
            ],
        )
        def live(transactions):
            return f"SELECT user_id, timestamp, amt FROM {transactions}"

        return live

    @cached_property
    def live_stores(self) -> View:
        """Stores of the last day and the newest five of them, up to the moment."""

        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            aggregations=[
                Aggregate("merchant", "distinct", DAY),
                Aggregate("merchant", "distinct", 7 * DAY),
                Aggregate("merchant", "last", 7 * DAY, 5),
            ],
        )
        def live_stores(transactions):
            return f"SELECT user_id, timestamp, merchant FROM {transactions}"

        return live_stores

    @cached_property
    def hourly(self) -> View:
        @stream_view(
            source=self.txn_source,
            keys=["user_id"],
            ts="timestamp",
            interval=5 * MINUTE,
            aggregations=[Aggregate("amt", "count", HOUR)],
        )
        def hourly(transactions):
            return f"SELECT user_id, timestamp, amt FROM {transactions}"

        return hourly

    # -- on demand ----------------------------------------------------------

    @cached_property
    def request(self) -> Request:
        return Request.of("purchase", "amt double")

    def amount_check(self, mode: str = "native") -> OnDemand:
        """Is the amount above the user's three-day mean? No mean counts as 0."""
        mean = "amt_mean_3d_10m"

        def native(purchase, amounts):
            return {"above_mean": purchase["amt"] > or_zero(amounts[mean])}

        def pandas(purchase, amounts):
            return (purchase["amt"] > amounts[mean].fillna(0)).to_frame("above_mean")

        def python(purchase, amounts):
            return {"above_mean": purchase["amt"] > (amounts[mean] or 0)}

        bodies = {"native": native, "pandas": pandas, "python": python}
        declare = on_demand(
            inputs=[self.request, self.amounts[[mean]]], mode=mode, schema="above_mean boolean"
        )
        made = declare(bodies[mode])
        return OnDemand("amount_check", made.inputs, made.mode, made.schema, made.body)

    # -- services -----------------------------------------------------------

    @cached_property
    def service(self) -> Service:
        base = Service.of(
            "fraud",
            [
                self.amounts,
                self.txn_counts[["event_id_count_1d_1d"]],
                self.merchant_fraud,
                self.variety,
                self.amount_check(),
            ],
        )
        return Service.of("fraud", [*base.features, self.card]).validate()

    @cached_property
    def small_service(self) -> Service:
        """A leaner variant that needs no request columns."""
        kept = ["amt_mean_1h_10m", "amt_mean_3d_10m", "amt_sum_1h_10m", "amt_sum_3d_10m"]
        return self.service.variant(
            "v3", [self.amounts[kept], self.txn_counts, self.merchant_fraud]
        )

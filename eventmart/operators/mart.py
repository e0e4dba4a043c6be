"""Per-(account, app) running mart: deltas of single events, aggregation and merging."""

from functools import reduce

from pyspark.sql import functions as F

from eventmart.schemas import CREDIT, DEBIT, LOGIN, LOSE, MART_KEY, MART_MEASURES, PAYPAL, WIN


def _one(condition):
    return F.when(condition, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))


def _amount(condition):
    return F.when(condition, F.col("purchase")).otherwise(F.lit(0.0))


def event_deltas(events):
    """Each event as a mart row of its own.

    The purchase amount counts for every event type, and a payment column follows `payment_type`.
    """
    kind, payment = F.col("event_type"), F.col("payment_type")
    return events.select(
        *MART_KEY,
        _one(kind == LOGIN).alias("sign_on_count"),
        _one(kind == WIN).alias("win_count"),
        _one(kind == LOSE).alias("lose_count"),
        F.col("purchase").alias("purchase_total"),
        _amount(payment == CREDIT).alias("payment_credit_total"),
        _one(payment == CREDIT).alias("payment_credit_count"),
        _amount(payment == DEBIT).alias("payment_debit_total"),
        _one(payment == DEBIT).alias("payment_debit_count"),
        _amount(payment == PAYPAL).alias("payment_paypal_total"),
        _one(payment == PAYPAL).alias("payment_paypal_count"),
    )


def sum_by_key(rows):
    """Add up mart rows per key; hot keys shrink to one row per task before the shuffle."""
    return rows.groupBy(*MART_KEY).agg(*[F.sum(m).alias(m) for m in MART_MEASURES])


def account_mart(events):
    """The mart of a set of events. Works on batch and streaming frames alike."""
    return sum_by_key(event_deltas(events))


def merge_marts(*marts):
    """Sum of several marts over the union of their keys."""
    return sum_by_key(reduce(lambda a, b: a.unionByName(b), marts))

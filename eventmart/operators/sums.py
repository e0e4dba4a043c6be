"""Grouped sums per account and the fixed-size report of them."""

from pyspark.sql import functions as F


def wins_per_account(marts):
    return marts.groupBy("account_id").agg(F.sum("win_count").alias("win_count"))


def purchases_per_account(events):
    return events.groupBy("account_id").agg(F.sum("purchase").alias("purchase"))


def first_accounts(result, n=100):
    """The first `n` rows in account order: a top-k, never a full sort."""
    return result.orderBy("account_id").limit(n)

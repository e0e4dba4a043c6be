"""Stratified samples of exact size.

Every row has a repeatable draw, 60 bits of its id's digest, and a stratum of n rows gives the ceil(share x n) rows of the
smallest draws. Nothing is sorted for that but a narrow band: the draw at which a share of n even draws is reached
lies, but for a negligible chance, within a few standard deviations of that share. Rows below the band are taken, rows above it
are not, and only those inside wait to be ranked: about the square root of n, so a stratum that holds a third of a
large table still ranks few rows. Should a band miss, it is widened and counted again.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

GRAIN = 10_000  # shares are whole numbers of ten thousandths
BITS = 60
DEVIATIONS = 8


def draw_of(column):
    """Even, repeatable 60-bit number of an id."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _band(size, wanted, deviations):
    """(low, high) draws around the one that `wanted` of `size` even draws lie below."""
    p = wanted / size
    margin = deviations * (math.sqrt(p * (1 - p) / size) + 1 / size)
    return [min(1 << BITS, max(0, int((p + side * margin) * (1 << BITS)))) for side in (-1, 1)]


def exact_stratified_sample(rows, column, fractions, id_column, deviations=DEVIATIONS):
    """The rows of each named stratum with the ceil(share x size) smallest draws; unnamed strata give none.

    A function of the rows alone: neither partitions nor order matter. Ties are broken by id; rows that share an id beyond
    that are exchangeable. A null stratum is unnamed. `fractions` is as small as it is here: it is given by value.
    """
    shares = {value: round(share * GRAIN) for value, share in fractions.items()}
    placed = rows.select(F.struct("*").alias("row"), F.col(column).alias("stratum"), draw_of(id_column).alias("draw"), F.col(id_column).alias("id"))
    placed = placed.where(F.col("stratum").isin(list(shares)))
    sizes = {r["stratum"]: r["count"] for r in placed.groupBy("stratum").count().collect()}  # a row per named stratum
    wanted = {value: -(-size * shares[value] // GRAIN) for value, size in sizes.items()}
    wanted = {value: count for value, count in wanted.items() if count}
    if not wanted:
        return rows.limit(0)
    bands, below = {}, {}
    missed = dict.fromkeys(wanted, deviations)
    while missed:
        for value, width in missed.items():
            bands[value] = _band(sizes[value], wanted[value], width)
        low, high = (_by_stratum({v: b[side] for v, b in bands.items()}) for side in (0, 1))
        counted = placed.where(F.col("stratum").isin(list(missed))).groupBy("stratum").agg(
            F.count_if(F.col("draw") < low).alias("low"), F.count_if(F.col("draw") < high).alias("high")).collect()
        below.update({r["stratum"]: r["low"] for r in counted})
        hit = {r["stratum"] for r in counted if r["low"] <= wanted[r["stratum"]] <= r["high"]}
        missed = {v: 4 * width + 1 for v, width in missed.items() if v not in hit}
    low, high, need = (_by_stratum(x) for x in (
        {v: b[0] for v, b in bands.items()}, {v: b[1] for v, b in bands.items()}, {v: wanted[v] - below[v] for v in wanted}))
    taken = placed.where(F.col("draw") < low)
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy("draw", "id"))
    waiting = placed.where((F.col("draw") >= low) & (F.col("draw") < high)).withColumn("rank", rank).where(F.col("rank") <= need)
    return taken.select("row.*").unionByName(waiting.select("row.*"))


def _by_stratum(values):
    """The value of the row's stratum; null for a stratum that has none."""
    chosen = F.lit(None).cast("long")
    for value, number in values.items():
        chosen = F.when(F.col("stratum") == F.lit(value), F.lit(number).cast("long")).otherwise(chosen)
    return chosen

"""Helpers that several operators share."""

from pyspark.sql import functions as F

from eventmart.session import work_dir

SPACE_CLASS = r"[ \t-\r]"  # the six ASCII white-space characters 0x09-0x0D and 0x20
WORD_PATTERN = r"[^ \t-\r]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame, name):
    """The frame written to the shared folder and read again: the lineage is cut, lost executors cost no
    more than a read, and values that depend on row order stay as they are."""
    spark = frame.sparkSession
    path = work_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole_text(column="text"):
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))

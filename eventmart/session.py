"""Session settings and the shared working folder."""

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from eventmart.storage.files import Files

# State outside the JVM heap; a commit uploads the changes, not a snapshot.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name="eventmart", master=None, **conf):
    """Session with the settings the jobs are designed for; `conf` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        **STATE_STORE,
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark, name):
    """A new folder that all executors share, under `spark.checkpoint.dir` or else the warehouse.

    The folders of a session lie together and are removed when its driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    session = f"{root.rstrip('/')}/eventmart-{spark.sparkContext.applicationId}"
    files = Files(spark, session)
    if not files.exists(session):
        files.mkdirs(session)
        files.delete_on_exit(session)
    return f"{session}/{name}-{uuid.uuid4().hex}"


@contextmanager
def session_conf(spark, settings):
    """Set session options for the block and restore them afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

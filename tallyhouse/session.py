"""Session settings shared by the batch and the streaming jobs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on; none depends on the cluster's size.
SQL_SETTINGS = {
    # Calendar dates and CDC windows are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Broadcasts, partition counts and skew splits are decided from measured shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffled bytes of a task; rows of an item take about 30 times that in the sorts and hash maps of a join with sums.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Streaming state lives outside the heap, on a laptop as on a cluster.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A trigger stores the changes of its state, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the settings above to a session someone else has built.

    ``initial_partitions`` is the number of partitions a shuffle starts with before adaptive execution merges the
    small ones; a partition cannot be split again in an aggregate, so set it to the bytes of the largest shuffle
    over 128 MB. Without it the session's own setting holds.
    """
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    if initial_partitions is not None:
        spark.conf.set(INITIAL_PARTITIONS, str(initial_partitions))
    return spark


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Input files are compressed: a shuffle of the items took 715 MB for 440 MB of files.
INPUT_PER_PARTITION = 4 << 20


def partitions_for(spark: SparkSession, input_bytes: int) -> int | None:
    """The number of partitions shuffles should start with for that much input; None if the session's is enough."""
    own = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    needed = input_bytes // INPUT_PER_PARTITION
    return needed if needed > int(own) else None


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for some steps; what the session had comes back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# The size up to which a table is broadcast, as its files suggest it and as adaptive execution measures it.
BROADCAST, MEASURED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
# What a row with a key takes in a broadcast hash table.
KEY_BYTES = 100


def most_broadcast(spark: SparkSession) -> int:
    """Rows with a key that may be broadcast; none if the session has broadcasts turned off."""
    return max(0, spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()) // KEY_BYTES


def only_measured(spark: SparkSession) -> dict[str, str]:
    """Settings under which tables are broadcast by their measured size and never by that of their files.

    Rows may take a hundred times their compressed files: 5.4 million ids, a sixth of a file of 25 MB, took more than a
    driver of 750 MB has."""
    return {BROADCAST: "-1", MEASURED_BROADCAST: spark.conf.get(MEASURED_BROADCAST, None) or spark.conf.get(BROADCAST)}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyhouse")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Call sites of column expressions cost more than small queries take.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def side_by_side(*steps: Callable[[], object]) -> list:
    """Run steps that do not depend on each other at the same time; their results. The first failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


@cache
def _own_folder() -> str:
    """One folder for this process, removed at its end."""
    folder = tempfile.mkdtemp(prefix="tallyhouse-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for ``purpose`` under the shared folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _own_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

"""The retry queue as stream state (R-7, R-10 with R-1, R-2).

Requests (key, prompt) arrive as files. Per key the stream keeps what was asked
and how often (``applyInPandasWithState``: rows and states come to a task and go
back in Arrow batches of many keys, so a key costs no exchange of its own with the
state store); a failed call sets a timer for its next try, random exponential as in
``enrich.Policy``, and when the timer fires the call is made again, whether or not
new requests come. A success, or the last
failure, is written once; a request that comes again with the same prompt is
known and not called. A changed prompt is a new request.

State and timers live in the checkpoint, sharded by key over the state
partitions: a query that stops or loses executors goes on with the queue it
had, and nothing is replayed from a dead-letter table. A micro-batch that fails
half-way is run again as a whole, so its calls (and no others) may be made
twice; its rows are written once."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dossier.operators import enrich as EN

REQUEST = TY.StructType([TY.StructField("key", TY.StringType()), TY.StructField("prompt", TY.StringType())])
OUTCOME = TY.StructType([*REQUEST.fields, *EN.ENRICH_FIELDS])
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: One key's request; ``due``: when its next try is, in milliseconds.
STATE = "prompt string, attempts int, done boolean, due long"


class RetryQueue:
    """The step of one key; calls and their pace are those of the task."""

    def __init__(self, fn: Callable[[str, int], object], policy: EN.Policy):
        self.fn, self.policy = fn, policy
        self.calls = self.pacer = None

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if self.calls is None:  # they hold locks, so a task makes its own
            self.calls, self.pacer = EN._Calls(1), EN._Pacer(self.policy.rate)
        known = state.get if state.exists else None
        asked = None
        for pdf in frames:
            for prompt in pdf["prompt"]:
                asked = (prompt if isinstance(prompt, str) else None,)
        if state.hasTimedOut:
            if not known[2]:
                yield from self.attempt(key, known[0], known[1], state)
        elif asked is not None and (known is None or known[0] != asked[0]):
            yield from self.attempt(key, asked[0], 0, state)
        elif known is not None and not known[2]:
            # asked again meanwhile: the timer, dropped by this call, is set anew
            state.setTimeoutDuration(max(1, known[3] - state.getCurrentProcessingTimeMs()))

    def attempt(self, key: tuple, prompt: str | None, before: int, state: GroupState) -> Iterator[pd.DataFrame]:
        """One call. Yields the outcome if it is the last, else sets the timer of the next."""
        p = self.policy
        if prompt is None:
            out = (None, EN.STATUS_PROMPT, "no prompt", 0)
        elif p.token_limit is not None and -(-len(prompt) // 4) > p.token_limit:
            out = (None, EN.STATUS_PROMPT, f"prompt over {p.token_limit} tokens", 0)
        else:
            once = EN.Policy(tries=1, timeout=p.timeout, token_limit=None, **EN.NO_WAIT)
            response, status, reason, _ = EN.call_with_policy(self.fn, (prompt, before + 1), once, self.pacer,
                                                              random.Random(), self.calls)
            out = (response, status, reason, before + 1)
            if status not in (EN.STATUS_OK, EN.STATUS_TIMEOUT) and before + 1 < p.tries:
                top = max(p.wait_min, min(p.wait_max, p.wait_min * 2 ** before))
                wait = max(1, int(1000 * random.uniform(p.wait_min, top)))
                state.update((prompt, before + 1, False, state.getCurrentProcessingTimeMs() + wait))
                state.setTimeoutDuration(wait)
                return
        state.update((prompt, out[3], True, 0))
        row = dict(zip(OUTCOME.fieldNames(), (key[0], prompt, *out), strict=True))
        yield pd.DataFrame({c: np.array([v], np.int32 if c == "attempts" else object) for c, v in row.items()})


def retry_stream(requests: DataFrame, fn: Callable[[str, int], object], policy: EN.Policy) -> DataFrame:
    """Outcomes of a stream of ``REQUEST`` rows; ``fn(prompt, attempt)`` is called
    at most ``policy.tries`` times per request."""
    return requests.groupBy("key").applyInPandasWithState(
        RetryQueue(fn, policy), OUTCOME, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def outcomes(spark: SparkSession, output_dir: str) -> DataFrame:
    """What has been written so far."""
    return spark.read.schema(OUTCOME).parquet(output_dir)


def run_retrying(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str,
                 fn: Callable[[str, int], object], policy: EN.Policy, seconds: float | None = None) -> bool:
    """Works off the requests below ``input_dir`` until each has its outcome, or
    for about ``seconds``; True when nothing is left. A later call goes on."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKS_DB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    # a batch writes what it changed, not all states anew
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    asked = spark.read.schema(REQUEST).parquet(input_dir).distinct()
    stream = spark.readStream.schema(REQUEST).parquet(input_dir)
    query = (retry_stream(stream, fn, policy).writeStream.format("parquet").option("path", output_dir)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime="1 second").start())
    end = None if seconds is None else time.monotonic() + seconds
    checked = -1
    try:
        while True:
            # with timers there is always a next batch, so the stream is never "all processed";
            # what is left can only change with a batch, and a look at it reads all outcomes
            over = end is not None and time.monotonic() >= end
            progress = query.lastProgress
            batch = progress["batchId"] if progress else None
            if (over or batch != checked) and _left(asked, outcomes(spark, output_dir)).isEmpty():
                return True
            checked = batch
            if over:
                return False
            if query.awaitTermination(1):
                raise RuntimeError(str(query.exception() or "the stream has stopped"))
    finally:
        query.stop()
        query.awaitTermination()


def _left(asked: DataFrame, done: DataFrame) -> DataFrame:
    """Requests without an outcome."""
    d = done.select(F.col("key").alias("k"), F.col("prompt").alias("p"))
    return asked.join(d, F.col("key").eqNullSafe(F.col("k")) & F.col("prompt").eqNullSafe(F.col("p")), "left_anti")

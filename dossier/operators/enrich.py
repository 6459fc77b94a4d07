"""Row enrichment through a user-supplied callable (U-1, R-1..R-6, R-9).

This is the only place where rows enter a Python worker. It runs as
``mapInPandas`` (Arrow batches), so Spark partitions the work; inside a
task each row is called once, with retries, a per-call deadline and a
per-task rate limit. Failures never fail the task: every row comes back
with ``status`` in {ok, error, timeout, prompt} and a ``reason``.

Materialise the result exactly once (``dossier.session.materialize``)
before splitting it into results and dead letters; a lazy plan would call
the service again for every action on it. Keep speculation off for the
same reason."""

from __future__ import annotations

import math
import random
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as TY

from dossier.operators.assemble import PROMPT_TOKEN_LIMIT

STATUS_OK, STATUS_ERROR, STATUS_TIMEOUT, STATUS_PROMPT = "ok", "error", "timeout", "prompt"


@dataclass(frozen=True)
class Policy:
    """tries: total attempts per row (1 = no retry); waits between tries are
    random exponential, drawn from [wait_min, min(wait_max, wait_min*2^n)];
    timeout: seconds per call (None = none); rate: calls per second per
    task (None = unlimited); job_rate: calls per second of the whole job,
    however many of its tasks run; token_limit:
    prompts whose estimate exceeds it are routed as 'prompt' errors without
    a call (None = no check); concurrency: calls in flight per task (the
    service is I/O bound, so one task keeps several calls open; the global
    concurrency is tasks x concurrency)."""
    tries: int = 6
    wait_min: float = 1.0
    wait_max: float = 60.0
    timeout: float | None = 200.0
    rate: float | None = None
    job_rate: float | None = None
    token_limit: int | None = PROMPT_TOKEN_LIMIT
    concurrency: int = 1

    def __post_init__(self):
        if self.concurrency < 1:
            raise ValueError("concurrency must be >= 1")
        if self.tries < 1:
            raise ValueError("tries must be >= 1")
        if self.timeout is not None and self.timeout <= 0:
            raise ValueError("timeout must be > 0")
        if any(r is not None and r <= 0 for r in (self.rate, self.job_rate)):
            raise ValueError("rates must be > 0")
        if self.wait_min < 0 or self.wait_max < self.wait_min:
            raise ValueError("need 0 <= wait_min <= wait_max")


# Tests and oracle runs: no waiting between tries.
NO_WAIT = dict(wait_min=0.0, wait_max=0.0)

ENRICH_FIELDS = [
    TY.StructField("response", TY.StringType()),
    TY.StructField("status", TY.StringType()),
    TY.StructField("reason", TY.StringType()),
    TY.StructField("attempts", TY.IntegerType()),
]


class _Pacer:
    """Minimum spacing between call starts within one task (thread-safe)."""

    def __init__(self, rate: float | None):
        self.gap = 1.0 / rate if rate else 0.0
        self.next = 0.0
        self.lock = threading.Lock()

    def wait(self):
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            start = max(now, self.next)
            self.next = start + self.gap
        if start > now:
            time.sleep(start - now)


class _Slots:
    """The job's rate as a grid of call slots in wall-clock time, ``rate`` a
    second. Slots are dealt by position: of every ``parts`` in a row, partition
    ``part`` owns one, as the round-robin exchange deals it every so-manieth row. A
    call takes the next slot of its own, so no two calls of the job share one,
    whichever tasks run, and early or late. (Executors' clocks are taken to agree.)"""

    def __init__(self, rate: float, part: int, parts: int):
        self.rate, self.part, self.parts = rate, part, parts
        self.last, self.lock = -1, threading.Lock()

    def wait(self):
        with self.lock:
            first = max(math.ceil(time.time() * self.rate), self.last + 1)
            self.last = slot = first + (self.part - first) % self.parts
        time.sleep(max(0.0, slot / self.rate - time.time()))


class _Both:
    """Waits for each of several pacers."""

    def __init__(self, *pacers):
        self.pacers = pacers

    def wait(self):
        for p in self.pacers:
            p.wait()


class DeadlineError(Exception):
    """The call overran the policy's deadline."""


class _Calls:
    """Runs calls under a deadline, all of one task on the same threads. A
    call that overran is never joined: its thread is left to finish on its
    own, and a new pool takes the next calls."""

    def __init__(self, workers: int):
        self.workers, self.pool, self.lock = workers, None, threading.Lock()

    def __call__(self, fn, args, timeout):
        if timeout is None:
            return fn(*args)
        with self.lock:
            pool = self.pool = self.pool or ThreadPoolExecutor(self.workers)
        fut = pool.submit(fn, *args)
        done, _ = wait([fut], timeout)
        if not done:
            with self.lock:
                if self.pool is pool:
                    self.pool = None
            pool.shutdown(wait=False)
            raise DeadlineError(f"no reply within {timeout}s")
        return fut.result()

    def close(self):
        if self.pool:
            self.pool.shutdown(wait=False, cancel_futures=True)


def call_with_policy(fn: Callable, args: tuple, policy: Policy, pacer: _Pacer, rng: random.Random,
                     calls: _Calls) -> tuple[str | None, str, str | None, int]:
    """One row: returns (response, status, reason, attempts). A call that
    overruns the deadline ends the row; whatever the service raises, its own
    time-outs too, is tried again. The last failure gives status and reason."""
    status, reason = STATUS_ERROR, None
    for attempt in range(1, policy.tries + 1):
        pacer.wait()
        try:
            out = calls(fn, args, policy.timeout)
            return (None if out is None else str(out)), STATUS_OK, None, attempt
        except DeadlineError as exc:
            return None, STATUS_TIMEOUT, str(exc), attempt
        except Exception as exc:  # noqa: BLE001 - every failure becomes a row
            status = STATUS_TIMEOUT if isinstance(exc, TimeoutError) else STATUS_ERROR
            reason = f"{type(exc).__name__}: {exc}"
        if attempt < policy.tries and policy.wait_max > 0:
            hi = min(policy.wait_max, policy.wait_min * (2 ** (attempt - 1)))
            time.sleep(rng.uniform(policy.wait_min, max(policy.wait_min, hi)))
    return None, status, reason, policy.tries


def enrich(df: DataFrame, fn: Callable, prompt_col: str = "prompt",
           key_col: str | None = None, policy: Policy = Policy(),
           partitions: int | None = None) -> DataFrame:
    """Call ``fn(prompt)`` (or ``fn(prompt, key)`` when ``key_col`` is set)
    once per row; adds response, status, reason, attempts. ``partitions``
    spreads the calls round-robin over that many tasks first, which is the
    concurrency of the whole job. Calls are independent, so nothing needs
    to share a task: a hot key or a large group of identical rows is spread
    like any other, and Spark's sort before a round-robin exchange gives a
    retried task the same rows."""
    if policy.job_rate and not partitions:
        partitions = df.sparkSession.sparkContext.defaultParallelism
    if partitions:
        df = df.repartition(partitions)
    schema = TY.StructType(list(df.schema.fields) + ENRICH_FIELDS)
    limit = policy.token_limit

    def run(batches):
        pacer = _Pacer(policy.rate)
        if policy.job_rate:
            pacer = _Both(pacer, _Slots(policy.job_rate, TaskContext.get().partitionId(), partitions))
        pool = ThreadPoolExecutor(policy.concurrency) if policy.concurrency > 1 else None
        calls = _Calls(policy.concurrency)

        def one(pk):
            p, k = pk
            if p is None:
                return None, STATUS_PROMPT, "no prompt", 0
            if limit is not None and -(-len(p) // 4) > limit:
                return None, STATUS_PROMPT, f"prompt over {limit} tokens", 0
            return call_with_policy(fn, (p, k) if key_col else (p,), policy, pacer, random.Random(), calls)

        try:
            for pdf in batches:
                prompts = pdf[prompt_col].tolist()
                keys = pdf[key_col].tolist() if key_col else [None] * len(pdf)
                rows = list((pool.map if pool else map)(one, zip(prompts, keys)))  # order kept
                yield pdf.assign(response=[r[0] for r in rows], status=[r[1] for r in rows],
                                 reason=[r[2] for r in rows], attempts=[r[3] for r in rows])
        finally:
            calls.close()
            if pool:
                pool.shutdown(wait=False, cancel_futures=True)

    return df.mapInPandas(run, schema)


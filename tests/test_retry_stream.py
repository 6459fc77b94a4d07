"""The retry queue as stream state: every request once, through stops."""

from pyspark import cloudpickle

import flaky
from dossier.operators import enrich as EN
from dossier.streaming import retry as S

cloudpickle.register_pickle_by_value(flaky)


def service(prompt, attempt):
    """Fails as often as the prompt's last word says, then echoes."""
    if attempt <= int(prompt.split()[-1]):
        raise ConnectionError(f"try {attempt}")
    return f"{prompt}!"


POLICY = EN.Policy(tries=3, wait_min=0.5, wait_max=1.0, timeout=None, token_limit=50)
cloudpickle.register_pickle_by_value(__import__(__name__))


def write(spark, rows, path):
    spark.createDataFrame(rows, S.REQUEST).write.mode("append").parquet(path)


def test_each_request_once_through_stops(spark, tmp_path):
    inp, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    first = [(f"k{i}", f"say {i} {i % 5}") for i in range(40)] + [("none", None), ("long", "x" * 500)]
    write(spark, first, inp)
    slow = EN.Policy(tries=3, wait_min=60, wait_max=60, timeout=None, token_limit=50)
    assert not S.run_retrying(spark, inp, out, ckpt, service, slow, seconds=25)
    done = {r.key: (r.status, r.attempts) for r in S.outcomes(spark, out).collect()}
    assert done == {**{f"k{i}": ("ok", 1) for i in range(0, 40, 5)}, "none": ("prompt", 0), "long": ("prompt", 0)}
    # a second arrival: repeats of known requests, one changed prompt, new keys; the queue waits in the state
    write(spark, [("k0", "say 0 0"), ("k1", "say again 0"), ("new", "say new 2")], inp)
    S.run_retrying(spark, inp, out, ckpt, service, POLICY, seconds=20)
    rows = [(r.key, r.prompt, r.status, r.attempts) for r in S.outcomes(spark, out).collect()]
    assert len(rows) == len(set(rows)) and ("k1", "say again 0", "ok", 1) in rows


def test_retries_until_done(spark, tmp_path):
    inp, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    write(spark, [(f"k{i}", f"say {i} {i % 5}") for i in range(20)], inp)
    assert S.run_retrying(spark, inp, out, ckpt, service, POLICY, seconds=90)
    got = sorted((r.key, r.response, r.status, r.attempts) for r in S.outcomes(spark, out).collect())
    want = sorted((f"k{i}", f"say {i} {i % 5}!" if i % 5 < 3 else None, "ok" if i % 5 < 3 else "error", min(i % 5 + 1, 3))
                  for i in range(20))
    assert got == want


def test_a_state_is_no_exchange_of_its_own(spark, tmp_path):
    """10,000 keys, every one tried twice and asked again while it waits: a request keeps its timer, and
    calls and outcomes are one each, within a minute."""
    import time
    inp, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rows = [(f"k{i}", f"say {i} 1") for i in range(10_000)]
    write(spark, rows, inp)
    wait = EN.Policy(tries=3, wait_min=20, wait_max=20, timeout=None)
    assert not S.run_retrying(spark, inp, out, ckpt, service, wait, seconds=12)
    write(spark, rows, inp)
    start = time.monotonic()
    assert S.run_retrying(spark, inp, out, ckpt, service, wait, seconds=120)
    assert time.monotonic() - start < 60
    got = [(r.key, r.response, r.attempts) for r in S.outcomes(spark, out).collect()]
    assert sorted(got) == sorted((k, f"{p}!", 2) for k, p in rows)

"""What a driver with little heap does at a time."""

import threading
import time

import pytest

from sparkmart import session


@pytest.mark.parametrize(("heap", "together"), [(1 << 60, 1), (1 << 28, 3)])
def test_small_drivers_run_fewer_jobs_at_a_time(spark, monkeypatch, heap, together):
    monkeypatch.setattr(session, "JOB_HEAP", heap)
    running, most, lock = 0, 0, threading.Lock()

    def job(i):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        time.sleep(0.2)
        with lock:
            running -= 1
        return i

    assert session.in_parallel([lambda i=i: job(i) for i in range(3)]) == [0, 1, 2]
    assert most == together


def test_nested_jobs_of_a_small_driver_end(spark, monkeypatch):
    monkeypatch.setattr(session, "JOB_HEAP", 1 << 60)
    inner = lambda: session.in_parallel([lambda: 1, lambda: 2])
    assert session.in_parallel([inner, inner]) == [[1, 2], [1, 2]]


def test_stored_tables_keep_rows_and_parts_when_garbage_is_collected(spark, monkeypatch):
    monkeypatch.setattr(session, "SMALL_HEAP", 1 << 60)
    monkeypatch.setattr(session, "TAKEN", 0.0)
    folder = session.scratch_folder(spark, "stored")
    session.store(spark.range(10).selectExpr("id", "id % 2 AS part"), folder, "part")
    assert spark.read.parquet(folder).where("part = 1").count() == 5

import threading

import pytest

from strata.sources.incremental import load_date_window
from strata.sources.ledger import LedgerConflict, RunLedger


def test_marks_survive_and_are_compared(spark, scratch):
    path = scratch("ledger")
    marks = RunLedger(spark, path).marks()
    assert marks.get("orders", "none") == "none"
    marks.set("orders", "a")
    other = RunLedger(spark, path).marks()
    assert other.get("orders", "none") == "a" and other.get("events", "x") == "x"
    marks.set("orders", "b")
    with pytest.raises(LedgerConflict):
        other.set("orders", "c")
    other.set("events", "e")  # another source's mark is no conflict
    number, state = RunLedger(spark, path).last()
    assert (number, state.marks) == (3, {"orders": "b", "events": "e"})
    assert RunLedger(spark, path).at(1).marks == {"orders": "a"}


def test_of_concurrent_sets_one_wins(spark, scratch):
    path = scratch("ledger")
    RunLedger(spark, path).marks().set("s", "0")
    won, lost = [], []
    ready = threading.Barrier(6)

    def contend(i):
        marks = RunLedger(spark, path).marks()
        assert marks.get("s", "") == "0"
        ready.wait()
        try:
            marks.set("s", f"by {i}")
            won.append(i)
        except LedgerConflict:
            lost.append(i)

    threads = [threading.Thread(target=contend, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 5
    assert RunLedger(spark, path).last()[1].marks == {"s": f"by {won[0]}"}


def test_commits_that_do_not_clash_all_get_in(spark, scratch):
    path = scratch("ledger")
    threads = [threading.Thread(target=lambda i=i: RunLedger(spark, path).marks().set(f"s{i}", str(i))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    number, state = RunLedger(spark, path).last()
    assert number == 8 and state.marks == {f"s{i}": str(i) for i in range(8)}


def test_a_run_resumes_at_the_step_that_failed(spark, scratch):
    path, did = scratch("ledger"), []

    def work(name, fails=False):
        def do():
            did.append(name)
            if fails:
                raise OSError("lost")
            return {"rows": len(did)}

        return do

    run = RunLedger(spark, path).run("day-1")
    assert run.step("a", work("a"), lambda s, r: s.marks.update(src=str(r["rows"]))) == {"rows": 1}
    with pytest.raises(OSError):
        run.step("b", work("b", fails=True), lambda s, r: s.marks.update(src="never"))
    again = RunLedger(spark, path).run("day-1")
    assert again.step("a", work("a")) == {"rows": 1}  # not run again
    assert RunLedger(spark, path).last()[1].marks == {"src": "1"}
    again.step("b", work("b"))
    again.finish()
    assert did == ["a", "b", "b"] and again.done() == {}
    again.step("a", work("a"))
    assert did[-1] == "a"


def test_two_processes_of_one_run(spark, scratch):
    path = scratch("ledger")
    first, second = (RunLedger(spark, path).run("r") for _ in range(2))
    with pytest.raises(LedgerConflict, match="another process"):
        first.step("a", lambda: second.step("a", lambda: 1))


def test_window_load_over_ledger_marks(spark, scratch):
    marks = RunLedger(spark, scratch("ledger")).marks()
    df = spark.createDataFrame([("2026-06-01", 1), ("2026-06-09", 2)], "d string, x int")
    landed = []
    args = (df, "d", marks, "s", "2026-06-01")
    load_date_window(*args, "2026-06-05", landed.append)
    assert marks.get("s", "") == "2026-06-04"

    def fail(rows):
        raise OSError("store is down")

    with pytest.raises(OSError):
        load_date_window(*args, "2026-06-12", fail)
    assert marks.get("s", "") == "2026-06-04"

"""Feeds, the versioned dimension store, fact/error sinks and multi-day replays."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows

from dimflow import schemas as S
from dimflow.params import RunParams
from dimflow.plans import Targets, inputs_from_store, plan, publish
from dimflow.sinks import read_error_log, read_fact, write_error_log, write_fact
from dimflow.sources import DimensionStore, feed_path, read_customer_delta, read_sales_txn
from dimflow.sources import fixtures as fx

D = dt.date

# One row per rule: a customer sent twice, one without an id, one without sales; two sales of one fact group, a
# missing store, zero and negative measures, missing ids, dates and amounts, a customer nobody knows.
CUSTOMERS = """CUST_ID,CUST_NAME,ADDRESS,CITY,STATE,ZIP,SEGMENT,SOURCE_SYSTEM,EFF_DATE
Q7,Harbour Tiles,Dock 4,Lindholm,NV,00501,RETAIL,WEBFORM,2026-05-02
Q2,Mistral Sails,NULL,Aberg,ME,04401,RETAIL,NULL,2026-06-30
Q9,Tern Optics,8 Glass Yard,Norrland,VT,05001,LAB,WEBFORM,2026-02-11
Q9,Tern Optics AB,9 Glass Yard,Norrland,VT,05001,LAB,WEBFORM,2026-06-11
NULL,Nameless,1 Void,Nowhere,NV,00000,LAB,WEBFORM,2026-06-01
Q4,Quiet Quarry,Pit 1,Stenby,ME,04500,BULK,IMPORT,2026-01-15
"""

SALES = """TXN_ID,CUST_ID,PRODUCT_ID,STORE_ID,CHANNEL,TXN_DATE,QTY,UNIT_PRICE,AMOUNT
S01,Q7,GLAZE,N1,FAIR,2026-07-01,2,10.00,20.00
S02,Q7,GLAZE,N1,FAIR,2026-07-01,3,11.00,33.00
S03,Q7,GLAZE,NULL,FAIR,2026-07-01,1,10.00,10.00
S04,Q2,ROPE,N2,POST,2026-07-02,4,2.50,10.00
S05,Q9,LENS,N1,POST,2026-07-03,1,99.00,99.00
S06,Q2,ROPE,N2,POST,2026-07-02,0,2.50,10.00
S07,Q2,ROPE,N2,POST,2026-07-02,1,2.50,0.00
S08,Q7,GLAZE,N1,FAIR,2026-07-01,1,10.00,-10.00
S09,NULL,ROPE,N2,POST,2026-07-02,1,2.50,2.50
S10,Q5,ROPE,N2,POST,2026-07-02,1,2.50,2.50
S11,Q7,GLAZE,N1,FAIR,NULL,1,10.00,10.00
S12,Q2,ROPE,N2,POST,2026-07-02,1,2.50,NULL
"""

RUN = D(2026, 7, 28)
P = RunParams(run_date=RUN, run_ts="2026-07-28 00:00:00")


def _write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def _stage(root: str, run: dt.date, customers: str = CUSTOMERS, sales_text: str = SALES) -> str:
    src = os.path.join(root, "src")
    _write(feed_path(src, "customer_delta", run), customers)
    _write(feed_path(src, "sales_txn", run), sales_text)
    return src


def _targets(root: str) -> Targets:
    return Targets(dimension_root=os.path.join(root, "dim"), fact_path=os.path.join(root, "fact"),
                   error_dir=os.path.join(root, "err"))


def _run_day(spark, root: str, src: str, params: RunParams):
    store = DimensionStore(os.path.join(root, "dim"))
    inputs = inputs_from_store(read_customer_delta(spark, src, params.run_date),
                               read_sales_txn(spark, src, params.run_date), store, params)
    outputs = plan(inputs, params)
    counts = publish(outputs, _targets(root), params)
    return store, outputs, counts


# ---- feeds ---------------------------------------------------------------------------------------

def test_feed_scan_types_and_nulls(spark, workdir):
    src = _stage(workdir, RUN)
    cust = read_customer_delta(spark, src, RUN)
    assert cust.schema == S.CUSTOMER_DELTA
    got = {r.CUST_ID: r for r in cust.collect()}
    assert got["Q2"].ADDRESS is None and got["Q2"].SOURCE_SYSTEM is None
    assert got["Q7"].ZIP == "00501"  # leading zeros kept
    sales = read_sales_txn(spark, src, RUN)
    assert sales.schema == S.SALES_TXN
    got = {r.TXN_ID: r for r in sales.collect()}
    assert got["S03"].STORE_ID is None and got["S08"].AMOUNT == Decimal("-10.00")
    assert got["S09"].CUST_ID is None and got["S11"].TXN_DATE is None and got["S12"].AMOUNT is None


def test_feed_permissive_parsing(spark, workdir):
    text = ("TXN_ID,CUST_ID,PRODUCT_ID,STORE_ID,CHANNEL,TXN_DATE,QTY,UNIT_PRICE,AMOUNT\n"
            'a,,P,"",W,2026-13-45,x,1.005,2\n'
            "b,K\n")
    path = feed_path(os.path.join(workdir, "src"), "sales_txn", RUN)
    _write(path, text)
    got = {r.TXN_ID: r for r in read_sales_txn(spark, os.path.join(workdir, "src"), RUN).collect()}
    a = got["a"]
    assert a.CUST_ID is None          # empty unquoted field -> NULL
    assert a.STORE_ID == ""           # quoted empty string stays ''
    assert a.TXN_DATE is None and a.QTY is None
    assert a.UNIT_PRICE == Decimal("1.01")  # excess scale rounded HALF_UP
    assert got["b"].PRODUCT_ID is None and got["b"].AMOUNT is None  # short row


def test_multi_date_scan(spark, workdir):
    src = _stage(workdir, RUN)
    _stage(workdir, D(2026, 7, 29))
    assert read_sales_txn(spark, src, [RUN, D(2026, 7, 29)]).count() == 24


# ---- golden run ----------------------------------------------------------------------------------

REJECTS = [("S06", "Q2", "NON_POSITIVE_QTY"), ("S07", "Q2", "NON_POSITIVE_AMOUNT"), ("S08", "Q7", "NON_POSITIVE_AMOUNT"),
           ("S09", None, S.CUSTOMER_NOT_FOUND), ("S10", "Q5", S.CUSTOMER_NOT_FOUND), ("S11", "Q7", "MISSING_TXN_DATE")]


def test_first_run_on_empty_target(spark, workdir):
    src = _stage(workdir, RUN)
    store, out, counts = _run_day(spark, workdir, src, P)
    assert out.key_base == 1
    # the row without an id is dropped, the customer sent twice gets two versions
    assert rows(out.changes, "CUST_ID", "CHANGE_CODE") == [("Q2", 1), ("Q4", 1), ("Q7", 1), ("Q9", 1), ("Q9", 1)]
    dim = store.read_all(spark)
    assert rows(dim, "CUST_KEY", "CUST_ID", "CUST_NAME", "CURR_FLAG") == [
        (1, "Q2", "Mistral Sails", "Y"), (2, "Q4", "Quiet Quarry", "Y"), (3, "Q7", "Harbour Tiles", "Y"),
        (4, "Q9", "Tern Optics", "Y"), (5, "Q9", "Tern Optics AB", "Y")]
    fact = read_fact(spark, _targets(workdir).fact_path, RUN)
    assert rows(fact) == [
        (1, "ROPE", "N2", D(2026, 7, 2), 4, Decimal("10.00"), 1, Decimal("2.50")),
        (3, "GLAZE", "N1", D(2026, 7, 1), 5, Decimal("53.00"), 2, Decimal("10.50")),
        (3, "GLAZE", None, D(2026, 7, 1), 1, Decimal("10.00"), 1, Decimal("10.00")),
        (4, "LENS", "N1", D(2026, 7, 3), 1, Decimal("99.00"), 1, Decimal("99.00")),
        (5, "LENS", "N1", D(2026, 7, 3), 1, Decimal("99.00"), 1, Decimal("99.00"))]
    errors = read_error_log(spark, _targets(workdir).error_dir, RUN)
    assert rows(errors, "TXN_ID", "CUST_ID", "ERROR_REASON") == REJECTS
    assert rows(out.dq_unclassified, "TXN_ID") == [("S12",)]  # neither passed nor rejected
    assert counts == {"dim_current": 5, "dim_closed": 0, "fact": 5, "errors": 6}


def test_pre_load_snapshot_rejects_everything_on_first_run(spark, workdir):
    src = _stage(workdir, RUN)
    _, out, counts = _run_day(spark, workdir, src, P.with_(snapshot="pre_load"))
    assert out.fact.count() == 0 and counts["fact"] == 0
    assert rows(out.errors, "ERROR_REASON") == [(S.CUSTOMER_NOT_FOUND,)] * 12
    assert read_fact(spark, _targets(workdir).fact_path).count() == 0  # an empty first fact reads as empty


def test_two_day_replay_and_rerun(spark, workdir):
    p1 = P.with_(dedupe_feed=True)
    _run_day(spark, workdir, _stage(workdir, RUN), p1)
    day2 = D(2026, 8, 1)
    customers2 = CUSTOMERS.replace("Dock 4", "Dock 5") \
        + "Q8,Umber Press,3 Ink Ln,Stenby,ME,04500,BULK,IMPORT,2026-07-30\n"
    src2 = _stage(workdir, day2, customers2)
    p2 = p1.with_(run_date=day2)
    store, out, counts = _run_day(spark, workdir, src2, p2)
    assert out.key_base == 5
    # Day 2 planned from day 1's marker: the current dimension's size was recorded, not scanned.
    base = store.base_version(spark, day2)
    assert base == RUN.isoformat()
    assert store.current_size(spark, base).rows == 4
    assert rows(out.changes, "CUST_ID", "CHANGE_CODE") == [("Q7", 3), ("Q8", 1)]
    dim = rows(store.read_all(spark))
    assert [(r[0], r[1], r[10], r[8], r[9]) for r in dim] == [
        (1, "Q2", "Y", RUN, D(9999, 12, 31)),
        (2, "Q4", "Y", RUN, D(9999, 12, 31)),
        (3, "Q7", "N", RUN, D(2026, 7, 31)),
        (4, "Q9", "Y", RUN, D(9999, 12, 31)),
        (5, "Q7", "Y", day2, D(9999, 12, 31)),
        (6, "Q8", "Y", day2, D(9999, 12, 31)),
    ]
    # Only the two new versions and the closed one were written on day 2.
    marker = store.markers(spark)[day2.isoformat()]
    assert len(marker["parts"]) == 2 and len(marker["minus"]) == 1
    assert spark.read.parquet(store.current_path(day2.isoformat(), marker["attempt"])).count() == 2
    assert counts["dim_current"] == 5 and counts["dim_closed"] == 1
    # Re-running day 2 builds on day 1 again and gives the same dimension.
    store, out, _ = _run_day(spark, workdir, src2, p2)
    assert rows(store.read_all(spark)) == dim
    # Same feed once more on a later day: nothing changes, and no rows of the dimension are written.
    day3 = D(2026, 8, 2)
    store, out3, _ = _run_day(spark, workdir, _stage(workdir, day3, customers2), p1.with_(run_date=day3))
    assert out3.changes.count() == 0 and rows(store.read_all(spark)) == dim
    marker = store.markers(spark)[day3.isoformat()]
    assert not os.path.exists(store.current_path(day3.isoformat(), marker["attempt"]))
    assert not os.path.exists(store.closed_path(day3.isoformat(), marker["attempt"]))
    # Running an older date after a newer one is refused.
    with pytest.raises(ValueError):
        store.base_version(spark, D(2026, 7, 30))


def test_compaction_writes_a_whole_set_again(spark, workdir):
    params = P.with_(dedupe_feed=True, compact_every=1)
    expected = None
    for i, street in enumerate(("Dock 4", "Dock 5", "Dock 6", "Dock 7")):
        day = D(2026, 8, 1 + i)
        src = _stage(workdir, day, CUSTOMERS.replace("Dock 4", street))
        store, out, counts = _run_day(spark, workdir, src, params.with_(run_date=day))
        marker = store.markers(spark)[day.isoformat()]
        assert len(marker["parts"]) == (1, 2, 1, 2)[i] and counts["dim_current"] == 4
        current = rows(store.read_current(spark, day.isoformat()), "CUST_ID", "ADDRESS")
        assert current == [("Q2", None), ("Q4", "Pit 1"), ("Q7", street), ("Q9", "9 Glass Yard")]
        assert store.read_all(spark).count() == 4 + i
        expected = expected or current


def test_a_run_that_fails_before_the_marker_leaves_nothing(spark, workdir, monkeypatch):
    """The fact is not readable before the commit, and the retry does not double it."""
    src = _stage(workdir, RUN)
    from dimflow.plans import daily_run

    def broken(*args):
        raise RuntimeError("lost")
    monkeypatch.setattr(daily_run.writers, "commit_dimension_version", broken)
    with pytest.raises(RuntimeError, match="lost"):
        _run_day(spark, workdir, src, P)
    monkeypatch.undo()
    fact_path = _targets(workdir).fact_path
    assert read_fact(spark, fact_path).count() == 0
    store, _, counts = _run_day(spark, workdir, src, P)
    assert counts["fact"] == 5 and read_fact(spark, fact_path).count() == 5
    assert store.read_all(spark).count() == 5


def test_command_line_run(spark, workdir):
    from dimflow.__main__ import main

    src = _stage(workdir, RUN)
    args = ["--run-date", "2026-07-28", "--src-dir", src, "--err-dir", os.path.join(workdir, "err"),
            "--dim-root", os.path.join(workdir, "dim"), "--fact-path", os.path.join(workdir, "fact"), "--dedupe-feed"]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        with pytest.raises(SystemExit, match="first-load"):
            main(args)  # a mistyped folder is no silent first load
        counts = main([*args, "--first-load"])
        assert counts["fact"] == 4 and counts["dim_current"] == 4 and counts["errors"] == 6
        _stage(workdir, D(2026, 7, 29))  # the same feeds again, filed under the next date
        assert main(args[:1] + ["2026-07-29"] + args[2:])["changes"] == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_corrupt_marker_is_no_first_load(spark, workdir):
    store = DimensionStore(os.path.join(workdir, "dim"))
    _write(os.path.join(store.versions_dir, "v=2026-07-28", "a=x", "part-0.parquet"), "not parquet")
    with pytest.raises(Exception):
        store.markers(spark)


# ---- sinks ---------------------------------------------------------------------------------------

def test_fact_append_vs_replace_run(spark, workdir):
    fact = spark.createDataFrame(
        [(1, "P", "S", RUN, 2, Decimal("3.00"), 1, Decimal("1.50"))], S.SALES_FACT)
    path = os.path.join(workdir, "fact")
    write_fact(fact, path, RUN)
    write_fact(fact, path, RUN)
    assert read_fact(spark, path, RUN).count() == 2          # append, like the original
    path2 = os.path.join(workdir, "fact2")
    write_fact(fact, path2, RUN, mode="replace_run")
    write_fact(fact, path2, RUN, mode="replace_run")
    write_fact(fact, path2, D(2026, 7, 29), mode="replace_run")
    assert read_fact(spark, path2, RUN).count() == 1          # idempotent per run date
    assert read_fact(spark, path2).count() == 2


def test_error_log_round_trip(spark, workdir):
    errors = spark.createDataFrame(
        [("t1", None, "R", dt.datetime(2026, 7, 28, 1, 2, 3), RUN)], S.ERROR_LOG)
    assert write_error_log(errors, workdir, RUN) == 1
    assert os.path.isdir(os.path.join(workdir, "sales_errors_2026-07-28.dat"))
    assert rows(read_error_log(spark, workdir, RUN)) == rows(errors)


def test_rerun_adds_a_marker_and_a_dead_attempt_is_never_read(spark, workdir):
    src = _stage(workdir, RUN)
    store, _, _ = _run_day(spark, workdir, src, P)
    first = store.commits(spark)[RUN.isoformat()]
    before = rows(store.read_all(spark))
    store, _, _ = _run_day(spark, workdir, src, P)             # a successful re-run of the date
    second = store.commits(spark)[RUN.isoformat()]
    assert second != first
    assert sorted(os.listdir(os.path.join(store.versions_dir, f"v={RUN.isoformat()}"))) == sorted(
        [f"a={first}", f"a={second}"])                          # the earlier commit is still there
    # A re-run that dies after writing its data but before its marker changes nothing.
    dead = "a" + "0" * 16
    store.read_current(spark, RUN.isoformat()).write.parquet(store.current_path(RUN.isoformat(), dead))
    assert store.commits(spark)[RUN.isoformat()] == second
    assert rows(store.read_all(spark)) == before


@pytest.mark.parametrize("cap", [0, 2_000_000])
def test_empty_day_publishes_empty_outputs(spark, workdir, cap):
    src = _stage(workdir, RUN)
    _run_day(spark, workdir, src, P)
    day2 = D(2026, 7, 29)
    header_c, header_s = CUSTOMERS.splitlines()[0] + "\n", SALES.splitlines()[0] + "\n"
    src2 = _stage(workdir, day2, header_c, header_s)
    store, out, counts = _run_day(spark, workdir, src2, P.with_(run_date=day2, broadcast_max_rows=cap))
    assert counts == {"dim_current": 5, "dim_closed": 0, "fact": 0, "errors": 0}
    assert out.changes.count() == 0 and out.next_key == out.key_base == 6
    assert store.committed_versions(spark) == [RUN.isoformat(), day2.isoformat()]
    assert read_error_log(spark, _targets(workdir).error_dir, day2).count() == 0


def test_prepared_inputs_are_the_adapters(spark, workdir):
    """Written inputs give the rows that the adapters make."""
    folder = fx.prepare(spark, SF_SMALL, f"{workdir}/inputs")
    for make in (fx.customer_delta, fx.sales_txn, fx.dimension, fx.dim_current, fx.next_day_delta):
        assert rows(make(spark, folder)) == rows(make(spark, SF_SMALL))
    assert all("inputs" in f for f in fx.sales_txn(spark, folder).inputFiles())

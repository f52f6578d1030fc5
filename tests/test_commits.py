"""Runs that fail late, run twice or run at once: store, error log, catalog tables and relational tables."""

from __future__ import annotations

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest
from conftest import rows
from test_sources_sinks import CUSTOMERS, P, RUN, SALES, _run_day, _stage, _targets

from dimflow import schemas as S
from dimflow.plans import Targets, audit, inputs_from_store, plan, publish, publish_audited
from dimflow.plans import daily_run
from dimflow.plans.daily_run import (
    JdbcTables,
    TaggedSales,
    inputs_from_catalog,
    inputs_from_jdbc,
    publish_catalog,
    publish_jdbc,
)
from dimflow.session import claim, claims, scratch_path
from dimflow.sinks import read_error_log, read_fact, write_error_log
from dimflow.sinks.writers import CommitConflict
from dimflow.sources import CatalogMart, DimensionStore, JdbcTarget, read_customer_delta, read_sales_txn
from dimflow.sources.jdbc import create_statements, load_statements, run_checked, staging

D = dt.date
DAY2 = D(2026, 7, 29)


def _planned(spark, root, src, params):
    store = DimensionStore(os.path.join(root, "dim"))
    feeds = read_customer_delta(spark, src, params.run_date), read_sales_txn(spark, src, params.run_date)
    return store, plan(inputs_from_store(*feeds, store, params), params)


# ---- one number, one run ---------------------------------------------------------------------------

def test_a_number_is_taken_once(spark, workdir):
    folder = os.path.join(workdir, "numbers")
    assert claims(spark, folder) == {}
    assert claim(spark, folder, 1, "a") and not claim(spark, folder, 1, "b") and claim(spark, folder, 2, "b")
    assert claims(spark, folder) == {"a": 1, "b": 2}
    assert not [f for f in os.listdir(folder) if f.startswith(".a-") or f.startswith(".b-")]


@pytest.mark.parametrize("other_day", [RUN, DAY2])
def test_of_two_runs_that_read_the_same_state_one_commits(spark, workdir, other_day):
    """Of one date or of two: the loser's keys, fact and errors are never read, and it can run again."""
    src = _stage(workdir, RUN)
    _stage(workdir, other_day)
    store, first = _planned(spark, workdir, src, P)
    later = P.with_(run_date=other_day)
    _, second = _planned(spark, workdir, src, later)
    assert first.key_base == second.key_base == 1 and first.seen == second.seen == 0
    publish(first, _targets(workdir), P)
    before = rows(store.read_all(spark))
    with pytest.raises(CommitConflict):
        publish(second, _targets(workdir), later)
    assert rows(store.read_all(spark)) == before
    assert store.committed_versions(spark) == [RUN.isoformat()]
    assert read_fact(spark, _targets(workdir).fact_path).count() == 5
    assert read_error_log(spark, _targets(workdir).error_dir, RUN).count() == 6
    if other_day != RUN:
        assert read_error_log(spark, _targets(workdir).error_dir, other_day).count() == 0
        _, again, counts = _run_day(spark, workdir, src, later)
        assert again.key_base == 6 and counts["fact"] == 5
        keys = [r[0] for r in rows(store.read_all(spark), S.CUSTOMER_KEY)]
        assert len(keys) == len(set(keys))


def test_of_two_runs_at_the_same_time_one_commits(spark, workdir):
    src = _stage(workdir, RUN)
    store, first = _planned(spark, workdir, src, P)
    _, second = _planned(spark, workdir, src, P)

    def attempt(outputs):
        try:
            return publish(outputs, _targets(workdir), P)
        except CommitConflict as e:
            return e
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(attempt, (first, second)))
    assert sorted(isinstance(r, CommitConflict) for r in results) == [False, True]
    assert read_fact(spark, _targets(workdir).fact_path).count() == 5 and store.read_all(spark).count() == 5


# ---- error log -------------------------------------------------------------------------------------

def test_a_late_failure_leaves_the_earlier_error_log(spark, workdir, monkeypatch):
    src = _stage(workdir, RUN)
    _run_day(spark, workdir, src, P)
    err_dir = _targets(workdir).error_dir
    earlier = rows(read_error_log(spark, err_dir, RUN))
    assert len(earlier) == 6
    _stage(workdir, RUN, sales_text=SALES.replace("S05,Q9", "S05,Q404"))  # one reject more
    for step in ("commit_dimension_version", "commit_fact", "commit_error_log"):
        def broken(*args):
            raise RuntimeError("lost")
        monkeypatch.setattr(daily_run.writers, step, broken)
        with pytest.raises(RuntimeError, match="lost"):
            _run_day(spark, workdir, src, P)
        monkeypatch.undo()
        assert rows(read_error_log(spark, err_dir, RUN)) == earlier
    _run_day(spark, workdir, src, P)
    assert read_error_log(spark, err_dir, RUN).count() == 7


def test_a_new_error_log_takes_the_place_of_the_old(spark, workdir):
    errors = spark.createDataFrame([("t1", None, "R", dt.datetime(2026, 7, 28, 1, 2, 3), RUN)], S.ERROR_LOG)
    write_error_log(errors, workdir, RUN)
    write_error_log(errors.union(errors), workdir, RUN)
    assert read_error_log(spark, workdir, RUN).count() == 2
    path = os.path.join(workdir, "sales_errors_2026-07-28.dat")
    assert len([f for f in os.listdir(path) if f.startswith("attempt=")]) == 1
    write_error_log(errors.where("false"), workdir, RUN)
    assert read_error_log(spark, workdir, RUN).count() == 0
    assert read_error_log(spark, workdir, DAY2).count() == 0


# ---- audit from observed counts --------------------------------------------------------------------

@pytest.mark.parametrize("strategy", ["broadcast", "reduced", "salted"])
def test_observed_audit_equals_the_counted_one(spark, workdir, strategy):
    """Customers with several current rows included: a sales row counts once however many it meets."""
    bounds = {"broadcast": {}, "reduced": {"broadcast_max_rows": 5}, "salted": {"broadcast_max_rows": 0}}[strategy]
    params = P.with_(**bounds)
    customers = CUSTOMERS + "".join(f"X{i},Extra,1 Road,Aberg,ME,04401,RETAIL,NULL,2026-06-30\n" for i in range(6))
    sales = SALES + "".join(f"S2{i},Q9,LENS,N1,POST,2026-07-03,1,9.00,{i}.00\n" for i in range(5))
    src = _stage(workdir, RUN, customers, sales)
    feeds = read_customer_delta(spark, src, RUN), read_sales_txn(spark, src, RUN)
    inputs = inputs_from_store(*feeds, DimensionStore(os.path.join(workdir, "dim")), params)
    outputs = plan(inputs, params)
    assert outputs.lookup_plan.strategy == strategy
    counts, observed = publish_audited(outputs, _targets(workdir), params)
    assert rows(observed) == rows(audit(inputs, outputs))
    assert {r[0]: r[1] for r in observed.collect()}["sales_txn"] == 17


def test_audit_after_publish_reads_no_sales(spark, workdir, monkeypatch):
    src = _stage(workdir, RUN)
    _, outputs = _planned(spark, workdir, src, P)
    written = TaggedSales.write(outputs)
    os.rename(os.path.join(src, f"sales_txn_{RUN.isoformat()}.dat"), os.path.join(src, "gone.dat"))
    got = {r[0]: r[1] for r in written.audit(outputs, 5, 6).collect()}
    assert (got["sales_txn"], got["lookup_rejects"], got["dq_pass"], got["dimension_after"]) == (12, 2, 6, 5)


# ---- catalog ---------------------------------------------------------------------------------------

def test_catalog_first_load_rerun_and_next_day(spark, workdir):
    folder = scratch_path(spark, "catalog")
    mart = CatalogMart("dimflow_t" + folder.rsplit("-", 1)[1], folder)

    def run(params, *texts):
        src = _stage(workdir, params.run_date, *texts)
        feeds = read_customer_delta(spark, src, params.run_date), read_sales_txn(spark, src, params.run_date)
        return publish_catalog(plan(inputs_from_catalog(*feeds, mart, params), params), mart, params)

    p1 = P.with_(dedupe_feed=True)
    counts = run(p1)
    assert counts["dim_new"] == 4 and counts["dim_closed"] == 0 and counts["dq_pass"] + counts["dq_rejects"] > 0
    first = rows(spark.table(mart.dimension))
    facts, errors = rows(spark.table(mart.fact)), rows(spark.table(mart.errors))
    assert len(first) == 4 and len(facts) == 4 and len(errors) == 6
    run(p1)  # again: the date's rows are put in the place of its earlier ones
    assert rows(spark.table(mart.dimension)) == first and rows(spark.table(mart.fact)) == facts
    p2 = p1.with_(run_date=DAY2)
    run(p2, CUSTOMERS.replace("Dock 4", "Dock 5"))
    after = rows(spark.table(mart.dimension), "CUST_KEY", "CUST_ID", "ADDRESS", "EXP_DATE", "CURR_FLAG")
    assert after == [(1, "Q2", None, D(9999, 12, 31), "Y"), (2, "Q4", "Pit 1", D(9999, 12, 31), "Y"),
                     (3, "Q7", "Dock 4", RUN, "N"), (4, "Q9", "9 Glass Yard", D(9999, 12, 31), "Y"),
                     (5, "Q7", "Dock 5", D(9999, 12, 31), "Y")]
    assert spark.table(mart.dimension_rows).count() == 6  # only what the day changed was added
    run(p2, CUSTOMERS.replace("Dock 4", "Dock 5"))
    assert rows(spark.table(mart.dimension), "CUST_KEY", "CUST_ID", "ADDRESS", "EXP_DATE", "CURR_FLAG") == after
    with pytest.raises(ValueError, match="in order"):
        run(p1)
    assert spark.table(mart.fact).where("RUN_DATE = DATE'2026-07-29'").count() == 4


# ---- relational ------------------------------------------------------------------------------------

class FakeMart:
    """Stands for the database: frames written and statements run end up in tables of this process."""

    def __init__(self, monkeypatch):
        self.con = duckdb.connect()
        self.appended = []
        for sql in create_statements(*NAMES):
            self.con.execute(sql)
        monkeypatch.setattr(JdbcTarget, "read", self.read)
        monkeypatch.setattr(JdbcTarget, "append", self.append)
        monkeypatch.setattr(JdbcTarget, "apply", self.apply)

    def read(self, spark, options):
        found = self.con.execute(options.get("query") or f"SELECT * FROM {options['dbtable']}")
        names, data = [d[0] for d in found.description], found.fetchall()
        if names == S.names(S.CUSTOMER_DIM):
            return spark.createDataFrame(data, S.CUSTOMER_DIM)
        return spark.createDataFrame(data, ", ".join(f"{n} string" if n == "RUN_DATE" else f"{n} long" for n in names))

    def append(self, df, table):
        self.appended.append(table)
        names = ", ".join(f'"{c}"' for c in df.columns)
        self.con.executemany(f"INSERT INTO {table} ({names}) VALUES ({', '.join('?' * len(df.columns))})",
                             [list(r) for r in df.collect()])

    def apply(self, spark, statements):
        self.con.begin()
        try:
            run_checked(lambda sql: self.con.execute(sql).fetchone()[0], statements)
            self.con.commit()
        except BaseException:
            self.con.rollback()
            raise

    def all(self, table):
        return sorted(self.con.execute(f"SELECT * FROM {table}").fetchall(), key=str)


NAMES = ('"CUSTOMER_DIM"', '"SALES_FACT"', '"LOAD_COMMIT"')
STAGING = [staging(NAMES[0]), staging(NAMES[0], "EXPIRE"), staging(NAMES[1])]


@pytest.fixture()
def mart(monkeypatch):
    return FakeMart(monkeypatch)


def _tables():
    return JdbcTables(JdbcTarget("jdbc:x", "u", "p"), *NAMES, partitions=4)


def _jdbc_plan(spark, src, params):
    feeds = read_customer_delta(spark, src, params.run_date), read_sales_txn(spark, src, params.run_date)
    return plan(inputs_from_jdbc(*feeds, _tables()), params)


def test_relational_runs(spark, workdir, mart):
    """First load, the same run twice, the next day on top: each row once, keys carried on from the database."""
    src = _stage(workdir, RUN)
    p1, err = P.with_(dedupe_feed=True), os.path.join(workdir, "err")
    counts = publish_jdbc(_jdbc_plan(spark, src, p1), _tables(), err, p1)
    assert counts == {"dim_new": 4, "dim_expire": 0, "fact": 4, "errors": 6, "next_key": 5}
    dim, fact = mart.all(NAMES[0]), mart.all(NAMES[1])
    assert [r[:2] for r in dim] == [(1, "Q2"), (2, "Q4"), (3, "Q7"), (4, "Q9")] and len(fact) == 4
    assert publish_jdbc(_jdbc_plan(spark, src, p1), _tables(), err, p1) == {"already_loaded": 1}
    assert mart.all(NAMES[0]) == dim and mart.all(NAMES[1]) == fact
    p2 = p1.with_(run_date=DAY2)
    src = _stage(workdir, DAY2, CUSTOMERS.replace("Dock 4", "Dock 5"))
    outputs = _jdbc_plan(spark, src, p2)
    assert outputs.key_base == 5
    publish_jdbc(outputs, _tables(), err, p2)
    assert [(r[0], r[1], r[9], r[10]) for r in mart.all(NAMES[0]) if r[1] == "Q7"] == [
        (3, "Q7", RUN, "N"), (5, "Q7", D(9999, 12, 31), "Y")]
    assert all(mart.all(t) == [] for t in STAGING)
    assert [r[0] for r in mart.all(NAMES[2])] == ["2026-07-28", "2026-07-29"]


def test_relational_run_that_fails_is_run_again(spark, workdir, mart, monkeypatch):
    """Staged rows of a dead attempt, rows staged twice by a repeated task, a failing transaction: no second copy."""
    src = _stage(workdir, RUN)
    p1, err = P.with_(dedupe_feed=True), os.path.join(workdir, "err")
    monkeypatch.setattr(JdbcTarget, "apply", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        publish_jdbc(_jdbc_plan(spark, src, p1), _tables(), err, p1)
    assert mart.all(NAMES[0]) == [] and mart.all(STAGING[0]) and read_error_log(spark, err, RUN).count() == 0
    monkeypatch.setattr(JdbcTarget, "apply", mart.apply)
    monkeypatch.setattr(JdbcTarget, "append", lambda self, df, table: mart.append(df.union(df), table))
    publish_jdbc(_jdbc_plan(spark, src, p1), _tables(), err, p1)
    assert len(mart.all(NAMES[0])) == 4 and len(mart.all(NAMES[1])) == 4
    assert read_error_log(spark, err, RUN).count() == 6


def test_relational_runs_at_once_do_not_share_keys(spark, workdir, mart):
    src = _stage(workdir, RUN)
    _stage(workdir, DAY2)
    p1, p2 = P.with_(dedupe_feed=True), P.with_(dedupe_feed=True, run_date=DAY2)
    first, second = _jdbc_plan(spark, src, p1), _jdbc_plan(spark, src, p2)
    publish_jdbc(first, _tables(), workdir, p1)
    dim = mart.all(NAMES[0])
    with pytest.raises(RuntimeError, match="0 rows changed instead of 1"):
        publish_jdbc(second, _tables(), workdir, p2)
    assert mart.all(NAMES[0]) == dim and [r[0] for r in mart.all(NAMES[2])] == ["2026-07-28"]


def test_relational_run_stages_only_outputs_with_rows(spark, workdir, mart):
    src = _stage(workdir, RUN, CUSTOMERS.splitlines()[0] + "\n", SALES.splitlines()[0] + "\n")
    publish_jdbc(_jdbc_plan(spark, src, P), _tables(), workdir, P)
    assert mart.appended == [] and len(mart.all(NAMES[2])) == 1


def test_jdbc_option_maps():
    t = JdbcTarget(url="jdbc:postgresql://db:5432/mart", user="u", password="p")
    assert t.write_options('"SALES_FACT"') == {
        "url": "jdbc:postgresql://db:5432/mart", "user": "u", "password": "p",
        "driver": "org.postgresql.Driver", "dbtable": '"SALES_FACT"', "batchsize": "10000"}
    opts = t.current_dim_read_options('"CUSTOMER_DIM"', 1, 1000, 4)
    assert opts["partitionColumn"] == "CUST_KEY" and opts["numPartitions"] == "4"
    assert "\"CURR_FLAG\" = 'Y'" in opts["dbtable"]
    assert "password" not in repr(t)
    with pytest.raises(ValueError):
        t.current_dim_read_options("T", 10, 1, 2)
    with pytest.raises(ValueError):
        t.current_dim_read_options("T", 1, 10, 0)
    assert t.next_key_options("T")["query"] == 'SELECT coalesce(max("CUST_KEY"), 0) + 1 AS "NEXT_KEY" FROM T'
    assert staging('"A"') == '"A_STAGE"' and staging("A", "EXPIRE") == "A_EXPIRE"


def test_no_key_is_given_by_hand():
    from dimflow.__main__ import parse_args
    with pytest.raises(SystemExit):
        parse_args(["--src-dir", "s", "--err-dir", "e", "--jdbc-url", "jdbc:x", "--jdbc-next-key", "1"])
    changes = dict(load_statements("DIM", "FACT", "LOG", "a1", "2026-07-28", 7, {"dimension": 2, "expire": 1, "fact": 0}))
    assert list(changes.values()) == [1, -1, 2, -1, -1] and not any("FACT" in sql for sql in changes)

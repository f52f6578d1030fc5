"""Property tests: routing partitions the input; every join path gives the same rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dimflow import schemas as S
from dimflow.operators import enrich, passed, rejected, rejects_in_one_pass, sales_rules, unclassified, unmatched
from dimflow.params import RunParams

P = RunParams(run_date=dt.date(2026, 7, 28))

maybe = lambda s: st.one_of(st.none(), s)
sales_row = st.tuples(
    st.text(alphabet="abc", min_size=1, max_size=3),                                    # TXN_ID
    maybe(st.sampled_from(["c1", "c2", "c3", "c4"])),                                   # CUST_ID
    st.just("P"), maybe(st.just("S")), st.just("W"),
    maybe(st.just(dt.date(2026, 7, 1))),                                                # TXN_DATE
    maybe(st.integers(-2, 3)),                                                          # QTY
    st.just(Decimal("1.00")),
    maybe(st.sampled_from([Decimal("-1.00"), Decimal("0.00"), Decimal("2.50")])),      # AMOUNT
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(sales_row, max_size=25))
def test_quality_streams_partition_rows(spark, data):
    df = spark.createDataFrame(data, S.SALES_TXN)
    rules = sales_rules()
    n_pass, n_rej, n_unc = (passed(df, rules).count(), rejected(df, rules, ["TXN_ID"]).count(),
                            unclassified(df, rules).count())
    assert n_pass + n_rej + n_unc == len(data)


@SETTINGS
@given(st.lists(sales_row, max_size=25), st.sampled_from([0, 1, 100]))
def test_join_paths_agree(spark, data, cap):
    s = spark.createDataFrame(data, S.SALES_TXN)
    d = spark.createDataFrame(
        [(1, "c1", "n", None, None, None, None, None, None, None, "Y"),
         (2, "c2", "n", None, None, None, None, None, None, None, "Y"),
         (3, "c2", "n", None, None, None, None, None, None, None, "Y")], S.CUSTOMER_DIM)
    p = P.with_(broadcast_max_rows=cap, skew_sample_fraction=1.0, hot_key_share=0.2)
    ref = P.with_(broadcast_max_rows=1000)
    ids = ["TXN_ID", "CUST_ID"]
    assert rows(enrich(s, d, "CUST_ID", p)) == rows(enrich(s, d, "CUST_ID", ref))
    two = unmatched(s, d, "CUST_ID", "NF", ref, ids).unionByName(
        rejected(enrich(s, d, "CUST_ID", ref), sales_rules(), ids))
    assert rows(rejects_in_one_pass(s, d, "CUST_ID", "CUST_KEY", "NF", sales_rules(), p, ids)) == rows(two)


dim_row = st.tuples(st.integers(1, 6), maybe(st.sampled_from(["c1", "c2", "c3"])))        # CUST_KEY, CUST_ID


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(sales_row, max_size=20), st.lists(dim_row, max_size=6), st.sampled_from([0, 1000]))
def test_one_pass_audit_equals_every_output_count(spark, data, dim_rows, cap):
    from dimflow.plans import Inputs, plan
    from dimflow.plans.daily_run import AUDITED, audit

    s = spark.createDataFrame(data, S.SALES_TXN)
    d = spark.createDataFrame([(k, c, "n", None, None, None, None, None, dt.date(2026, 1, 1),
                                dt.date(9999, 12, 31), "Y") for k, c in dim_rows], S.CUSTOMER_DIM)
    f = spark.createDataFrame([("c1", "n", None, None, None, None, "X", None, None)], S.CUSTOMER_DELTA)
    inputs = Inputs(customer_delta=f, sales_txn=s, dimension=d)
    out = plan(inputs, P.with_(broadcast_max_rows=cap, skew_sample_fraction=1.0, hot_key_share=0.2))
    got = {r.OUTPUT: r.ROW_COUNT for r in audit(inputs, out).collect()}
    frames = {"customer_delta": f, "sales_txn": s, "dimension_current": d}
    assert got == {name: (frames[name] if name in frames else getattr(out, name)).count() for name in AUDITED}

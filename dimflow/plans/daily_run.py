"""The whole daily run as one side-effect-free plan, then one publish step.

``plan`` declares DataFrames; its only actions are small: one aggregate pass for
the size of the current dimension and the next free surrogate key (none when
the store's commit marker records both), checkpoints of the one-day change set
and its keyed versions (which cut their lineage), and the sales lookup's join
decision. Every output is built from the others inside the DAG — in particular
the post-load snapshot used for the fact lookup is the plan's own
``current_after``, never a re-read of a table being written. ``publish``
writes each output once.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dimflow import schemas as S
from dimflow.operators import changes, errors, facts, keys, quality, scd2
from dimflow.operators.joins import LookupPlan, Size, materialize_measured, measure, plan_lookup, row_bytes
from dimflow.params import RunParams
from dimflow.session import drop_scratch, materialize, scratch_path
from dimflow.sinks import writers
from dimflow.sources.catalog import CatalogMart
from dimflow.sources.dimension import DimensionStore, current_rows
from dimflow.sources.jdbc import ATTEMPT, JdbcTarget, load_statements, staging


# Helper columns of the plan and the audit.
MATCHED = "_dimflow_matched"
FIRST = "_dimflow_first"
CLASS = "_dimflow_class"
MULT = "_dimflow_mult"
LEAST = "_dimflow_least"
# What the fact and the error log need of a joined sales row.
TAGGED_COLUMNS = ("TXN_ID", "CUST_ID", "PRODUCT_ID", "STORE_ID", "TXN_DATE", "QTY", "UNIT_PRICE", "AMOUNT",
                  S.CUSTOMER_KEY, MATCHED)


@dataclass(frozen=True)
class Inputs:
    customer_delta: DataFrame
    sales_txn: DataFrame
    dimension: DataFrame                 # every version before the run (may hold only current rows)
    dimension_current: DataFrame | None = None  # current rows, when the store keeps them apart
    key_base: int | None = None          # next free surrogate key, when the store records it
    current_size: Size | None = None     # measured size of the current rows, when the store records it
    base_version: str | None = None      # the store's version these inputs were read from
    history_rows: int | None = None      # rows of the dimension beside the current ones, when the store records it
    seen: int | None = None              # the store's last commit when these inputs were read


@dataclass(frozen=True)
class Outputs:
    key_base: int
    next_key: int
    base_version: str | None
    seen: int | None
    sales_txn: DataFrame
    customer_delta: DataFrame
    rows_before: tuple[int, int]  # current and all rows of the dimension before the run
    change_rows: int             # observed while the change set was written
    expired_rows: int
    new_rows: int
    changes: DataFrame
    expired: DataFrame
    new_versions: DataFrame
    dimension_before: DataFrame
    dimension_closed: DataFrame
    current_after: DataFrame
    lookup_dimension: DataFrame
    lookup_plan: LookupPlan
    tagged_sales: DataFrame      # the one left join of the sales with the lookup dimension
    enriched: DataFrame
    lookup_rejects: DataFrame
    dq_pass: DataFrame
    dq_rejects: DataFrame
    dq_unclassified: DataFrame
    fact: DataFrame
    errors: DataFrame
    params: RunParams

    @cached_property
    def dimension_after(self) -> DataFrame:
        """The whole dimension after the run; planned only when asked for, since publishing does not write it."""
        return scd2.apply_to_dimension(self.dimension_before, self.expired, self.new_versions, self.params,
                                       expired_size=self.closing_size)

    closing_size: Size | None = None


def dimension_facts(inputs: Inputs, dim_current: DataFrame) -> tuple[Size, int, int]:
    """Size of the current rows, the next free surrogate key and the number of all rows.

    Taken from the store when it records them (no scan at all); otherwise all
    come from one aggregate pass over the dimension (partial per task).
    """
    size, base, history = inputs.current_size, inputs.key_base, inputs.history_rows
    if size is not None and base is not None and history is not None:
        return size, base, size.rows + history
    dim = inputs.dimension.select(*S.names(S.CUSTOMER_DIM))
    current = F.col("CURR_FLAG") == F.lit(S.CURRENT_FLAG)
    row = dim.agg(F.count_if(current).alias("rows"), F.count(F.lit(1)).alias("all"),
                  F.sum(F.when(current, row_bytes(dim))).alias("bytes"),
                  F.max(S.CUSTOMER_KEY).alias("top")).first()
    if size is None and inputs.dimension_current is not None:
        size = measure(dim_current)
    size = size or Size(int(row["rows"]), int(row["bytes"] or 0))
    if base is None:
        base = 1 if row["top"] is None else int(row["top"]) + 1
    return size, base, int(row["all"])


def tag_sales(sales: DataFrame, lookup: LookupPlan, columns: tuple[str, ...] = ()) -> DataFrame:
    """One left join of the sales with the lookup side: their columns, the surrogate key, a match flag, ``columns``."""
    flagged = replace(lookup, lookup=lookup.lookup.withColumn(MATCHED, F.lit(True)))
    return flagged.join(sales, "left", [S.CUSTOMER_KEY, MATCHED, *columns])


def plan(inputs: Inputs, params: RunParams) -> Outputs:
    dim_current = inputs.dimension_current if inputs.dimension_current is not None \
        else current_rows(inputs.dimension)
    feed = inputs.customer_delta
    if params.dedupe_feed:
        feed = changes.latest_per_key(feed, S.CUSTOMER_ID, "EFF_DATE")

    # Size facts proven once and reused by every broadcast decision below.
    current_size, base, all_rows = dimension_facts(inputs, dim_current)

    # The change set and its keyed versions are small (one business day) and feed
    # several outputs: checkpoint them once so keys are computed exactly once.
    # Their sizes are observed by the checkpoint jobs themselves.
    closing_rows = F.count_if(F.col("CHANGE_CODE").isin(S.EDIT, S.DELETE))
    change_set, change_size, observed = materialize_measured(
        changes.capture_changes(feed, dim_current, params, current_size=current_size), closing=closing_rows)
    expired = scd2.expire(change_set, params)
    new, new_size, _ = materialize_measured(scd2.new_versions(change_set, base, params, stable_input=True))
    next_key = base + new_size.rows  # keys are dense: base .. base + n - 1
    # Exactly the edits and deletes; an expire row (key, flag, date) is no wider than the change row it comes from.
    closing_size = Size(int(observed["closing"]), change_size.bytes)
    closing = scd2.closing_plan(dim_current, expired, params, expired_size=closing_size)
    closed = scd2.newly_expired(dim_current, expired, params, plan=closing)
    cur_after = scd2.current_after(dim_current, expired, new, params, plan=closing)

    if params.snapshot == "post_load":
        lookup_dim, lookup_size = cur_after, current_size + new_size
    else:
        lookup_dim, lookup_size = dim_current, current_size
    lookup_dim = lookup_dim.select(S.CUSTOMER_ID, *[c for c in S.names(S.CUSTOMER_DIM) if c != S.CUSTOMER_ID])
    # One join decision for every output that looks the sales up, and one narrow
    # left join of the sales (their columns, the surrogate key, a match flag) for
    # the two that are written: the fact and the error log, plus the lookup rejects.
    # The enriched stream (every dimension attribute) is its own inner join.
    lookup_plan = plan_lookup(inputs.sales_txn, lookup_dim, S.CUSTOMER_ID, params, lookup_size)
    dim_columns = [c for c in lookup_dim.columns if c != S.CUSTOMER_ID]
    tagged = tag_sales(inputs.sales_txn, lookup_plan)
    matched = F.col(MATCHED).isNotNull()
    enriched = lookup_plan.join(inputs.sales_txn, "inner", dim_columns).select(*inputs.sales_txn.columns,
                                                                                 *dim_columns)
    lookup_rejects = tagged.filter(~matched).select(
        "TXN_ID", "CUST_ID", F.lit(S.CUSTOMER_NOT_FOUND).alias("ERROR_REASON"))
    rules = quality.sales_rules()
    dq_pass, dq_rejects = quality.split(enriched, rules, ["TXN_ID", "CUST_ID"])
    return Outputs(
        key_base=base, next_key=next_key, base_version=inputs.base_version, seen=inputs.seen,
        sales_txn=inputs.sales_txn, customer_delta=inputs.customer_delta, rows_before=(current_size.rows, all_rows),
        change_rows=change_size.rows, expired_rows=closing_size.rows, new_rows=new_size.rows, changes=change_set, expired=expired, new_versions=new,
        dimension_before=inputs.dimension, closing_size=closing_size, params=params, dimension_closed=closed,
        current_after=cur_after,
        lookup_dimension=lookup_dim, lookup_plan=lookup_plan, tagged_sales=tagged, enriched=enriched,
        lookup_rejects=lookup_rejects,
        dq_pass=dq_pass, dq_rejects=dq_rejects, dq_unclassified=quality.unclassified(enriched, rules),
        fact=fact_of(tagged), errors=errors_of(tagged, params),
    )


def fact_of(tagged: DataFrame) -> DataFrame:
    """The fact, from the tagged sales."""
    return facts.summarise(quality.passed(tagged.filter(F.col(MATCHED).isNotNull()), quality.sales_rules()))


def errors_of(tagged: DataFrame, params: RunParams) -> DataFrame:
    """The error log, from the tagged sales."""
    return errors.funnel(errors.rejects_from_joined(tagged, S.CUSTOMER_KEY, S.CUSTOMER_NOT_FOUND,
                                                    quality.sales_rules(), ["TXN_ID", "CUST_ID"]), params=params)


AUDITED = ("customer_delta", "sales_txn", "dimension_current", "changes", "expired", "new_versions",
           "dimension_after", "lookup_rejects", "dq_pass", "dq_rejects", "dq_unclassified", "fact", "errors")
SALES_CLASSES = ("lookup_rejects", "dq_pass", "dq_rejects", "dq_unclassified")
# Counts that all come from one scan and one join of the sales.
SALES_SIDE = ("sales_txn", "lookup_rejects", "dq_pass", "dq_rejects", "dq_unclassified", "fact", "errors")


def sales_class() -> Column:
    """The class of a tagged sales row: lookup reject, pass, reject or unclassified."""
    rules = quality.sales_rules()
    return (F.when(F.col(MATCHED).isNull(), F.lit("lookup_rejects"))
            .when(F.coalesce(quality.pass_predicate(rules), F.lit(False)), F.lit("dq_pass"))
            .when(F.coalesce(quality.reject_predicate(rules), F.lit(False)), F.lit("dq_rejects"))
            .otherwise(F.lit("dq_unclassified")))


def sales_side_counts(sales: DataFrame, outputs: Outputs) -> DataFrame:
    """Rows of the sales feed and of every output derived from it, from one scan and join of the sales.

    The lookup side is reduced to its distinct (key, surrogate) pairs with their
    multiplicity, and the pair holding each key's least surrogate is flagged:
    all partial aggregations, so a key that holds a large share of the lookup
    never sorts in one task. A sales row then meets each pair once (weighted by
    the multiplicity, the enriched stream's fan-out) or none (a lookup reject),
    and is counted once through its flagged pair. Every joined row gets a class
    (lookup reject, pass, reject, unclassified); grouping by the class and the
    fact grain — kept for passing rows only, so the other classes collapse to
    one group each — yields the fact's row count as the number of passing
    groups, at the cost of the fact's own partial aggregate.
    """
    plan = outputs.lookup_plan
    on = list(plan.on)
    pairs = plan.side([S.CUSTOMER_KEY]).groupBy(*on, S.CUSTOMER_KEY).agg(F.count(F.lit(1)).alias(MULT))
    least = pairs.groupBy(*on).agg(F.min(S.CUSTOMER_KEY).alias(LEAST))
    # Bounded by the plan's own size proof unless salted; there AQE splits a hot key's partition.
    least = least if plan.strategy == "salted" else F.broadcast(least)
    flagged = (pairs.join(least, on)
               .withColumn(FIRST, F.col(S.CUSTOMER_KEY).eqNullSafe(F.col(LEAST))).drop(LEAST))
    joined = replace(plan, lookup=flagged).join(sales, "left", [S.CUSTOMER_KEY, MULT, FIRST])
    matched = F.col(MULT).isNotNull()
    joined = joined.withColumn(MATCHED, F.when(matched, F.lit(True)))
    grain = [F.when(F.col(CLASS) == "dq_pass", F.col(c)).alias(c) for c in S.FACT_GRAIN]
    groups = (joined.withColumn(CLASS, sales_class())
              .groupBy(F.col(CLASS), *grain)
              .agg(F.sum(F.coalesce(F.col(MULT), F.lit(1).cast("long"))).alias("_rows"),
                   F.count_if(~matched | F.col(FIRST)).alias("_sales")))

    def rows_of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(CLASS) == name, F.col("_rows"))), F.lit(0).cast("long"))

    wide = groups.agg(
        F.coalesce(F.sum("_sales"), F.lit(0).cast("long")).alias("sales_txn"),
        *[rows_of(name).alias(name) for name in ("lookup_rejects", "dq_pass", "dq_rejects", "dq_unclassified")],
        F.count_if(F.col(CLASS) == "dq_pass").alias("fact"),
    ).withColumn("errors", F.col("lookup_rejects") + F.col("dq_rejects"))
    return wide.unpivot([], list(SALES_SIDE), "OUTPUT", "ROW_COUNT")


def audit(inputs: Inputs, outputs: Outputs) -> DataFrame:
    """One row per input/output: ``(OUTPUT, ROW_COUNT)`` — the run's verification counts.

    The sales are scanned once, for all sales-side counts including the fact's;
    the feed and the dimension once each. The change set's counts were observed
    when it was written.
    """
    feed = inputs.customer_delta.agg(F.count(F.lit(1)).alias("customer_delta")).unpivot(
        [], ["customer_delta"], "OUTPUT", "ROW_COUNT")
    n_new = F.lit(outputs.new_rows).cast("long")
    all_rows = F.count(F.lit(1))
    if inputs.dimension_current is not None and inputs.current_size is not None:
        current = F.lit(inputs.current_size.rows).cast("long")
    else:
        current = F.count_if(F.col("CURR_FLAG") == F.lit(S.CURRENT_FLAG))
    dimension = inputs.dimension.agg(
        current.alias("dimension_current"), F.lit(outputs.change_rows).cast("long").alias("changes"),
        F.lit(outputs.expired_rows).cast("long").alias("expired"), n_new.alias("new_versions"),
        (all_rows + n_new).alias("dimension_after")).unpivot(
        [], ["dimension_current", "changes", "expired", "new_versions", "dimension_after"], "OUTPUT", "ROW_COUNT")
    return feed.unionByName(dimension).unionByName(sales_side_counts(inputs.sales_txn, outputs))


@dataclass(frozen=True)
class Targets:
    dimension_root: str
    fact_path: str
    error_dir: str
    fact_mode: str = "append"
    fact_order: tuple[str, ...] = ()  # columns whose order the fact's files keep


def inputs_from_store(customer_delta: DataFrame, sales_txn: DataFrame, store: DimensionStore,
                      params: RunParams) -> Inputs:
    """Inputs of a run against a versioned dimension store (empty store = first load)."""
    spark = sales_txn.sparkSession
    known = store.markers(spark)  # one read of the commit markers serves every lookup below
    base = store.base_version(spark, params.run_date, known)
    current = store.read_current(spark, base, known)
    history = store.read_history(spark, before=params.run_date, known=known)
    return Inputs(customer_delta=customer_delta, sales_txn=sales_txn,
                  dimension=history.unionByName(current), dimension_current=current,
                  key_base=store.next_key(spark, base, known), current_size=store.current_size(spark, base, known),
                  base_version=base, seen=store.last_number(known),
                  history_rows=sum(m["closed_rows"] for v, m in known.items() if v < params.run_tag))


def _first_of_key(lookup: LookupPlan) -> LookupPlan:
    """The lookup side with the row of each key's least surrogate flagged: a sales row is counted through it once."""
    on = list(lookup.on)
    side = lookup.side([S.CUSTOMER_KEY])
    least = side.groupBy(*on).agg(F.min(S.CUSTOMER_KEY).alias(LEAST))
    return replace(lookup, lookup=side.join(least, on, "left").withColumn(
        FIRST, F.col(S.CUSTOMER_KEY) == F.col(LEAST)).drop(LEAST))


@dataclass(frozen=True)
class TaggedSales:
    """The narrow joined sales of one run, written once, and the counts observed by that write."""

    rows: DataFrame
    path: str
    counts: dict[str, int]

    @staticmethod
    def write(outputs: Outputs) -> TaggedSales:
        """Write the one scan and join of the feed to the shared folder; fact, error log and audit are made from there.

        Rows are counted in the tasks that write them, which count once however
        often a task before them is repeated. Where the sales are not shuffled
        that holds for their scan, too; behind a shuffle each is counted through
        its match with the least surrogate.
        """
        spark = outputs.sales_txn.sparkSession
        path = scratch_path(spark, "tagged_sales")
        scanned = Observation(f"sales_{uuid.uuid4().hex}")
        if outputs.lookup_plan.strategy == "salted":
            tagged = tag_sales(outputs.sales_txn, _first_of_key(outputs.lookup_plan), (FIRST,))
            of_sales = [F.count_if(F.col(MATCHED).isNull() | F.col(FIRST)).alias("sales_txn")]
        else:
            tagged, of_sales = tag_sales(outputs.sales_txn.observe(scanned, F.count(F.lit(1)).alias("sales_txn")),
                                         outputs.lookup_plan), []
        classed = Observation(f"classes_{uuid.uuid4().hex}")
        counts = [F.count_if(sales_class() == name).alias(name) for name in SALES_CLASSES]
        narrow = tagged.observe(classed, *counts, *of_sales).select(*TAGGED_COLUMNS)
        narrow.write.parquet(path)
        seen = {**classed.get, **({} if of_sales else scanned.get)}
        return TaggedSales(spark.read.schema(narrow.schema).parquet(path), path, {k: int(n) for k, n in seen.items()})

    def audit(self, outputs: Outputs, fact_rows: int, error_rows: int) -> DataFrame:
        """The run's verification counts (as :func:`audit`), from what its writes observed: no input is read but the feed."""
        current, everything = outputs.rows_before
        counts = {"customer_delta": outputs.customer_delta.count(), "dimension_current": current,
                  "changes": outputs.change_rows, "expired": outputs.expired_rows, "new_versions": outputs.new_rows,
                  "dimension_after": everything + outputs.new_rows, "fact": fact_rows, "errors": error_rows, **self.counts}
        return self.rows.sparkSession.createDataFrame([(name, counts[name]) for name in AUDITED],
                                                      "OUTPUT string, ROW_COUNT long")


def publish_audited(outputs: Outputs, targets: Targets, params: RunParams) -> tuple[dict[str, int], DataFrame]:
    """Write dimension, fact and error log once each; the observed row counts and the audit made from them.

    The narrow tagged sales (the one scan and join of the feed) are written once
    to the shared folder; fact and error log are both made from there, so the
    feed's text is parsed once and a lost executor repeats neither. The writes
    are independent jobs and overlap. The dimension version is committed only
    after all writes succeeded, then the fact, then the error log: a run that
    fails, or finds that another one has committed since it read its inputs
    (:class:`~dimflow.sinks.writers.CommitConflict`), leaves the previous
    dimension and error log live and no fact rows of its own, and its date can be
    run again.
    """
    spark = outputs.fact.sparkSession
    store = DimensionStore(targets.dimension_root)
    base = store.markers(spark).get(outputs.base_version) if outputs.base_version else None

    def dimension() -> writers.StagedVersion:
        if base and len(base["parts"]) <= params.compact_every:
            return writers.stage_dimension_delta(store, base, outputs.new_versions, outputs.dimension_closed,
                                                 params.run_date, bool(outputs.new_rows), bool(outputs.expired_rows))
        return writers.stage_dimension_version(store, outputs.current_after, outputs.dimension_closed, params.run_date)

    with ThreadPoolExecutor(max_workers=3, thread_name_prefix="dimflow-publish") as pool:
        staged = pool.submit(dimension)
        tagged = TaggedSales.write(outputs)
        fact = pool.submit(writers.stage_fact, fact_of(tagged.rows), targets.fact_path, params.run_date,
                           targets.fact_order)
        log = pool.submit(writers.stage_error_log, errors_of(tagged.rows, params), targets.error_dir, params.run_date)
        staged_version, staged_fact, staged_log = staged.result(), fact.result(), log.result()
    counts = writers.commit_dimension_version(spark, store, staged_version, outputs.next_key, outputs.seen)
    counts.update({"fact": writers.commit_fact(spark, targets.fact_path, staged_fact, targets.fact_mode),
                   "errors": writers.commit_error_log(spark, targets.error_dir, staged_log)})
    audited = tagged.audit(outputs, staged_fact.rows, staged_log.rows)
    drop_scratch(spark, tagged.path)
    return counts, audited


def publish(outputs: Outputs, targets: Targets, params: RunParams) -> dict[str, int]:
    """:func:`publish_audited` without the audit."""
    return publish_audited(outputs, targets, params)[0]


def inputs_from_catalog(customer_delta: DataFrame, sales_txn: DataFrame, mart: CatalogMart, params: RunParams) -> Inputs:
    """Inputs of a run against tables of the catalog, which are made if they are not there."""
    spark = sales_txn.sparkSession
    mart.ensure(spark)
    return Inputs(customer_delta=customer_delta, sales_txn=sales_txn,
                  dimension=mart.read_dimension(spark, params.run_date))


def publish_catalog(outputs: Outputs, mart: CatalogMart, params: RunParams) -> dict[str, int]:
    """Insert fact, error log and, last, the versions opened and closed, each in the place of the date's earlier rows."""
    spark = outputs.fact.sparkSession
    tagged = TaggedSales.write(outputs)
    closed = materialize(outputs.dimension_closed)  # read from the table that is about to change
    mart.overwrite(fact_of(tagged.rows), mart.fact, S.SALES_FACT, params.run_date)
    mart.overwrite(errors_of(tagged.rows, params), mart.errors, S.ERROR_LOG, params.run_date)
    opened = outputs.new_versions.select(*S.names(S.CUSTOMER_DIM))
    mart.overwrite(opened.unionByName(closed.select(*opened.columns)), mart.dimension_rows, S.CUSTOMER_DIM, params.run_date)
    drop_scratch(spark, tagged.path)
    return {"dim_new": outputs.new_rows, "dim_closed": outputs.expired_rows, **tagged.counts}


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a relational mart; staging tables and the table of commits are beside them."""

    target: JdbcTarget
    dimension: str
    fact: str
    commits: str
    partitions: int


def inputs_from_jdbc(customer_delta: DataFrame, sales_txn: DataFrame, tables: JdbcTables) -> Inputs:
    """Inputs of a run against a relational dimension, read in ranges of its keys; the next key is asked of the database."""
    spark = sales_txn.sparkSession
    next_key = tables.target.next_key(spark, tables.dimension)
    current = tables.target.read_current_dim(spark, tables.dimension, 1, max(1, next_key - 1), tables.partitions)
    return Inputs(customer_delta=customer_delta, sales_txn=sales_txn, dimension=current, dimension_current=current,
                  key_base=next_key)


def publish_jdbc(outputs: Outputs, tables: JdbcTables, error_dir: str, params: RunParams) -> dict[str, int]:
    """Stage the outputs under an attempt id, then apply them in one transaction, then commit the error log.

    The transaction takes the run date in the table of commits, which the
    database allows once, and checks that no other run has used the keys since.
    A date that is already committed is not loaded again (``already_loaded``),
    and staged rows of failed or repeated tasks count once: rows are told apart
    by value, and dimension rows by key. Nothing is staged for zero rows.
    """
    spark, target = outputs.fact.sparkSession, tables.target
    if target.is_committed(spark, tables.commits, params.run_tag):
        return {"already_loaded": 1}
    attempt = uuid.uuid4().hex
    tagged = TaggedSales.write(outputs)
    fact = materialize(fact_of(tagged.rows))
    log = writers.stage_error_log(errors_of(tagged.rows, params), error_dir, params.run_date)
    staged = {"dimension": outputs.new_rows, "expire": outputs.expired_rows, "fact": fact.count()}
    frames = {"dimension": outputs.new_versions.select(*S.names(S.CUSTOMER_DIM)), "expire": outputs.expired, "fact": fact}
    names = {"dimension": staging(tables.dimension), "expire": staging(tables.dimension, "EXPIRE"),
             "fact": staging(tables.fact)}
    for part, rows in staged.items():
        if rows:
            target.append(frames[part].withColumn(ATTEMPT, F.lit(attempt)), names[part])
    target.apply(spark, load_statements(tables.dimension, tables.fact, tables.commits, attempt, params.run_tag,
                                        outputs.key_base, staged))
    writers.commit_error_log(spark, error_dir, log)
    drop_scratch(spark, tagged.path)
    return {"dim_new": outputs.new_rows, "dim_expire": outputs.expired_rows, "fact": staged["fact"],
            "errors": log.rows, "next_key": outputs.next_key}

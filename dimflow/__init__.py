"""dimflow — Spark-native daily loads of a dimensional data mart.

One run takes a business date, a feed of changed customers and a feed of sales
transactions, and produces four outputs as one lazy DataFrame plan:

* the customer dimension after SCD Type 2 maintenance,
* the sales fact (customer / product / store / day grain),
* the error log (lookup and data-quality rejects),
* a load audit (row counts per output).

Operators live in :mod:`dimflow.operators`, sources in :mod:`dimflow.sources`,
sinks in :mod:`dimflow.sinks`, column-expression helpers in
:mod:`dimflow.functions` and the composed job in :mod:`dimflow.plans`.
"""

from dimflow.params import RunParams

__all__ = ["RunParams"]

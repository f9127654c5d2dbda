"""Every runnable query: name -> (function of session and data folder, SQL or None)."""

from __future__ import annotations

from ledgerweave.plans import dataset_queries, finance_queries

QUERIES = {**finance_queries.QUERIES, **dataset_queries.QUERIES}

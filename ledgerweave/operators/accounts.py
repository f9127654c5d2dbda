"""Account balances and movements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.measures import (
    BY, double, is_fact, matching, narrow, zero_if_null,
)
from ledgerweave.operators.ranking import top_k
from ledgerweave.operators.tally import Tally, tally
from ledgerweave.periods import resolve


def account_balance(accounts: DataFrame, account: str | None = None, *,
                    by: Sequence[str] = BY) -> DataFrame:
    """Stored balances; they are not derived from transactions."""
    rows = accounts if account is None else accounts.where(F.col("name") == account)
    return rows.select(*by, "name", double(F.col("balance")).alias("balance"))


def account_transfers_tally(tx: DataFrame, as_of, account: str, period) -> Tally:
    moved = (zero_if_null(F.col("spent")) + zero_if_null(F.col("income")) if is_fact(tx)
             else F.abs(F.col("amount")))
    return Tally(resolve(period, as_of), {"moved": moved},
                 lambda s: [{"transferred": double(s("moved"))}],
                 matching(F.lit(True), account=account))


def account_transfers(tx: DataFrame, as_of, account: str, period, *,
                      by: Sequence[str] = BY, tenants: DataFrame | None = None) -> DataFrame:
    """Money moved on an account in either direction."""
    return tally(tx, account_transfers_tally(tx, as_of, account, period), by, tenants)


def account_activity(tx: DataFrame, as_of, account: str, period, *, cap: int | None = None,
                     by: Sequence[str] = BY) -> DataFrame:
    """Transactions of one account, newest first; ``cap`` rows per tenant if given."""
    rows = narrow(tx, as_of, period, account=account)
    if cap is not None:
        order = [F.desc("tx_date"), F.desc("amount"), F.asc("description"), F.asc("category"),
                 F.asc("id")]
        rows = top_k(rows, by, order, cap)
    return rows.select(*by, "id", "tx_date", "description",
                       double(F.col("amount")).alias("amount"), "category", "account")

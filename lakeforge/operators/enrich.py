"""Currency enrichment and conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_fx(orders: DataFrame, rates: DataFrame, code_col: str = "currency_code",
              target_col: str = "target_currency", rate_col: str = "exchange_rate") -> DataFrame:
    """Attach the exchange rate of each row's currency (LEFT join: unmatched keep NULL).

    ``rates`` must be unique on ``target_col`` (deduplicate first, or an order
    fans out). No hint is given: Spark broadcasts a rate table below its size
    threshold, by the optimizer's estimate or the size met at run time.
    """
    r = rates.select(F.col(target_col).alias("__fx_target"), rate_col)
    return (orders.join(r, F.col(code_col) == F.col("__fx_target"), "left")
            .drop("__fx_target"))


def convert_to_base(amount_col: str, rate_col: str = "exchange_rate"):
    """``amount / rate`` in the base currency; NULL when the rate is unknown or zero."""
    rate = F.col(rate_col)
    return F.when(rate.isNotNull() & (rate != 0), F.col(amount_col).cast("double") / rate)

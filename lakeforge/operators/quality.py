"""Declarative expectations and row-rule audits.

Each expectation compiles to a DataFrame of failing rows; ``run_expectations``
counts them for a whole list of tests in one grouped pass (one row per test).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import orphans


def duplicate_keys(df: DataFrame, col: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once (NULL keys excluded): key columns + ``n``.

    A partial hash aggregate before the shuffle keeps a hot key to one row
    per map task.
    """
    cols = [col] if isinstance(col, str) else list(col)
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


@dataclass(frozen=True)
class Expectation:
    """One column test: ``unique``, ``not_null`` or ``relationships``."""
    kind: str
    model: str
    column: str
    to: str | None = None
    field: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to}_{self.field}"
        return f"{self.kind}_{self.model}_{self.column}"

    def failures(self, ref) -> DataFrame:
        df = ref(self.model)
        if self.kind == "unique":
            return duplicate_keys(df, self.column)
        if self.kind == "not_null":
            return null_rows(df, self.column)
        if self.kind == "relationships":
            return orphans(df, self.column, ref(self.to), self.field)
        raise ValueError(self.kind)


# --- fixed values: the column tests of the core models -------------------------
CORE_EXPECTATIONS = [
    Expectation("unique", "dim_customer", "customer_key"),
    Expectation("not_null", "dim_customer", "customer_key"),
    Expectation("unique", "dim_product", "product_key"),
    Expectation("not_null", "dim_product", "product_key"),
    Expectation("unique", "dim_store", "store_key"),
    Expectation("not_null", "dim_store", "store_key"),
    Expectation("unique", "dim_date", "date_key"),
    Expectation("not_null", "dim_date", "date_key"),
    Expectation("unique", "fact_sales", "order_item_id"),
    Expectation("not_null", "fact_sales", "order_item_id"),
    Expectation("relationships", "fact_sales", "customer_key", "dim_customer", "customer_key"),
    Expectation("relationships", "fact_sales", "product_key", "dim_product", "product_key"),
    Expectation("relationships", "fact_sales", "store_key", "dim_store", "store_key"),
]
# --- end of fixed values -------------------------------------------------------


def run_expectations(ref, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per test: test_name, kind, model, column_name, failures, passed.

    All tests are one grouped pass. Every tested column belongs to a domain: the column
    itself, or for a foreign key the column it refers to. A model is read once and hands on,
    for each of its tested columns, the key under the domain's name, counted as a row of the
    domain's own column or of a column that refers to it. Grouped by domain and key (counts
    are combined map-side, so a hot key is a row per task), a group tells whether the key is
    null, doubled or without its parent. Unique tests count doubled keys, the others failing
    rows. Nothing runs before the action.
    """
    domains: dict[tuple[str, str], int] = {}
    roles: dict[tuple[str, str], list[tuple[int, str]]] = {}
    for e in expectations:
        home = (e.to, e.field) if e.kind == "relationships" else (e.model, e.column)
        domain = domains.setdefault(home, len(domains))
        roles.setdefault(home, [])
        if (domain, "") not in roles[home]:
            roles[home].append((domain, ""))
        if e.kind == "relationships" and (domain, e.name) not in roles.setdefault((e.model, e.column), []):
            roles[e.model, e.column].append((domain, e.name))
    children = sorted({name for held in roles.values() for _, name in held if name})
    passes = []
    for m in sorted({m for m, _ in roles}):
        df = ref(m)
        keys = [F.struct(F.lit(domain).alias("domain"), F.col(column).cast("string").alias("key"),
                         F.lit(name).alias("child"))
                for (of, column), held in sorted(roles.items()) if of == m for domain, name in held]
        passes.append(df.select(F.explode(F.array(*keys)).alias("k")).select("k.*"))
    counts = (reduce(DataFrame.unionByName, passes).groupBy("domain", "key").agg(
        F.count(F.when(F.col("child") == "", 1)).alias("parents"),
        *[F.count(F.when(F.col("child") == c, 1)).alias(f"child{i}") for i, c in enumerate(children)]))
    failures, present = [], F.col("key").isNotNull()
    for i, e in enumerate(expectations):
        home = (e.to, e.field) if e.kind == "relationships" else (e.model, e.column)
        mine = F.col("domain") == domains[home]
        if e.kind == "unique":
            found = F.count(F.when(mine & present & (F.col("parents") > 1), 1))
        elif e.kind == "not_null":
            found = F.sum(F.when(mine & ~present, F.col("parents")))
        elif e.kind == "relationships":
            found = F.sum(F.when(mine & present & (F.col("parents") == 0), F.col(f"child{children.index(e.name)}")))
        else:
            raise ValueError(e.kind)
        failures.append(F.coalesce(found, F.lit(0)).cast("bigint").alias(f"f{i}"))
    rows = [F.struct(F.lit(e.name).alias("test_name"), F.lit(e.kind).alias("kind"), F.lit(e.model).alias("model"),
                     F.lit(e.column).alias("column_name"), F.col(f"f{i}").alias("failures"),
                     (F.col(f"f{i}") == 0).alias("passed")) for i, e in enumerate(expectations)]
    return counts.agg(*failures).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the NULL count of every column, in a single pass."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])


def rule_audit(df: DataFrame, table: str, key: str, rules: Sequence[tuple[str, str, Column]]
               ) -> DataFrame:
    """Long-form findings (table_name, row_key, field, issue) of ``rules``.

    ``rules`` are ``(field, issue, condition)``; every row is checked against
    all rules in one pass (an array of optional findings, filtered and
    exploded), so the table is read once whatever the number of rules.
    """
    finding = F.array(*[F.when(cond, F.struct(F.lit(fld).alias("field"), F.lit(issue).alias("issue")))
                        for fld, issue, cond in rules])
    return (df.select(F.col(key).alias("row_key"),
                      F.explode(F.filter(finding, lambda x: x.isNotNull())).alias("f"))
            .select(F.lit(table).alias("table_name"), "row_key", "f.field", "f.issue"))


def check_batch(df: DataFrame | None, table: str, required: Sequence[str] = (),
                optional: bool = False) -> DataFrame:
    """Raw-batch gate as a result row: table_name, batch_present, row_count,
    missing_columns, passed. A missing optional batch passes.

    ``df`` must have the columns the batch really has (``read_landed`` for CSV): a frame
    already aligned to the schema has every required name."""
    spark_cols = set(c.lower() for c in df.columns) if df is not None else set()
    missing = sorted(c for c in required if c.lower() not in spark_cols)
    if df is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame(
            [(table, False, 0, "", optional)],
            "table_name string, batch_present boolean, row_count bigint, "
            "missing_columns string, passed boolean")
    cnt = df.agg(F.count(F.lit(1)).alias("row_count"))
    return cnt.select(
        F.lit(table).alias("table_name"), F.lit(True).alias("batch_present"), "row_count",
        F.lit(",".join(missing)).alias("missing_columns"),
        ((F.col("row_count") > 0) & F.lit(not missing)).alias("passed"))

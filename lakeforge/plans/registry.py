"""Named models wired by name, built lazily and memoised per context.

A model is a function ``(ctx) -> DataFrame`` that asks the context for its
inputs with ``ctx.ref(name)``. Nothing runs until an action: all models
requested from one context compose into one Catalyst plan, and repeated
sub-plans are de-duplicated by exchange reuse.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

ModelFn = Callable[["Context"], DataFrame]


@dataclass(frozen=True)
class ModelDef:
    name: str
    layer: str
    fn: ModelFn
    doc: str = ""


MODELS: dict[str, ModelDef] = {}


def model(name: str, layer: str) -> Callable[[ModelFn], ModelFn]:
    def deco(fn: ModelFn) -> ModelFn:
        MODELS[name] = ModelDef(name, layer, fn, (fn.__doc__ or "").strip())
        return fn
    return deco


@dataclass
class Context:
    """Inputs and options of one pipeline run.

    ``bronze(name)`` returns a bronze table (all batches, lineage included) for
    ``customers products stores orders order_items payments`` and the raw FX
    rows for ``fx_rates``.
    """
    spark: SparkSession
    bronze: Callable[[str], DataFrame]
    options: dict = field(default_factory=dict)
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def ref(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in MODELS:
                raise KeyError(f"unknown model {name!r}")
            self._cache[name] = MODELS[name].fn(self)
        return self._cache[name]

    def source(self, name: str) -> DataFrame:
        key = f"__source__{name}"
        if key not in self._cache:
            self._cache[key] = self.bronze(name)
        return self._cache[key]

    def opt(self, key: str, default=None):
        return self.options.get(key, default)

    def as_of(self, batch_date: str) -> Context:
        """This context over the bronze batches up to ``batch_date`` (memoised)."""
        key = f"__as_of__{batch_date}"
        if key not in self._cache:
            def until(name: str) -> DataFrame:
                df = self.source(name)
                return df.where(df.batch_date <= batch_date) if "batch_date" in df.columns else df
            self._cache[key] = Context(self.spark, until, {k: v for k, v in self.options.items()
                                                           if k != "loads"})
        return self._cache[key]

    def over_loads(self, loads: tuple[str, ...]) -> Context:
        """This context with silver of all ``loads`` at once: each version of a key with the
        loads that hold it (memoised). Silver's rules look at one row, so they apply alike."""
        key = f"__over__{','.join(loads)}"
        if key not in self._cache:
            options = {k: v for k, v in self.options.items() if k != "loads"}
            self._cache[key] = Context(self.spark, self.source, options | {"over_loads": tuple(loads)})
        return self._cache[key]


def fixture_context(spark: SparkSession, sf_dir: str, **options) -> Context:
    """Context whose bronze tables are the fixture adapters over ``sf_dir``, loaded into
    staging once per batch date of the adapters."""
    from ..sources import fixtures

    memo: dict = {}

    def bronze(name: str) -> DataFrame:
        if name == "fx_rates":
            return fixtures.fx_rates_raw(spark)
        return fixtures.adapter(spark, sf_dir, name, memo)

    return Context(spark, bronze, {"loads": fixtures.LOAD_DATES} | options)


def parquet_context(spark: SparkSession, bronze_root: str, fx_path: str | None = None,
                    **options) -> Context:
    """Context over a written bronze zone ``<root>/<table>/batch_date=*/``."""
    from ..sources import files

    def bronze(name: str) -> DataFrame:
        if name == "fx_rates":
            return files.read_fx_csv(spark, fx_path)
        return files.read_bronze(spark, bronze_root, name)

    return Context(spark, bronze, dict(options))


def register_views(ctx: Context, names: list[str], prefix: str = "") -> None:
    """View materialisation: expose models as temp views (no data written)."""
    for n in names:
        ctx.ref(n).createOrReplaceTempView(prefix + n)


def materialize(ctx: Context, name: str, path: str) -> DataFrame:
    """Table materialisation: write a model as parquet and read it back.

    Later models then start from the written table, which cuts the lineage
    there (a lost executor recomputes from the file, not from the sources).
    """
    ctx.ref(name).write.mode("overwrite").parquet(path)
    df = ctx.spark.read.parquet(path)
    ctx._cache[name] = df
    return df


def preview(df: DataFrame, n: int = 5, enabled: bool = False) -> None:
    """Optional sample print of a frame (off by default: it is an extra job)."""
    if enabled:
        df.printSchema()
        df.limit(n).show(truncate=False)

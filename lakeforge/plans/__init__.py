"""Models of the pipeline; importing this package registers all of them."""

from . import registry  # noqa: F401
from . import silver, staging, core, marts  # noqa: F401
from .registry import MODELS, Context, fixture_context, parquet_context  # noqa: F401

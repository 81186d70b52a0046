"""Versioned, multi-grain panel analytics on PySpark."""

from .plans.query import PanelQuery, discover
from .sources.bucketed import BucketedStore
from .sources.catalog import Catalog, FieldSpec, TableSpec, default_catalog
from .sources.grain import Grain
from .sources.store import FrameSource, Source, VersionedStore

__all__ = [
    "BucketedStore", "Catalog", "FieldSpec", "FrameSource", "Grain", "PanelQuery", "Source",
    "TableSpec", "VersionedStore", "default_catalog", "discover",
]


def _ship_worker_code() -> None:
    """Send the functions that run in Python workers along with the tasks.

    Executors then need numpy, pandas and pyarrow but not this package, however the
    application was submitted.
    """
    from pyspark import cloudpickle

    from .operators import recursive, rolling
    from .streaming import ema

    for module in (recursive, rolling, ema):
        cloudpickle.register_pickle_by_value(module)


_ship_worker_code()

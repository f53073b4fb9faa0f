"""Let tasks run this package's Python helpers without the package on the executors."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    """Pickle the functions of a module by value, so they travel with the task."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])

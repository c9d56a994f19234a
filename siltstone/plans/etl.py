"""The template all jobs follow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def run_etl(
    extract: Callable[[], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    load: Callable[[DataFrame], object],
) -> DataFrame:
    """Extract, transform, load; returns the transformed frame."""
    result = extract().transform(transform)
    load(result)
    return result

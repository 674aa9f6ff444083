"""Small column builders. All stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.functions.labels import Bands

EPOCH = "1970-01-01 00:00:00"


def _first_match(tests: Sequence[Column], values: Sequence, rest) -> Column:
    """Value of the first test that holds; ``rest`` otherwise, also for null."""
    chain = reduce(
        lambda c, tv: c.when(*tv),
        zip(tests[1:], values[1:]),
        F.when(tests[0], values[0]),
    )
    return chain.otherwise(rest)


def banded(value: Column, bands: Bands) -> Column:
    """Label of the band a value falls in. Null falls to the last label."""
    return _first_match(
        [value < edge for edge in bands.edges], bands.labels[:-1], bands.labels[-1]
    )


def band_order(value: Column, bands: Bands) -> Column:
    """Position of the band, for sorting by size instead of by text."""
    n = len(bands.edges)
    return _first_match([value < edge for edge in bands.edges], range(n), n).cast("int")


def labelled(code: Column, labels: Sequence[str]) -> Column:
    """Label of codes 1, 2, ...; any other code and null get the last label."""
    known = labels[:-1]
    return _first_match(
        [code == i for i in range(1, len(known) + 1)], known, labels[-1]
    )


def looked_up(code: Column, legend: Mapping[int, str]) -> Column:
    """Label of a code, null when the legend lacks it."""
    return _first_match([code == k for k in legend], list(legend.values()), F.lit(None))


def seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def minutes_between(start: Column, end: Column) -> Column:
    return (seconds(end) - seconds(start)) / 60


def bucket_of(ts: Column, minutes: int) -> Column:
    """Number of the ``minutes``-wide interval since 1970 that holds ``ts``."""
    return F.floor(seconds(ts) / (minutes * 60))


def bucket_start(bucket: Column, minutes: int) -> Column:
    """Start of a numbered interval, free of any session time zone."""
    return F.timestamp_add(
        "MINUTE", bucket * minutes, F.lit(EPOCH).cast("timestamp_ntz")
    )


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def rows() -> Column:
    return F.count(F.lit(1))

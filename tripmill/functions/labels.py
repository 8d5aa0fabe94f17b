"""Code to label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.schema import (
    DEFAULT_PAYMENT_LABEL,
    DEFAULT_VENDOR_NAME,
    PAYMENT_LABELS,
    VENDOR_NAMES,
)


def _lookup(key: Column, names: dict, default: str) -> Column:
    (first, name), *rest = names.items()
    start = F.when(key == first, F.lit(name))
    return reduce(lambda c, kv: c.when(key == kv[0], F.lit(kv[1])), rest, start).otherwise(default)


def payment_label(text: Column) -> Column:
    """Label of a payment code *text*: ``'1.0'`` is code 1 but has no label of its own."""
    return _lookup(F.trim(text), PAYMENT_LABELS, DEFAULT_PAYMENT_LABEL)


def vendor_name(vendor_id: Column) -> Column:
    return _lookup(vendor_id, VENDOR_NAMES, DEFAULT_VENDOR_NAME)

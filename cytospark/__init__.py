"""Spatial cell analytics, and text corpus operators, as Spark DataFrame functions."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors by value, which then need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Imports every module that registers queries."""

from quillfold.operators import calls, evals, feed, geometry, mirror, pipeline, records, studies, text  # noqa: F401

"""What a query's physical plan does: exchanges, joins, Python, pushed filters; used by tests and the bench."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def formatted(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def operators(df: DataFrame) -> Counter:
    """How often each physical operator stands in the plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return Counter(re.findall(r"(?:^|[\s:+\-*()\d]*?)\b([A-Z][A-Za-z]+(?:Exec)?)\b(?= |\(|$)", text, re.M))


def has_cartesian(df: DataFrame) -> bool:
    return "CartesianProduct" in df._jdf.queryExecution().executedPlan().toString()


def uses_python(df: DataFrame) -> bool:
    return bool(re.search("ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas|FlatMapGroups|FlatMapCoGroups", df._jdf.queryExecution().executedPlan().toString()))

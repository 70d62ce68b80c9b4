"""Ad hoc read-only SQL over registered views."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession


#: Calls that reach outside of SQL, and tables named by a file's path.
CALLS = re.compile(r"(?i)\b(java_method|reflect|try_reflect)`?\s*\(")
FILES = re.compile(r"(?i)\b(parquet|orc|json|csv|text|avro|xml|binaryfile)`?\s*\.\s*`")


class NotReadOnly(ValueError):
    """The text is not one SELECT or WITH query."""


def adhoc(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, limit: int | None = None) -> DataFrame:
    """Run one SELECT or WITH query with bound parameters (``:name``).

    The text is placed in a subquery, where Spark's own parser takes nothing but a
    query: a second statement or a command inside a CTE is a syntax error.
    """
    text = sql.strip().removesuffix(";").strip()
    if not text:
        raise NotReadOnly("SQL is required")
    if not re.match(r"(?i)(select|with)\b", text):
        raise NotReadOnly("only SELECT and WITH queries are permitted")
    if "--" in text or "/*" in text:
        raise NotReadOnly("comments are not permitted")
    if CALLS.search(text) or FILES.search(text):
        raise NotReadOnly("only SQL functions and registered views are permitted")
    rows = spark.sql(f"SELECT * FROM (\n{text}\n)", args=args or {})
    return rows if limit is None else rows.limit(limit)

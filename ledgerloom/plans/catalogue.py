"""All named queries and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans import evaluation, evaluation_sql, notice_sql, notices, retail, retail_sql, roundtrips

Query = retail.Query
PLACES = 6


def settled(df: DataFrame) -> DataFrame:
    """Results as other engines hand them over: money as DOUBLE, computed fractions to six places."""
    out = []
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            out.append(F.col(name).cast("double").alias(name))
        elif kind == "double":
            out.append(F.round(name, PLACES).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def _settling(query: Query) -> Query:
    return lambda spark, sf_dir: settled(query(spark, sf_dir))


_NAMED: dict[str, Query] = {**retail.QUERIES, **notices.QUERIES, **evaluation.QUERIES, **roundtrips.QUERIES}
QUERIES: dict[str, Query] = {name: _settling(query) for name, query in _NAMED.items()}
ORACLES: dict[str, str] = {**retail_sql.ORACLES, **notice_sql.ORACLES, **evaluation_sql.ORACLES, **roundtrips.ORACLES}

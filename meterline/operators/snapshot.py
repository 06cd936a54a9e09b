"""Type-2 history of a dimension."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE_KEY = "location_id"
ZONE_CHECKS = ["borough", "zone", "service_zone"]

# Fixed names of the history columns.
SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"


def _moment(at: datetime) -> Column:
    # As text: a Python datetime would pass through the session time zone.
    return F.lit(str(at)).cast("timestamp_ntz")


def _opened(rows: DataFrame, key: str, at: datetime) -> DataFrame:
    moment = _moment(at)
    return rows.withColumns(
        {
            SCD_ID: F.md5(F.concat_ws("|", F.col(key).cast("string"), moment.cast("string"))),
            UPDATED_AT: moment,
            VALID_FROM: moment,
            VALID_TO: F.lit(None).cast("timestamp_ntz"),
        }
    )


def apply_snapshot(
    history: DataFrame | None,
    source: DataFrame,
    at: datetime,
    key: str = ZONE_KEY,
    checks: list[str] = ZONE_CHECKS,
) -> DataFrame:
    """History after seeing ``source`` at a moment.

    A key with a changed check column (NULL equals NULL) gets its open row closed and a new one
    opened, a new key is opened, an unchanged or missing key stays as it is.
    """
    if history is None:
        return _opened(source, key, at)
    now = current_rows(history).select(key, *(F.col(c).alias(f"_{c}") for c in checks), F.lit(True).alias("_open"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in checks])
    changed = source.join(now, key, "left").where(F.col("_open").isNull() | ~same).select(*source.columns)
    closing = changed.select(key, F.lit(True).alias("_close"))
    ends = F.when(F.col(VALID_TO).isNull() & F.col("_close"), _moment(at)).otherwise(F.col(VALID_TO))
    kept = history.join(closing, key, "left").withColumn(VALID_TO, ends).select(*history.columns)
    return kept.unionByName(_opened(changed, key, at))


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull())


def rows_as_of(history: DataFrame, at: datetime) -> DataFrame:
    """Rows valid at a moment; the end of a row's validity is exclusive."""
    moment = _moment(at)
    return history.where((F.col(VALID_FROM) <= moment) & (F.col(VALID_TO).isNull() | (moment < F.col(VALID_TO))))

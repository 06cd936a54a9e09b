"""Pinned schemas."""

from __future__ import annotations

# Fixed raw layout: column names and types of one trip record.
RAW_COLUMNS = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "RatecodeID": "bigint",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
    "cbd_congestion_fee": "double",
}
AUDIT_COLUMNS = {"source_month": "date", "loaded_at": "timestamp_ntz"}
ZONE_COLUMNS = {"LocationID": "int", "Borough": "string", "Zone": "string", "service_zone": "string"}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {dtype}" for name, dtype in columns.items())


RAW_SCHEMA = ddl({**RAW_COLUMNS, **AUDIT_COLUMNS})
ZONE_SCHEMA = ddl(ZONE_COLUMNS)

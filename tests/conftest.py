import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meterline.session import build_session  # noqa: E402
from meterline.sources.schemas import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def trip(**changes) -> dict:
    """A valid raw trip of January 2025."""
    row = {
        "VendorID": 1,
        "tpep_pickup_datetime": datetime(2025, 1, 15, 8, 0),
        "tpep_dropoff_datetime": datetime(2025, 1, 15, 8, 30),
        "passenger_count": 1,
        "trip_distance": 5.0,
        "RatecodeID": 1,
        "store_and_fwd_flag": "N",
        "PULocationID": 1,
        "DOLocationID": 2,
        "payment_type": 1,
        "fare_amount": 20.0,
        "extra": 1.0,
        "mta_tax": 0.5,
        "tip_amount": 4.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 1.0,
        "total_amount": 26.5,
        "congestion_surcharge": 2.5,
        "Airport_fee": 0.0,
        "cbd_congestion_fee": 0.75,
        "source_month": date(2025, 1, 1),
        "loaded_at": datetime(2025, 2, 1),
    }
    assert changes.keys() <= row.keys()
    return row | changes


@pytest.fixture
def raw_of(spark):
    def build(*rows: dict):
        return spark.createDataFrame([tuple(r.values()) for r in rows], RAW_SCHEMA)

    return build


@pytest.fixture
def deliver(spark, tmp_path):
    """Write a month's delivery of generated trips and return its path."""

    def write(month: str, rows: int = 300, folder: str = "raw", change=lambda df: df) -> str:
        first = datetime.fromisoformat(f"{month}-01")
        trips = [
            trip(
                tpep_pickup_datetime=first + timedelta(minutes=7 * i),
                tpep_dropoff_datetime=first + timedelta(minutes=7 * i + 12),
                PULocationID=i % 3 + 1,
                fare_amount=10.0 + i,
                passenger_count=None if i % 5 == 0 else 2,
            )
            for i in range(rows)
        ]
        path = f"{tmp_path}/{folder}/yellow_tripdata_{month}.parquet"
        df = spark.createDataFrame([tuple(t.values()) for t in trips], RAW_SCHEMA).select(*RAW_COLUMNS)
        change(df).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    return write


@pytest.fixture
def zone_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '1,"EWR","Newark Airport","EWR"\n'
        '2,"Queens"," Jamaica Bay ","Boro Zone"\n'
        '3,"Manhattan","Alphabet City","Yellow Zone"\n'
        '264,"Unknown","N/A","N/A"\n'
        '265,"N/A","Outside of NYC","N/A"\n'
    )
    return str(path)

"""The SQL each query is compared with, composed of named steps."""

from __future__ import annotations

_STEPS = {
    "once": """
        SELECT l_suppkey % 8 AS "VendorID", pickup AS tpep_pickup_datetime,
            pickup + to_minutes(((l_orderkey * 7 + l_linenumber * 13) % 1600 - 60)::INT) AS tpep_dropoff_datetime,
            nullif(l_linenumber, 7)::BIGINT AS passenger_count, l_quantity AS trip_distance,
            NULL::BIGINT AS "RatecodeID", NULL::VARCHAR AS store_and_fwd_flag,
            l_suppkey AS "PULocationID", l_partkey % 100 AS "DOLocationID", (l_linenumber - 1)::BIGINT AS payment_type,
            CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
            NULL::DOUBLE AS extra, NULL::DOUBLE AS mta_tax,
            (l_extendedprice::DECIMAL(10,2) * l_discount::DECIMAL(4,2))::DECIMAL(10,2)::DOUBLE AS tip_amount,
            NULL::DOUBLE AS tolls_amount, NULL::DOUBLE AS improvement_surcharge,
            (l_extendedprice::DECIMAL(10,2) * (1 + l_tax)::DECIMAL(4,2))::DECIMAL(10,2)::DOUBLE AS total_amount,
            NULL::DOUBLE AS congestion_surcharge, NULL::DOUBLE AS "Airport_fee", NULL::DOUBLE AS cbd_congestion_fee,
            date_trunc('month', l_shipdate)::DATE AS source_month, l_shipdate AS loaded_at
        FROM (
            SELECT *, CASE WHEN l_linenumber = 3 AND l_quantity = 1 THEN l_shipdate - INTERVAL 1 MONTH
                ELSE l_shipdate END + to_minutes((l_partkey * 37 % 1440)::INT) AS pickup
            FROM lineitem)""",
    "feed": """
        SELECT * FROM once
        UNION ALL
        SELECT * REPLACE (loaded_at + INTERVAL 1 DAY AS loaded_at) FROM once WHERE passenger_count = 2""",
    # Required values that go missing in turn in even months, and optional amounts.
    "damaged": """
        SELECT * EXCLUDE (turn) REPLACE (
            CASE WHEN turn <> 0 THEN tpep_pickup_datetime END AS tpep_pickup_datetime,
            CASE WHEN turn <> 1 THEN tpep_dropoff_datetime END AS tpep_dropoff_datetime,
            CASE WHEN turn <> 2 THEN "PULocationID" END AS "PULocationID",
            CASE WHEN turn <> 3 THEN "DOLocationID" END AS "DOLocationID",
            CASE WHEN turn <> 4 THEN fare_amount END AS fare_amount,
            CASE WHEN turn <> 5 THEN total_amount END AS total_amount,
            CASE WHEN turn <> 6 THEN tip_amount END AS tip_amount,
            CASE WHEN "VendorID" % 2 <> 0 THEN trip_distance / 8 END AS extra,
            CASE WHEN "VendorID" % 3 <> 0 THEN trip_distance * 2 / 8 END AS mta_tax,
            CASE WHEN "VendorID" % 4 <> 0 THEN trip_distance * 3 / 8 END AS tolls_amount,
            CASE WHEN "VendorID" % 5 <> 0 THEN trip_distance * 4 / 8 END AS improvement_surcharge,
            CASE WHEN "VendorID" % 6 <> 0 THEN trip_distance * 5 / 8 END AS congestion_surcharge,
            CASE WHEN "VendorID" % 7 <> 0 THEN trip_distance * 6 / 8 END AS "Airport_fee",
            CASE WHEN "VendorID" % 8 <> 0 THEN trip_distance * 7 / 8 END AS cbd_congestion_fee)
        FROM (SELECT *, CASE WHEN month(source_month) % 2 = 0
            THEN ("PULocationID" * 7 + trip_distance::BIGINT * 3) % 60 ELSE 60 END AS turn FROM sound)""",
    "typed": """
        SELECT md5(concat_ws('|', "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID",
                "DOLocationID", trip_distance, fare_amount, total_amount)) AS trip_id,
            "VendorID"::INT AS vendor_id, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
            passenger_count::INT AS passenger_count, trip_distance AS trip_distance_miles,
            "RatecodeID"::INT AS rate_code_id, store_and_fwd_flag,
            "PULocationID"::INT AS pickup_location_id, "DOLocationID"::INT AS dropoff_location_id,
            payment_type::INT AS payment_type_id, fare_amount::DECIMAL(10,2) AS fare_amount,
            coalesce(extra, 0)::DECIMAL(10,2) AS extra_amount, coalesce(mta_tax, 0)::DECIMAL(10,2) AS mta_tax_amount,
            tip_amount::DECIMAL(10,2) AS tip_amount, coalesce(tolls_amount, 0)::DECIMAL(10,2) AS tolls_amount,
            coalesce(improvement_surcharge, 0)::DECIMAL(10,2) AS improvement_surcharge_amount,
            coalesce(congestion_surcharge, 0)::DECIMAL(10,2) AS congestion_surcharge_amount,
            coalesce("Airport_fee", 0)::DECIMAL(10,2) AS airport_fee_amount,
            coalesce(cbd_congestion_fee, 0)::DECIMAL(10,2) AS cbd_congestion_fee_amount,
            total_amount::DECIMAL(10,2) AS total_amount, source_month, loaded_at
        FROM feed""",
    "staged": """
        SELECT * FROM typed
        WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND pickup_location_id IS NOT NULL
            AND dropoff_location_id IS NOT NULL AND fare_amount IS NOT NULL AND total_amount IS NOT NULL
            AND tip_amount IS NOT NULL AND fare_amount >= 0 AND total_amount >= 0 AND tip_amount >= 0
            AND trip_distance_miles >= 0 AND fare_amount <= 100000 AND total_amount <= 100000
            AND trip_distance_miles <= 48 AND dropoff_ts >= pickup_ts AND dropoff_ts < pickup_ts + INTERVAL 24 HOUR
            AND date_trunc('month', pickup_ts)::DATE = source_month""",
    "zones": """
        SELECT s_suppkey::INT AS location_id, trim('  ' || CASE r_name WHEN 'AMERICA' THEN 'Manhattan'
                ELSE r_name END || ' ') AS borough, trim(s_name || '  ') AS zone,
            trim(CASE r_name WHEN 'EUROPE' THEN 'Airports' WHEN 'ASIA' THEN ' EWR' ELSE 'Boro Zone' END) AS service_zone
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dim": """
        SELECT *, service_zone IN ('Airports', 'EWR') AS is_airport, borough = 'Manhattan' AS is_manhattan FROM zones""",
    # Measures over a relation named in braces.
    "timed": """
        SELECT *, date_diff('second', pickup_ts, dropoff_ts) / 60.0 AS duration_minutes FROM {source}""",
    "measured": """
        SELECT *,
            CASE WHEN duration_minutes >= 1 AND trip_distance_miles > 0
                AND trip_distance_miles / nullif(duration_minutes / 60.0, 0) <= 100
                THEN trip_distance_miles / nullif(duration_minutes / 60.0, 0) END AS avg_speed_mph,
            CASE WHEN payment_type_id = 1 AND fare_amount > 0
                THEN tip_amount * 100.0 / nullif(fare_amount, 0) END AS tip_pct
        FROM timed""",
    "fct": """
        SELECT trip_id, vendor_id, pickup_ts, dropoff_ts, pickup_ts::DATE AS pickup_date,
            extract(hour FROM pickup_ts)::INT AS pickup_hour, isodow(pickup_ts)::INT AS pickup_day_of_week,
            isodow(pickup_ts) IN (6, 7) AS is_weekend, pickup_location_id, dropoff_location_id, passenger_count,
            trip_distance_miles, duration_minutes, avg_speed_mph, payment_type_id,
            CASE payment_type_id WHEN 0 THEN 'Flex fare' WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
                WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
                ELSE 'Other' END AS payment_type_name,
            fare_amount, tip_amount, tolls_amount, total_amount, tip_pct, source_month
        FROM (SELECT * FROM measured QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY loaded_at DESC,
            vendor_id DESC, passenger_count DESC NULLS LAST, payment_type_id DESC, tip_amount DESC) = 1)""",
    "daily": """
        SELECT pickup_date, count(*) AS trip_count, sum(total_amount) AS total_revenue,
            sum(fare_amount) AS fare_revenue, sum(tip_amount) AS tip_revenue, avg(fare_amount) AS avg_fare,
            avg(trip_distance_miles) AS avg_trip_distance_miles, avg(tip_pct) AS avg_tip_pct,
            {weighted} AS weighted_tip_pct
        FROM fct GROUP BY pickup_date""",
    "hourly": """
        SELECT pickup_hour, count(*) AS trip_count, count(DISTINCT pickup_date) AS days_observed,
            count(*) / nullif(count(DISTINCT pickup_date), 0) AS avg_trips_per_day, avg(fare_amount) AS avg_fare,
            avg(tip_pct) AS avg_tip_pct, {weighted} AS weighted_tip_pct, avg(avg_speed_mph) AS avg_speed_mph
        FROM fct GROUP BY pickup_hour""",
    "by_zone": """
        SELECT pickup_location_id AS location_id, count(*) AS trip_count, sum(total_amount) AS total_revenue,
            avg(fare_amount) AS avg_fare, avg(trip_distance_miles) AS avg_trip_distance_miles,
            avg(duration_minutes) AS avg_duration_minutes, avg(tip_pct) AS avg_tip_pct,
            {weighted} AS weighted_tip_pct
        FROM fct GROUP BY pickup_location_id""",
    "board": """
        SELECT location_id, borough, zone, trip_count, total_revenue, avg_fare, avg_trip_distance_miles,
            avg_duration_minutes, avg_tip_pct, weighted_tip_pct,
            rank() OVER (ORDER BY trip_count DESC) AS trip_count_rank,
            round(100.0 * trip_count / sum(trip_count) OVER (), 3) AS pct_of_all_trips
        FROM by_zone JOIN dim USING (location_id)""",
    "corrections": """
        SELECT unnest([trip_id, 'new-' || trip_id]) AS trip_id,
            * EXCLUDE (trip_id) REPLACE ((tip_amount + 1)::DECIMAL(10,2) AS tip_amount)
        FROM fct WHERE payment_type_name = 'Dispute'""",
}

_WEIGHTED = (
    "100.0 * (sum(tip_amount) FILTER (WHERE tip_pct IS NOT NULL)"
    " / nullif(sum(fare_amount) FILTER (WHERE tip_pct IS NOT NULL), 0))"
)

_FEED = ["once", "feed"]
_STAGED = [*_FEED, "typed", "staged"]
_MEASURED = [*_STAGED, "timed", "measured"]
_FACT = [*_MEASURED, "fct"]
# A step may stand under another name.
_DAMAGED = ["once", "sound=feed", "feed=damaged"]
_DAMAGED_FACT = [*_DAMAGED, *_FACT[2:]]
_BOARD = [*_FACT, "zones", "dim", "by_zone", "board"]

_DAILY_ROUNDED = """
    SELECT pickup_date, trip_count, total_revenue, fare_revenue, tip_revenue, round(avg_fare, 6) AS avg_fare,
        round(avg_trip_distance_miles, 6) AS avg_trip_distance_miles, round(avg_tip_pct, 6) AS avg_tip_pct,
        round(weighted_tip_pct, 6) AS weighted_tip_pct
    FROM daily"""

_FACT_ROUNDED = (
    "* REPLACE (round(trip_distance_miles, 6) AS trip_distance_miles, round(duration_minutes, 6) AS duration_minutes,"
    " round(avg_speed_mph, 6) AS avg_speed_mph, round(tip_pct, 6) AS tip_pct)"
)

_BOARD_ROUNDED = """
    SELECT location_id, borough, zone, trip_count, total_revenue, round(avg_fare, 6) AS avg_fare,
        round(avg_trip_distance_miles, 6) AS avg_trip_distance_miles,
        round(avg_duration_minutes, 6) AS avg_duration_minutes, round(avg_tip_pct, 6) AS avg_tip_pct,
        round(weighted_tip_pct, 6) AS weighted_tip_pct, trip_count_rank, pct_of_all_trips
    FROM board"""

_MONTH_TOTALS = """
    SELECT source_month, count(*) AS trips, sum(round(fare_amount * 100))::BIGINT AS fare_cents,
        count(passenger_count) AS with_passengers
    FROM {source} GROUP BY source_month"""


def _sql(steps: list[str], final: str, source: str = "staged") -> str:
    pairs = ((s.partition("=")[0], s.rpartition("=")[2]) for s in steps)
    named = (f"{name} AS ({_STEPS[s].format(source=source, weighted=_WEIGHTED)})" for name, s in pairs)
    return f"WITH {', '.join(named)} {final}" if steps else final


def _history(final: str) -> str:
    """Three snapshots of the zones, written out as the spells during which a key kept its values."""
    renamed = """
        SELECT CASE WHEN location_id % 13 = {v} THEN location_id + 1000000 * {v} ELSE location_id END::INT AS location_id,
            borough, CASE WHEN location_id % 5 = {v} THEN zone || ' v{v}' ELSE zone END AS zone,
            CASE WHEN location_id % 7 < 2 THEN NULL ELSE service_zone END AS service_zone
        FROM zones WHERE location_id % 11 <> {v}"""
    return _sql(
        ["zones"],
        f""", seen AS (
            SELECT *, TIMESTAMP '2025-01-01' AS seen_at FROM zones
            UNION ALL SELECT *, TIMESTAMP '2025-02-01' FROM ({renamed.format(v=1)})
            UNION ALL SELECT *, TIMESTAMP '2025-03-01' FROM ({renamed.format(v=2)})),
        starts AS (
            SELECT * EXCLUDE (before, first) FROM (
                SELECT *, lag((borough, zone, service_zone)) OVER (PARTITION BY location_id ORDER BY seen_at) AS before,
                    row_number() OVER (PARTITION BY location_id ORDER BY seen_at) = 1 AS first
                FROM seen)
            WHERE first OR (borough, zone, service_zone) IS DISTINCT FROM before),
        history AS (
            SELECT location_id, borough, zone, service_zone, md5(concat_ws('|', location_id, seen_at)) AS dbt_scd_id,
                seen_at AS dbt_updated_at, seen_at AS dbt_valid_from,
                lead(seen_at) OVER (PARTITION BY location_id ORDER BY seen_at) AS dbt_valid_to
            FROM starts)
        {final}""",
    )


def _findings() -> str:
    """Counts of each month and test, written as one UNION of small aggregates."""
    label = "'Flex fare', 'Credit card', 'Cash', 'No charge', 'Dispute', 'Unknown', 'Voided trip'"
    ends = ("pickup_location_id", "dropoff_location_id")

    def missing(*columns: str) -> dict[str, str]:
        return {f"not_null[{c}]": f"{c} IS NULL" for c in columns}

    offenders = {
        ("measured", "stg_trips"): missing("trip_id", "pickup_ts", "dropoff_ts", *ends)
        | {
            "accepted_values[vendor_id]": "vendor_id NOT IN (1, 2, 6, 7)",
            "accepted_values[payment_type_id]": "payment_type_id NOT IN (0, 1, 2, 3)",
            "range[fare_amount]": "fare_amount NOT BETWEEN 0 AND 100000",
            "range[total_amount]": "total_amount NOT BETWEEN 0 AND 100000",
        },
        ("measured", "int_trips"): missing("trip_id")
        | {
            "range[duration_minutes]": "duration_minutes NOT BETWEEN 0 AND 1440",
            "range[avg_speed_mph]": "avg_speed_mph NOT BETWEEN 0 AND 100",
            "range[tip_pct]": "tip_pct < 0",
        },
        ("fct", "fct_trips"): missing("trip_id", "pickup_ts", "dropoff_ts", "pickup_date", "pickup_hour", *ends)
        | {
            "range[pickup_hour]": "pickup_hour NOT BETWEEN 0 AND 23",
            "accepted_values[pickup_day_of_week]": "pickup_day_of_week NOT BETWEEN 1 AND 7",
            "accepted_values[payment_type_name]": f"payment_type_name NOT IN ({label})",
            "no_negative_fares": "fare_amount < 0 OR total_amount < 0 OR tip_amount < 0",
            "dropoff_not_before_pickup": "dropoff_ts < pickup_ts",
            "trip_duration_under_24h": "duration_minutes >= 1440 OR duration_minutes < 0",
        },
    }
    watched = (
        "tpep_pickup_datetime tpep_dropoff_datetime PULocationID DOLocationID fare_amount total_amount"
        " passenger_count RatecodeID congestion_surcharge Airport_fee"
    ).split()
    row = "SELECT '{kind}' AS kind, '{key}' AS key, {value} AS value, {n} AS n, {amount} AS amount, source_month FROM {source} GROUP BY ALL"
    none = {"value": "NULL::VARCHAR", "amount": "NULL::DECIMAL(38,2)"}
    parts = [
        row.format(kind="offenders", key=f"{t}.{name}", n=f"count(*) FILTER (WHERE {test})", source=source, **none)
        for (source, t), tests in offenders.items()
        for name, test in tests.items()
    ]
    parts += [row.format(kind="nulls", key=c, n=f'count(*) FILTER (WHERE "{c}" IS NULL)', source="feed", **none) for c in watched]
    parts += [row.format(kind="rows", key=k, n="count(*)", source=s, **none) for k, s in (("raw_trips", "feed"), ("fct_trips", "fct"))]
    own_month = "count(*) FILTER (WHERE date_trunc('month', pickup_date) = source_month)"
    parts.append(row.format(kind="rows", key="fct_in_month", n=own_month, source="fct", **none))
    parts += [
        row.format(kind="ids", key=f"{t}.{c}", value=f"{c}::VARCHAR", n="count(*)", amount=none["amount"], source=s)
        for s, t in (("staged", "stg_trips"), ("fct", "fct_trips"))
        for c in ends
    ]
    revenue = "sum(total_amount)::DECIMAL(38,2)"
    parts.append(row.format(kind="days", key="fct_trips", value="pickup_date::VARCHAR", n="count(*)", amount=revenue, source="fct"))
    return " UNION ALL ".join(parts)


def all_sql() -> dict[str, str]:
    null_columns = ", ".join(
        f"NULL::{dtype} AS \"{name}\""
        for name, dtype in {
            "tpep_dropoff_datetime": "TIMESTAMP",
            "trip_distance": "DOUBLE",
            "RatecodeID": "BIGINT",
            "PULocationID": "BIGINT",
            "DOLocationID": "BIGINT",
            "payment_type": "BIGINT",
            "extra": "DOUBLE",
            "mta_tax": "DOUBLE",
            "tip_amount": "DOUBLE",
            "tolls_amount": "DOUBLE",
            "improvement_surcharge": "DOUBLE",
            "total_amount": "DOUBLE",
            "congestion_surcharge": "DOUBLE",
            "cbd_congestion_fee": "DOUBLE",
        }.items()
    )
    watched = (
        "tpep_pickup_datetime tpep_dropoff_datetime PULocationID DOLocationID fare_amount total_amount"
        " passenger_count RatecodeID congestion_surcharge Airport_fee"
    ).split()
    critical = watched[:6]
    rates = ", ".join(
        f'round(count(*) FILTER (WHERE "{c}" IS NULL) / count(*), 6) AS "{c}"' for c in watched
    )
    null_verdicts = " ".join(
        f"""UNION ALL SELECT month, 'null_rate[{c}]', "{c}" <= 0.01,
            printf('%.4f%%', 100 * "{c}") || ' null (limit 1.00%)' FROM counted"""
        for c in critical
    )
    critical_rates = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) / count(*) AS "{c}"' for c in critical)

    def grouped(number: str) -> str:
        return f"format('{{:,}}', {number})"

    extremes = """
        SELECT extreme, pickup_date, days, round(revenue, 6) AS revenue_musd FROM (
            (SELECT 'peak' AS extreme, pickup_date, NULL::BIGINT AS days, total_revenue::DOUBLE / 1e6 AS revenue
             FROM daily ORDER BY total_revenue DESC, pickup_date LIMIT 1)
            UNION ALL
            (SELECT 'low', pickup_date, NULL, total_revenue::DOUBLE / 1e6 FROM daily
             ORDER BY total_revenue, pickup_date LIMIT 1)
            UNION ALL
            (SELECT 'all', NULL, count(*), sum(total_revenue)::DOUBLE / 1e6 FROM daily))"""

    verdicts = f""", counted AS (
                SELECT strftime(source_month, '%Y-%m') AS month, raw_rows, coalesce(fct_rows, 0) AS fct_rows,
                    * EXCLUDE (source_month, raw_rows, fct_rows)
                FROM (SELECT source_month, count(*) AS raw_rows, {critical_rates} FROM feed GROUP BY source_month)
                LEFT JOIN (SELECT date_trunc('month', pickup_date)::DATE AS source_month, count(*) AS fct_rows
                    FROM fct GROUP BY 1) USING (source_month))
            SELECT month, 'raw_row_count' AS name, raw_rows >= 300 AS passed,
                {grouped('raw_rows')} || ' rows (minimum 300)' AS detail FROM counted
            {null_verdicts}
            UNION ALL SELECT month, 'fct_trips_retention', fct_rows > 0 AND fct_rows / raw_rows >= 0.65,
                {grouped('fct_rows')} || ' of ' || {grouped('raw_rows')} || ' raw rows survived cleaning ('
                || printf('%.2f%%', 100 * fct_rows / raw_rows) || ', minimum 65%)' FROM counted"""

    counted, verdict = verdicts.split("SELECT month, 'raw_row_count'")
    # Months before the first with a failed check or a zone that the lookup lacks.
    audited = f"""{counted}, verdict AS (SELECT month, 'raw_row_count'{verdict}),
        lost AS (SELECT strftime(source_month, '%Y-%m') AS month FROM staged
            WHERE pickup_location_id NOT IN (SELECT location_id FROM zones)
                OR dropoff_location_id NOT IN (SELECT location_id FROM zones)),
        bad AS (SELECT coalesce(min(month), '9') AS month
            FROM (SELECT month FROM verdict WHERE NOT passed UNION ALL SELECT month FROM lost)),
        good AS (SELECT DISTINCT source_month FROM feed WHERE strftime(source_month, '%Y-%m') < (SELECT month FROM bad))
        SELECT source_month, raw_rows, trips::HUGEINT::BIGINT AS trips
        FROM (SELECT source_month, count(*) AS raw_rows FROM feed GROUP BY source_month) JOIN good USING (source_month)
        LEFT JOIN (SELECT date_trunc('month', pickup_date)::DATE AS source_month, count(*) AS trips FROM fct GROUP BY 1)
            USING (source_month)"""

    return {
        "align_case_and_missing": f"""
            SELECT o_orderkey AS "VendorID", o_orderdate AS tpep_pickup_datetime,
                (o_custkey + 0.5::DOUBLE)::BIGINT AS passenger_count, o_orderstatus AS store_and_fwd_flag,
                o_totalprice AS fare_amount, o_totalprice AS "Airport_fee", {null_columns}
            FROM orders""",
        "load_month_replace": _sql(_FEED, "SELECT * REPLACE (TIMESTAMP '2025-01-01' AS loaded_at) FROM feed"),
        "load_month_rerun": _sql(_FEED, _MONTH_TOTALS.format(source="feed")),
        "load_other_month_untouched": _sql(
            _FEED,
            _MONTH_TOTALS.format(
                source="(SELECT * FROM feed WHERE year(source_month) <> 1998"
                " UNION ALL SELECT * FROM once WHERE year(source_month) = 1998)"
            ),
        ),
        "arrival_ingest": _sql(
            _FEED,
            _MONTH_TOTALS.format(
                source="(SELECT * FROM feed WHERE year(source_month) <> 1998"
                " UNION ALL SELECT * FROM once WHERE year(source_month) = 1998)"
            ),
        ),
        "load_named_months": _sql(
            _FEED, "SELECT strftime(source_month, '%Y-%m') AS month, count(*) AS rows FROM feed GROUP BY source_month"
        ),
        "stage_zones_csv": _sql(["zones"], "SELECT * FROM zones"),
        "snapshot_read": _sql(
            _FACT,
            """SELECT seen, payment_type_name, count(*) AS trips FROM fct, (VALUES ('first'), ('last')) t(seen)
               WHERE seen = 'first' OR payment_type_name NOT IN ('Cash', 'Dispute') GROUP BY ALL""",
        ),
        "upsert_fact": _sql(
            [*_FACT, "corrections"],
            f"""SELECT {_FACT_ROUNDED} FROM (
                SELECT * FROM fct ANTI JOIN corrections USING (trip_id)
                UNION ALL BY NAME SELECT * FROM corrections)""",
        ),
        "append_new_columns": _sql(
            [*_FACT, "corrections"],
            """SELECT trip_id, passenger_count, tip_amount, source_month, NULL::VARCHAR AS corrected_by
               FROM fct ANTI JOIN corrections USING (trip_id)
               UNION ALL SELECT trip_id, NULL::INT, tip_amount, source_month, 'desk' FROM corrections""",
        ),
        "mart_table_rebuild": _sql([*_FACT, "daily"], _DAILY_ROUNDED),
        "stage_trips": _sql(_STAGED, "SELECT * FROM staged"),
        "drop_counts_by_rule": _sql(
            [*_FEED, "typed", "staged"],
            """SELECT count(*) AS rows,
                count(*) FILTER (WHERE pickup_ts IS NULL OR dropoff_ts IS NULL OR pickup_location_id IS NULL
                    OR dropoff_location_id IS NULL OR fare_amount IS NULL OR total_amount IS NULL
                    OR tip_amount IS NULL) AS required,
                count(*) FILTER (WHERE fare_amount < 0 OR total_amount < 0 OR tip_amount < 0
                    OR trip_distance_miles < 0) AS not_negative,
                count(*) FILTER (WHERE fare_amount > 100000) AS fare_cap,
                count(*) FILTER (WHERE total_amount > 100000) AS total_cap,
                count(*) FILTER (WHERE trip_distance_miles > 48) AS distance_cap,
                count(*) FILTER (WHERE dropoff_ts < pickup_ts) AS time_order,
                count(*) FILTER (WHERE dropoff_ts >= pickup_ts + INTERVAL 24 HOUR) AS under_24h,
                count(*) FILTER (WHERE date_trunc('month', pickup_ts)::DATE <> source_month) AS own_month,
                (SELECT count(*) FROM staged) AS kept
            FROM typed""",
        ),
        "stage_damaged": _sql([*_DAMAGED, "typed", "staged"], "SELECT * FROM staged"),
        "drop_counts_damaged": _sql(
            [*_DAMAGED, "typed", "staged"],
            """SELECT count(*) AS rows,
                count(*) FILTER (WHERE pickup_ts IS NULL OR dropoff_ts IS NULL OR pickup_location_id IS NULL
                    OR dropoff_location_id IS NULL OR fare_amount IS NULL OR total_amount IS NULL
                    OR tip_amount IS NULL) AS required,
                count(*) FILTER (WHERE (least(fare_amount, total_amount, tip_amount) >= 0 AND trip_distance_miles >= 0)
                    IS NOT TRUE) AS not_negative,
                count(*) FILTER (WHERE (fare_amount <= 100000) IS NOT TRUE) AS fare_cap,
                count(*) FILTER (WHERE (total_amount <= 100000) IS NOT TRUE) AS total_cap,
                count(*) FILTER (WHERE (trip_distance_miles <= 48) IS NOT TRUE) AS distance_cap,
                count(*) FILTER (WHERE (dropoff_ts >= pickup_ts) IS NOT TRUE) AS time_order,
                count(*) FILTER (WHERE (dropoff_ts < pickup_ts + INTERVAL 24 HOUR) IS NOT TRUE) AS under_24h,
                count(*) FILTER (WHERE (date_trunc('month', pickup_ts)::DATE = source_month) IS NOT TRUE) AS own_month,
                (SELECT count(*) FROM staged) AS kept
            FROM typed""",
        ),
        "trip_key_md5": _sql([*_FEED, "typed"], "SELECT trip_id, count(*) AS copies FROM typed GROUP BY trip_id"),
        "number_texts": """
            SELECT l_orderkey, l_linenumber,
                (l_extendedprice * ('1e' || (l_orderkey % 17 - 6)::INT)::DOUBLE)::VARCHAR AS amount
            FROM lineitem""",
        "money_rounding": """
            SELECT l_orderkey, (l_orderkey / 1000.0::DOUBLE
                * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END)::DECIMAL(10,2) AS amount
            FROM lineitem""",
        "stage_zones": _sql(["zones"], "SELECT * FROM zones"),
        "dim_zones": _sql(["zones", "dim"], "SELECT * FROM dim"),
        "enrich_trips": _sql(
            [*_MEASURED, "zones"],
            """SELECT m.* REPLACE (round(trip_distance_miles, 6) AS trip_distance_miles,
                    round(duration_minutes, 6) AS duration_minutes, round(avg_speed_mph, 6) AS avg_speed_mph,
                    round(tip_pct, 6) AS tip_pct),
                p.borough AS pickup_borough, p.zone AS pickup_zone, d.borough AS dropoff_borough, d.zone AS dropoff_zone
            FROM measured m LEFT JOIN zones p ON pickup_location_id = p.location_id
            LEFT JOIN zones d ON dropoff_location_id = d.location_id""",
        ),
        "duration_subsecond": """
            SELECT a.event_id, round(date_diff('second', a.ts, b.ts) / 60.0, 6) AS duration_minutes
            FROM events a JOIN events b ON b.event_id = a.event_id + 1""",
        "speed_mph": _sql(
            _MEASURED, "SELECT trip_id, loaded_at, round(avg_speed_mph, 6) AS avg_speed_mph FROM measured"
        ),
        "tip_pct": _sql(_MEASURED, "SELECT trip_id, loaded_at, round(tip_pct, 6) AS tip_pct FROM measured"),
        "calendar_parts": """
            SELECT event_id, ts::DATE AS day, extract(hour FROM ts)::INT AS hour, isodow(ts)::INT AS weekday,
                isodow(ts) IN (6, 7) AS is_weekend, date_trunc('month', ts)::DATE AS month
            FROM events""",
        "payment_labels": """
            SELECT code, CASE code WHEN 0 THEN 'Flex fare' WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
                WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
                ELSE 'Other' END AS label, count(*) AS trips
            FROM (SELECT nullif(l_linenumber + l_quantity::INT % 3, 9) AS code FROM lineitem) GROUP BY code, label""",
        "dedup_latest": """
            SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                    l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
        "fct_trips": _sql(_FACT, f"SELECT {_FACT_ROUNDED} FROM fct"),
        "incremental_window": _sql(
            _FACT,
            f"""SELECT {_FACT_ROUNDED} FROM fct WHERE pickup_ts < DATE '1998-01-01'
                OR pickup_ts >= DATE '1999-03-10' AND pickup_ts < DATE '2000-02-05'""",
        ),
        "incremental_lookback": _sql(
            _FACT,
            """SELECT trip_id, pickup_ts, CASE WHEN pickup_ts >= (SELECT max(pickup_date) FROM fct
                    WHERE pickup_ts < DATE '2000-01-01') - INTERVAL 3 DAY
                    THEN passenger_count + 1 ELSE passenger_count END AS passenger_count, source_month
               FROM fct""",
        ),
        "mart_daily_revenue": _sql([*_FACT, "daily"], _DAILY_ROUNDED),
        "mart_hourly_demand": _sql(
            [*_FACT, "hourly"],
            """SELECT pickup_hour, trip_count, days_observed, round(avg_trips_per_day, 6) AS avg_trips_per_day,
                round(avg_fare, 6) AS avg_fare, round(avg_tip_pct, 6) AS avg_tip_pct,
                round(weighted_tip_pct, 6) AS weighted_tip_pct, round(avg_speed_mph, 6) AS avg_speed_mph
            FROM hourly""",
        ),
        "mart_zone_performance": _sql(_BOARD, _BOARD_ROUNDED),
        "mart_zone_performance_many_zones": _sql(_BOARD, _BOARD_ROUNDED),
        "weighted_tip_overall": _sql(
            _FACT, f"SELECT round(avg(tip_pct), 6) AS avg_tip_pct, round({_WEIGHTED}, 6) AS weighted_tip_pct FROM fct"
        ),
        "check_not_null": _sql(
            [*_FEED, "typed"], "SELECT trip_id, payment_type_id, loaded_at FROM typed WHERE passenger_count IS NULL"
        ),
        "check_unique": _sql(
            [*_FEED, "typed"],
            "SELECT trip_id, count(*) AS n_records FROM typed WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1",
        ),
        "check_accepted_values": _sql(
            [*_FEED, "typed"], "SELECT trip_id, vendor_id, loaded_at FROM typed WHERE vendor_id NOT IN (1, 2, 6, 7)"
        ),
        "check_relationships": _sql(
            [*_FEED, "typed", "zones"],
            """SELECT dropoff_location_id, count(*) AS n_records FROM typed
               WHERE dropoff_location_id NOT IN (SELECT location_id FROM zones WHERE borough <> 'AFRICA')
               GROUP BY dropoff_location_id""",
        ),
        "check_range": _sql(
            [*_FEED, "typed", "timed", "measured"],
            """SELECT count(*) FILTER (WHERE duration_minutes NOT BETWEEN 0 AND 1440) AS duration,
                count(*) FILTER (WHERE duration_minutes <= 0 OR duration_minutes >= 1440) AS duration_exclusive,
                count(*) FILTER (WHERE fare_amount NOT BETWEEN 0 AND 100000) AS fare,
                count(*) FILTER (WHERE avg_speed_mph > 50) AS speed, count(*) FILTER (WHERE tip_pct < 0) AS tip
            FROM measured""",
            source="typed",
        ),
        "check_row_count": _sql(_FEED, "SELECT count(*) AS trips, count(*) >= 1 AS passed FROM feed"),
        "check_negative": _sql(
            [*_FEED, "typed"],
            """SELECT trip_id, fare_amount, total_amount, tip_amount FROM typed
               WHERE fare_amount < 0 OR total_amount < 0 OR tip_amount < 0""",
        ),
        "check_time_order": _sql(
            [*_FEED, "typed"], "SELECT trip_id, pickup_ts, dropoff_ts FROM typed WHERE dropoff_ts < pickup_ts"
        ),
        "check_duration": _sql(
            [*_FEED, "typed", "timed"],
            """SELECT trip_id, pickup_ts, dropoff_ts, round(duration_minutes, 6) AS duration_minutes FROM timed
               WHERE duration_minutes >= 1440 OR duration_minutes < 0""",
            source="typed",
        ),
        "reconcile_daily": _sql(
            [*_FACT, "daily"],
            """, changed AS (
                SELECT CASE pickup_date WHEN DATE '1998-06-10' THEN DATE '2030-01-01' ELSE pickup_date END AS pickup_date,
                    total_amount + CASE WHEN isodow(pickup_date) = 7 THEN 1 ELSE 0 END AS total_amount
                FROM fct WHERE isodow(pickup_date) <> 1),
            f AS (SELECT pickup_date, count(*) AS trips, sum(total_amount)::DECIMAL(38,2) AS revenue
                FROM changed GROUP BY pickup_date)
            SELECT coalesce(f.pickup_date, m.pickup_date) AS pickup_date, f.trips AS fct_trips,
                m.trip_count AS mart_trips, f.revenue AS fct_revenue, m.total_revenue AS mart_revenue
            FROM f FULL OUTER JOIN daily m ON f.pickup_date = m.pickup_date
            WHERE f.pickup_date IS NULL OR m.pickup_date IS NULL OR f.trips <> m.trip_count
                OR abs(f.revenue - m.total_revenue) > 0.01""",
        ),
        "reconcile_zone_total": _sql(
            [*_FACT, "zones", "dim", "by_zone"],
            """SELECT * FROM (SELECT (SELECT count(*) FROM fct) AS fct_trips, (SELECT sum(trip_count)::BIGINT
                FROM by_zone JOIN dim USING (location_id) WHERE borough <> 'ASIA') AS zone_trips)
               WHERE fct_trips <> zone_trips""",
        ),
        "null_rates": _sql(_FEED, f"SELECT source_month, {rates} FROM feed GROUP BY source_month"),
        "delivery_checks": _sql(_FACT, verdicts),
        "delivery_checks_damaged": _sql(_DAMAGED_FACT, verdicts),
        "findings_by_month": _sql(_DAMAGED_FACT, _findings()),
        "scd2_apply": _history("SELECT * FROM history"),
        "scd2_as_of": _history(
            """SELECT location_id, borough, zone, service_zone FROM history
               WHERE dbt_valid_from <= TIMESTAMP '2025-02-15'
                   AND (dbt_valid_to IS NULL OR TIMESTAMP '2025-02-15' < dbt_valid_to)"""
        ),
        "report_daily_series": _sql(
            [*_FACT, "daily"], "SELECT pickup_date, round(total_revenue::DOUBLE / 1e6, 6) AS revenue_musd FROM daily"
        ),
        "report_extremes": _sql([*_FACT, "daily"], extremes),
        "report_top10": _sql(
            _BOARD,
            """SELECT zone || ' (' || borough || ')' AS label, trip_count, trip_count / 1e3 AS trips_thousand
               FROM board ORDER BY trip_count DESC, location_id LIMIT 10""",
        ),
        "report_tip_by_hour": _sql(
            [*_FACT, "hourly"],
            """SELECT pickup_hour, round(weighted_tip_pct, 6) AS weighted_tip_pct,
                CASE pickup_hour
                    WHEN (SELECT pickup_hour FROM hourly ORDER BY weighted_tip_pct DESC NULLS LAST, pickup_hour LIMIT 1)
                        THEN 'highest'
                    WHEN (SELECT pickup_hour FROM hourly ORDER BY weighted_tip_pct NULLS LAST, pickup_hour LIMIT 1)
                        THEN 'lowest' END AS extreme
            FROM hourly""",
        ),
        "sample_files": """
            SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER () - 1 AS place FROM lineitem)
            ORDER BY md5('42||' || place), place LIMIT 500""",
        "sample_fixed": "SELECT * FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 200",
        "audited_catch_up": _sql([*_FACT, "zones"], audited),
        "run_months_state": _sql(
            _FACT,
            """SELECT source_month, raw_rows, trips, revenue
            FROM (SELECT source_month, count(*) AS raw_rows FROM feed GROUP BY source_month)
            FULL JOIN (SELECT date_trunc('month', pickup_date)::DATE AS source_month, count(*) AS trips,
                sum(total_amount) AS revenue FROM fct GROUP BY 1) USING (source_month)""",
        ),
    }

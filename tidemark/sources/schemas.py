"""Explicit input schemas, as DDL text that every reader accepts."""

from __future__ import annotations

TRANSACTIONS = """transaction_id BIGINT, tx_datetime TIMESTAMP_NTZ, customer_id BIGINT, terminal_id BIGINT,
       tx_amount DOUBLE, tx_time_seconds BIGINT, tx_time_days BIGINT, tx_fraud BIGINT,
       tx_fraud_scenario BIGINT"""

TRIPS = """tripduration BIGINT, starttime TIMESTAMP_NTZ, stoptime TIMESTAMP_NTZ,
       start_station_id BIGINT, end_station_id BIGINT, bikeid BIGINT, usertype STRING,
       birth_year BIGINT, gender BIGINT"""

WEATHER = """state STRING, observation_date DATE, day_of_year DECIMAL(3,0), temp_min_f DECIMAL(5,1),
       temp_max_f DECIMAL(5,1), temp_avg_f DECIMAL(5,1), temp_min_c DOUBLE, temp_max_c DOUBLE,
       temp_avg_c DOUBLE, tot_precip_in DECIMAL(4,2), tot_snowfall_in DECIMAL(4,2),
       tot_snowdepth_in DECIMAL(4,1), tot_precip_mm DECIMAL(8,1), tot_snowfall_mm DECIMAL(8,1),
       tot_snowdepth_mm DECIMAL(8,1)"""

BOOKINGS = "id INT, booking_reference BIGINT, hotel STRING, booking_date DATE, cost INT"

CUSTOMERS = "id INT, first_name STRING, last_name STRING, birthdate DATE, membership_no INT"

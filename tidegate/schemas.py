"""Table layouts and fixed values of the two datasets and the metadata tables.

Layouts are ``{column: type}`` in column order.
"""

from __future__ import annotations

# Column names and types of the landed tables.
TRIP_COLUMNS = {
    "vendor_id": "smallint",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "passenger_count": "smallint",
    "trip_distance": "decimal(8,2)",
    "pickup_longitude": "decimal(11,6)",
    "pickup_latitude": "decimal(11,6)",
    "rate_code_id": "smallint",
    "store_and_fwd_flag": "string",
    "dropoff_longitude": "decimal(11,6)",
    "dropoff_latitude": "decimal(11,6)",
    "payment_type": "smallint",
    "fare_amount": "decimal(8,2)",
    "extra": "decimal(8,2)",
    "mta_tax": "decimal(8,2)",
    "tip_amount": "decimal(8,2)",
    "tolls_amount": "decimal(8,2)",
    "total_amount": "decimal(8,2)",
}
TRIP_TABLE = {"id": "bigint", **TRIP_COLUMNS, "source_row_hash": "string", "loaded_at": "timestamp"}
TRIP_RENAMES = {"rate_code": "rate_code_id"}

PASSENGER_COLUMNS = {
    "passenger_id": "int",
    "survived": "smallint",
    "pclass": "smallint",
    "name": "string",
    "sex": "string",
    "age": "decimal(5,2)",
    "sib_sp": "smallint",
    "parch": "smallint",
    "ticket": "string",
    "fare": "decimal(10,4)",
    "cabin": "string",
    "embarked": "string",
}
PASSENGER_TABLE = {"id": "bigint", **PASSENGER_COLUMNS, "loaded_at": "timestamp"}
PASSENGER_RENAMES = {
    "PassengerId": "passenger_id",
    "Survived": "survived",
    "Pclass": "pclass",
    "Name": "name",
    "Sex": "sex",
    "Age": "age",
    "SibSp": "sib_sp",
    "Parch": "parch",
    "Ticket": "ticket",
    "Fare": "fare",
    "Cabin": "cabin",
    "Embarked": "embarked",
}

RUN_COLUMNS = {
    "dag_id": "string",
    "task_id": "string",
    "run_id": "string",
    "status": "string",
    "started_at": "timestamp",
    "ended_at": "timestamp",
    "duration_seconds": "decimal(12,3)",
    "rows_ingested": "bigint",
    "error_message": "string",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}
RUN_KEY = ["dag_id", "task_id", "run_id"]

WATERMARK_COLUMNS = {
    "dataset_name": "string",
    "source_schema": "string",
    "source_table": "string",
    "watermark_column": "string",
    "watermark_value": "timestamp",
    "last_successful_run": "string",
    "last_rows_loaded": "bigint",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}

EVENT_TYPE = "trip_completed"
EVENT_ENVELOPE = {"event_type": "string", "event_time": "string"}
EVENT_PAYLOAD = {
    "vendor_id": "smallint",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "passenger_count": "smallint",
    "trip_distance": "decimal(8,2)",
    "fare_amount": "decimal(8,2)",
    "tip_amount": "decimal(8,2)",
    "total_amount": "decimal(8,2)",
}
EVENT_REQUIRED = ["event_type", "event_time", "pickup_datetime"]
EVENT_POSITIVE = ["fare_amount", "trip_distance", "total_amount"]
PASSENGERS_MIN, PASSENGERS_MAX = 1, 6

# Cleaning rules, one SQL predicate per column.
TRIP_RULES = {
    "fare_amount": "fare_amount > 0",
    "trip_distance": "trip_distance > 0",
    "passenger_count": "passenger_count BETWEEN 1 AND 6",
}

# Code labels.
VENDOR_NAMES = {1: "Creative Mobile Technologies", 2: "VeriFone Inc"}
RATE_TYPES = {
    1: "Standard Rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated Fare",
    6: "Group Ride",
}
PAYMENT_METHODS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
CLASS_NAMES = {1: "First", 2: "Second", 3: "Third"}
PORT_NAMES = {"C": "Cherbourg", "Q": "Queenstown", "S": "Southampton"}

# Coordinate box (longitude low, high, latitude low, high).
CITY_BOX = ("-74.3", "-73.7", "40.5", "40.9")

# End of an open version.
OPEN_END = "9999-12-31 23:59:59.999999"


def ddl(columns: dict[str, str]) -> str:
    """The layout as a schema string for readers."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())

"""Table layouts: raw records, feature table, dimensions, fact table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The layout of the raw incident record, every column a nullable string.
RAW_COLUMNS = (
    "School_Year",
    "Busbreakdown_ID",
    "Run_Type",
    "Bus_No",
    "Route_Number",
    "Reason",
    "Schools_Serviced",
    "Occurred_On",
    "Created_On",
    "Boro",
    "Bus_Company_Name",
    "How_Long_Delayed",
    "Number_Of_Students_On_The_Bus",
    "Has_Contractor_Notified_Schools",
    "Has_Contractor_Notified_Parents",
    "Have_You_Alerted_OPT",
    "Informed_On",
    "Incident_Number",
    "Last_Updated_On",
    "Breakdown_or_Running_Late",
    "School_Age_or_PreK",
)
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in RAW_COLUMNS])

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def struct_of(columns: str) -> T.StructType:
    """Schema from "name type, name type, …" without needing a session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


# Names, order and types of the analysis table.
FEATURE_DDL = """
    busbreakdown_id bigint, school_year string, year int, month int, day_of_week int, hour int,
    time_band string, season string, is_weekend int, operator string, operator_id bigint,
    boro string, boro_id bigint, run_type string, reason string, reason_id bigint,
    school_age string, students_on_bus int, notified_schools int, notified_parents int,
    alerted_opt int, delay_minutes double, on_time int, incident_type string,
    is_breakdown int, occurred_ts timestamp
"""
FEATURE_SCHEMA = struct_of(FEATURE_DDL)
FEATURE_COLUMNS = tuple(FEATURE_SCHEMA.fieldNames())

# Surrogate key column of each single-column dimension, and what identifies a calendar row.
DIMENSION_IDS = {"operator": "operator_id", "reason": "reason_id", "boro": "boro_id"}
CALENDAR_KEY = ("year", "month", "day_of_week", "season", "is_weekend", "school_year")


@dataclass(frozen=True)
class Table:
    """A relational table: typed columns plus the constraints rows have to meet."""

    name: str
    ddl: str
    primary_key: tuple[str, ...]
    required: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.fieldNames())

    @property
    def schema(self) -> T.StructType:
        return struct_of(self.ddl)

    @property
    def create_statement(self) -> str:
        lines = []
        for column in self.schema:
            sql_type = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL"}.get(
                column.dataType.simpleString(), "TEXT"
            )
            suffix = " NOT NULL" if column.name in self.required else ""
            lines.append(f"    {column.name} {sql_type}{suffix}")
        lines.append(f"    PRIMARY KEY ({', '.join(self.primary_key)})")
        for column, (table, target) in self.references.items():
            lines.append(f"    FOREIGN KEY ({column}) REFERENCES {table} ({target})")
        body = ",\n".join(lines)
        return f"CREATE TABLE {self.name} (\n{body}\n);"


# Names, columns and keys of the relational tables.
DIM_OPERATOR = Table("dim_operator", "operator_id bigint, operator string", ("operator_id",), ("operator",))
DIM_REASON = Table("dim_reason", "reason_id bigint, reason string", ("reason_id",))
DIM_BORO = Table("dim_boro", "boro_id bigint, boro string", ("boro_id",), ("boro",))
DIM_DATE = Table(
    "dim_date",
    "date_key string, year int, month int, day_of_week int, season string, is_weekend int, school_year string",
    ("date_key",),
)
FACT_INCIDENT = Table(
    "fact_incident",
    "busbreakdown_id bigint, operator_id bigint, reason_id bigint, boro_id bigint, date_key string, "
    "hour int, time_band string, run_type string, school_age string, students_on_bus int, "
    "notified_schools int, notified_parents int, alerted_opt int, delay_minutes double, on_time int, "
    "incident_type string, is_breakdown int, occurred_ts string",
    ("busbreakdown_id",),
    references={
        "operator_id": ("dim_operator", "operator_id"),
        "reason_id": ("dim_reason", "reason_id"),
        "boro_id": ("dim_boro", "boro_id"),
        "date_key": ("dim_date", "date_key"),
    },
)
DIMENSION_TABLES = (DIM_OPERATOR, DIM_REASON, DIM_BORO, DIM_DATE)
TABLES = (*DIMENSION_TABLES, FACT_INCIDENT)

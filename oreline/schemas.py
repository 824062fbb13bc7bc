"""Source tables: columns, types, keys and watermark columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()
MONEY = T.DecimalType(18, 2)

# The column names of the source extracts, in source order.
PATIENT_COLUMNS = [
    "patient_id", "first_name", "last_name", "gender", "date_of_birth",
    "blood_group", "city", "insurance_type", "contact_number", "created_at",
]
ADMISSION_COLUMNS = [
    "admission_id", "patient_id", "department", "doctor_name", "admission_type",
    "admission_date", "discharge_date", "length_of_stay", "bed_type",
    "diagnosis_primary", "discharge_status", "readmission_flag", "ward_number",
    "created_at", "updated_at",
]
BILLING_COLUMNS = [
    "bill_id", "admission_id", "patient_id", "bill_date", "total_amount",
    "room_charges", "medicine_charges", "procedure_charges", "misc_charges",
    "insurance_type", "insurance_amount", "patient_payable", "payment_status", "created_at",
]
OCCUPANCY_COLUMNS = [
    "occupancy_id", "department", "snapshot_date", "total_beds",
    "occupied_beds", "available_beds", "occupancy_rate", "created_at",
]

# Every column not named here is text.
_TYPES: dict[str, T.DataType] = {
    "length_of_stay": _I,
    "readmission_flag": _I,
    "total_amount": MONEY,
    "room_charges": MONEY,
    "medicine_charges": MONEY,
    "procedure_charges": MONEY,
    "misc_charges": MONEY,
    "insurance_amount": MONEY,
    "patient_payable": MONEY,
    "total_beds": _I,
    "occupied_beds": _I,
    "available_beds": _I,
    "occupancy_rate": _D,
}

#: Cells and lines of a scan that did not fit.
REJECTED, CORRUPT = "_rejected_cells", "_corrupt_record"
EVIDENCE_COLUMNS = [REJECTED, CORRUPT]
AUDIT_COLUMNS = ["_ingestion_timestamp", "_source_file", "_layer", "_record_hash"]


@dataclass(frozen=True)
class SourceTable:
    """One source extract and how its loads are keyed and ordered in time."""

    name: str
    columns: tuple[str, ...]
    key: str
    watermark: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _TYPES.get(c, _S)) for c in self.columns])

    @property
    def file_name(self) -> str:
        return f"{self.name}_raw.csv"

    def type_of(self, column: str) -> T.DataType:
        return _TYPES.get(column, _S)


TABLES: dict[str, SourceTable] = {
    t.name: t
    for t in (
        SourceTable("patients", tuple(PATIENT_COLUMNS), "patient_id", "created_at"),
        SourceTable("admissions", tuple(ADMISSION_COLUMNS), "admission_id", "updated_at"),
        SourceTable("billing", tuple(BILLING_COLUMNS), "bill_id", "created_at"),
        SourceTable("bed_occupancy", tuple(OCCUPANCY_COLUMNS), "occupancy_id", "created_at"),
    )
}

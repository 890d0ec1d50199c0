from drover.sources.telemetry import decode_wire, to_wire, kafka_telemetry, file_telemetry, WIRE_SCHEMA
from drover.sources.expenses import (
    read_expense_feed, stream_expense_feed, expense_rejects, duplicate_keys, landed_days, write_landing,
)
from drover.sources.fixtures import telemetry_rows, telemetry_wire, expense_rows, expense_correction_rows
from drover.sources.tables import scan_days

__all__ = [
    "decode_wire", "to_wire", "kafka_telemetry", "file_telemetry", "WIRE_SCHEMA",
    "read_expense_feed", "stream_expense_feed", "expense_rejects", "duplicate_keys", "landed_days", "write_landing",
    "telemetry_rows", "telemetry_wire", "expense_rows", "expense_correction_rows", "scan_days",
]

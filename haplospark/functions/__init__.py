"""Column expressions. Everything here takes and returns Columns; nothing runs a job."""

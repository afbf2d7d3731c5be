"""Reading and writing: raw landing, Bronze snapshots, Gold tables, exports, audit records."""

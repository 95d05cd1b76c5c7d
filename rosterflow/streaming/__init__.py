"""Streaming entry points. The source scripts are batch-only; the monthly roster
folder is offered as an incremental (exactly-once) file-stream ingest."""

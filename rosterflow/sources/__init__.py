"""Readers: program lists, roster workbooks, supplementary CSVs, JDBC tables, fixed lookups."""

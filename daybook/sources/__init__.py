"""Where data comes from and goes to: workbooks, folder tables, databases."""

from daybook.sources.bucketed import write_bucketed
from daybook.sources.footers import from_footers, newest_day, stored_figures
from daybook.sources.jdbc import read_jdbc, write_jdbc_append
from daybook.sources.tables import TableStore, create_table_ddl, ensure_table
from daybook.sources.workbook import RAW_SCHEMA, decode_workbooks, file_stream, read_workbooks, unread_files, workbook_stream

__all__ = ["RAW_SCHEMA", "TableStore", "create_table_ddl", "decode_workbooks", "ensure_table", "file_stream", "from_footers",
           "newest_day", "read_jdbc", "read_workbooks", "stored_figures", "unread_files", "workbook_stream", "write_bucketed",
           "write_jdbc_append"]

"""Sources: driver tables, derived page views, file scans, store scans."""

from chunkwise.sources.files import extract_pages, scan_files, text_pages
from chunkwise.sources.store import scan_store
from chunkwise.sources.tables import TABLES, pages_view, read_table

__all__ = ["TABLES", "pages_view", "read_table", "extract_pages", "scan_files",
           "text_pages", "scan_store"]

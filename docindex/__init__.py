"""docindex: document-index analytics as PySpark DataFrame jobs."""

from docindex.locator import Locator
from docindex.sources.store import read_index, write_documents, write_records

__all__ = ["Locator", "read_index", "write_documents", "write_records"]

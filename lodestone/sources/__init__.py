"""Scans (CSV, line sets, notebooks, literal rows, catalog) and the
collection store used as source and sink between stages."""

from lodestone.sources.files import csv_scan, labelled_source, line_set, notebook_scan, NOTEBOOK_SCHEMA
from lodestone.sources.tables import literal_source, catalog_scan, catalog_from_documents, CATALOG_SCHEMA
from lodestone.sources.collections import (
    read_collection, write_collection, copy_collection, with_identity, insert_if_absent,
    insert_if_absent_delta, dedupe_first, append_log, read_log, write_sample, write_report,
    shape, collection_path, store_root,
)

"""Feature sources: landed pages, the catalog window, and the test fixture."""

from eventstar.sources.catalog import catalog_window, lookback_window
from eventstar.sources.fixture import fixture_features, fixture_pages, seismic_rows
from eventstar.sources.pages import explode_features, page_accounting, parse_pages, read_page_files

__all__ = ["catalog_window", "lookback_window", "fixture_features", "fixture_pages",
           "seismic_rows", "explode_features", "page_accounting", "parse_pages",
           "read_page_files"]

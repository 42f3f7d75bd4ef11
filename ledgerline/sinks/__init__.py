"""Writers: run-dated stages, staged tables, catalog tables and views."""

"""Writing results: views, tables, appends, keyed upserts and load logs."""

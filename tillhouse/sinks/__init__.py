"""Writers: partitioned tables, upserts, CSV, landing folders, marts."""

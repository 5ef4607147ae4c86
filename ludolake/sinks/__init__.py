"""Writers: tables, cluster results, stream micro-batches, records."""

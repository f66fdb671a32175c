"""Writers: raw envelope, keyed tables, file exports."""

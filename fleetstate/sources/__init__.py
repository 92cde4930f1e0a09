"""Where data comes from and goes to: parquet days, landed JSON payloads, named tables, CSV."""

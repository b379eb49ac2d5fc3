"""Where rows come from and go to: CSV files, Parquet tables, the catalog."""

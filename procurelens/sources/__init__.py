"""Where rows come from and go to: CSV folders, Parquet tables, the star-schema mapping."""

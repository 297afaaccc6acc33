"""Where rows come from: tab-separated pages, archives, Parquet footers, path layouts."""

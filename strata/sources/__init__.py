"""Where data comes from and goes to: the landing zone (``landing``), sliced
and versioned Parquet tables (``tables``), high-water marks, cursor and
date-window reads and paging (``incremental``), and scans (``scan``)."""

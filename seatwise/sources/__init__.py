"""Where tables come from: Parquet, JDBC, generated data, or the sample star schema."""

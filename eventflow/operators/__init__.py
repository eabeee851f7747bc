"""Row operators (DataFrame to DataFrame) and summaries."""

"""DataFrame operators for cleaning and profiling job-posting style tables."""

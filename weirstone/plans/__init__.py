"""Table builders, reports and the pipeline that runs them."""

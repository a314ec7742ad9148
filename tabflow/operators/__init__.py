"""DataFrame operators: encoding, scaling, splits, metrics, running sums, the
model pipeline, Shapley, run/version tables and data-quality checks."""

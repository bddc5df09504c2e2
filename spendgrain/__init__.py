"""Customer-transaction features on PySpark: intake, cleaning, feature sets, store, quality checks."""

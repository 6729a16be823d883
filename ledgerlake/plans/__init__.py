"""Layer plans: Silver cleaning, Gold metrics, quality report, end-to-end run."""

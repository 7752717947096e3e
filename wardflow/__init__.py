"""Clinical cohort, label, feature and evaluation jobs on Spark DataFrames."""

"""Company records on Spark: cleaning, matching, scoring, linking and reporting as DataFrame functions."""

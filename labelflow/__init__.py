"""labelflow: label text tables at scale with Spark DataFrames."""

"""Mining operators for Spark DataFrames: sketches, samples, clusters, graphs and rating models."""

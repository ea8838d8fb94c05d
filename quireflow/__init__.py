"""quireflow: page-pipeline analytics and training-data operators as Spark DataFrames."""

"""equifacts: company-facts processing on Spark DataFrames."""

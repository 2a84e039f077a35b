"""Track and land-parcel jobs on Spark DataFrames."""

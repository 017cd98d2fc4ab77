"""Device-monitoring and operations reporting on Spark DataFrames."""

"""Clinical-bundle ETL and claim analytics on Spark DataFrames."""

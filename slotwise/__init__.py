"""Operations analytics on Spark: event logs with daily conditions, from raw files to risk models."""

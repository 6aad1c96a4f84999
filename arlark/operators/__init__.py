"""Pipeline operators: DataFrame -> DataFrame functions."""

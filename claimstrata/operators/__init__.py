"""Layer operators: DataFrame in, DataFrame out."""

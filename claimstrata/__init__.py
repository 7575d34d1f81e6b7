"""Claims medallion pipeline on Spark: Bronze, Silver and Gold layers.

Every step is a function from DataFrame to DataFrame.  Clock, salt, month and
table names are arguments, so a run can be repeated and compared.
"""

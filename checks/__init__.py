"""The driver's queries: test inputs, Spark callables and the SQL they are compared with."""

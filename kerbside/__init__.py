"""Road telemetry lakehouse on PySpark: sources, column functions, operators, plans and streams."""

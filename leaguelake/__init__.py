"""Sports-league lakehouse work expressed as PySpark DataFrame operators."""

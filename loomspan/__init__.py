"""loomspan: data-integration and text analytics operators as lazy PySpark plans."""

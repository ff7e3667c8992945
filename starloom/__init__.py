"""Sales-warehouse engine on PySpark: staging, cleaning, star schema, reports."""

"""tarn: lakehouse analytics written as plain PySpark DataFrame operators."""

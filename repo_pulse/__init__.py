"""Daily activity figures for tracked open-source technologies, computed on Spark."""

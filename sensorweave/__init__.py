"""Sensor time-series quality, synchronisation, imputation and features on Spark."""

"""Pipeline operators: functions from DataFrame to DataFrame."""

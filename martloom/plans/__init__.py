"""The marts: functions from logical input tables to one result table each."""

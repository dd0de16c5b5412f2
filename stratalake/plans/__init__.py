"""Whole loads of the racing datasets: specs, full load, incremental load, control, views."""

"""Reports and hunts put together from the operators."""

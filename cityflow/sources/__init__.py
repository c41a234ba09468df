"""Where raw notifications and rejected records come from."""

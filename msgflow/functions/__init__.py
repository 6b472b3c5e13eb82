"""Column functions: headers, backoff, payload encoding."""

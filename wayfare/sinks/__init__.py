"""Write modes: append, full refresh, sorted, and repeatable micro-batches."""

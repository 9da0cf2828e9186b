"""Wayfare: booking, advertising, user-event and order-change analytics as Spark DataFrames."""

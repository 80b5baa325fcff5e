"""Passenger-flow analytics as Spark DataFrame operators."""

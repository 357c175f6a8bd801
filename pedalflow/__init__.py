"""Bike-sharing analytics as Spark jobs: relational, document and graph views of one dataset."""

"""Readers: topics, bronze tables, parquet trees and the event feeds over the given tables."""

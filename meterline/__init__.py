"""Meterline: monthly trip feeds loaded, cleaned, deduplicated, summarised and checked on Spark."""

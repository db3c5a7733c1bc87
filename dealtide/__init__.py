"""Spark jobs that clean sales-CRM exports, journal their defects and report on the result."""

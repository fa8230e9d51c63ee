"""Workbook, XML and file-listing sources."""

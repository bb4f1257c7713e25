"""Readers and writers: JSON lines, feeds, page anchors, spreadsheets, paged JSON services, run folders."""

"""Schemas, readers, writers and file-level scans."""

"""Readers for report files and sheets, and writers for finished reports."""

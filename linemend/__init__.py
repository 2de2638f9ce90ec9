"""Linemend: line-break and line-end analytics for transcribed text, on Spark."""

"""Operators for preparing training text: filtering, deduplication, scoring, scanning, archiving, tokenising."""

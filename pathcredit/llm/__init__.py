"""Operators for preparing training text: deduplication, decontamination,
quality, personal data, scoring, token counts and packing.  Nothing else in the
library imports this subpackage."""

"""Training-data operators: text quality, mixing, extraction, deduplication,
formatting, classification, decontamination, secrets and archive fixity.

Nothing else in the library imports this subpackage."""

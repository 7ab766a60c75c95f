"""Part of the curation engine."""

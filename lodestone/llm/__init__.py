"""Operations of training-data pipelines: dedup, search, decontamination, scoring, mixing and scans.

Nothing outside this package imports it.
"""

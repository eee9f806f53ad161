"""Column functions: timestamps, ids, value normalization, regex captures."""

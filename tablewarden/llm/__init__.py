"""Operators that prepare training data: rules, duplicates, decontamination, packing, formatting, licences."""

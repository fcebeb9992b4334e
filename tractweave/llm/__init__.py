"""Operators of a training-data pipeline: decontamination, toxicity, sharding, quality, mixing, licences, rules, dedup."""

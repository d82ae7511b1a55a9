"""Operators of a training-data pipeline: mixing, packing, search, licences, personal data, near copies, language,
language models, toxicity and fingerprints."""

"""Operators for preparing training text at scale: packing, personal data, secrets, quality rules,
near duplicates, toxicity, sharding, benchmark decontamination, repeated passages and language."""

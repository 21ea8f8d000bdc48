"""Training-data pipeline operators: text archives, language, toxicity, quality,
duplicate, contamination and packing stages over ``documents`` and ``pages``."""

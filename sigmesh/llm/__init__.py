"""Training-data operators: tokens, mixing, extraction, packing, de-duplication,
quality, license and toxicity jobs over ``documents`` and ``pages``."""

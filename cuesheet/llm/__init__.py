"""Large-scale training-data operators: mixing, privacy, token counts, archives, packing,
quality, near duplicates and language-model scoring. Nothing else in the library imports
this subpackage."""

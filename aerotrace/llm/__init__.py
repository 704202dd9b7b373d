"""Training-data operators: deduplication, counting, scanning, formatting,
decontamination, mixing, packing and quality rules over document tables."""

"""Training-data operators: similarity joins, scoring, fingerprints, tokenising, filtering, packing, scans."""

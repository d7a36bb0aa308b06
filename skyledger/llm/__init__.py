"""Training-data operators: language ID, de-duplication, archives, packing, search,
license scans, decontamination and sharding. Nothing else in the package imports this."""

"""Writers: versioned tables, sorted cells, exports and fitted models."""

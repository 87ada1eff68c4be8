"""Reading exports, checking contracts, mapping to tables, packing for delivery."""

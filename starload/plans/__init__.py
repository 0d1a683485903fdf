"""The seven loads: stage order is tables, dimensions, fact."""

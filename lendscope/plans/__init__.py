"""Domain feature builders, each a lazy DataFrame plan."""

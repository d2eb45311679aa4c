"""Column -> Column helpers: safe casts, payload keys, deterministic keys, rates."""

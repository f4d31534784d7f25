"""Column-level business rules (status, penalties, ratios) — no DataFrame access."""

"""How a write log becomes versions: visibility, resolution and skew handling."""

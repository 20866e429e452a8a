"""Column rules. Every function takes and returns ``Column`` and never raises on bad text."""

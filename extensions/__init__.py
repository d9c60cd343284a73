"""Feature kinds from outside the engine."""
